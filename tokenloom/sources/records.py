"""Text records from files and tables.

A record is a row with ``doc_id`` and ``text``.  Operators that look at
neighbouring words, or that count empty words, need one line per record; they
take ``doc_id, line_no, text``.  The others may be given whole documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import raw_lines, without_terminator


def file_lines(spark: SparkSession, path: str | list[str], max_line_bytes: int | None = None) -> DataFrame:
    """Lines of the text files under ``path``; ``doc_id`` is the base file name.

    Large files are split between tasks.  ``line_no`` tells lines apart but is
    no ordinal.  ``max_line_bytes`` drops lines of that many bytes or more,
    terminator included, as :func:`table_lines` does; see :func:`bounded_lines`.
    """
    if max_line_bytes is not None:
        return bounded_lines(spark, path, max_line_bytes)
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("doc_id"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("text"),
    )


# Of a file's bytes a reader gives all but a mark at the very start.
BYTE_ORDER_MARK = 3


def bounded_lines(spark: SparkSession, path: str | list[str], max_line_bytes: int) -> DataFrame:
    """The lines of text files that, with their own terminator, stay below ``max_line_bytes``.

    Files are read up to each ``\\n``, which leaves a ``\\r`` in sight, so each
    line's bytes are known but for one thing: whether the last of a file ends
    with ``\\n``.  It does not where all pieces with a ``\\n`` each come to one
    byte more than the file has.  This matters only to a last line that is one
    byte too long because of the terminator it is taken to have; such lines come
    from the pass that adds up the bytes, a row per file, and no line is joined
    with another.  Of compressed files the bytes cannot be added up; there the
    last line is taken to be terminated.
    """
    pieces = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("doc_id"),
        F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("piece"), "value",
    )
    raw = raw_lines(F.concat("value", F.lit("\n")))
    short = F.filter(raw, lambda r: F.octet_length(r) < max_line_bytes)
    below = pieces.select("doc_id", F.explode(short).alias("raw")).select(
        "doc_id", F.monotonically_increasing_id().alias("line_no"), without_terminator(F.col("raw")).alias("text")
    )
    last = F.element_at(raw, -1)
    # Numbered downwards from -1, so as no line above is.
    edge = F.when(F.octet_length(last) == max_line_bytes, F.struct(
        (-1 - F.col("piece")).alias("line_no"), without_terminator(last).alias("text")
    ))
    bytes_read = F.sum(F.octet_length("value") + 1)
    files = pieces.groupBy("path", "doc_id", "file_size").agg(
        (bytes_read - F.col("file_size")).alias("over"), F.max_by(edge, F.struct("block_start", "piece")).alias("edge")
    )
    open_end = files.filter(F.col("over").isin(1, 1 - BYTE_ORDER_MARK) & F.col("edge").isNotNull())
    return below.unionByName(open_end.select("doc_id", "edge.line_no", "edge.text"))


def table_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_line_bytes: int | None = None
) -> DataFrame:
    """Lines of a text column, numbered from 0 within each row.

    A terminator ends a line and opens no further one, as in a file.
    ``max_line_bytes`` drops lines of that many bytes or more, terminator
    included.
    """
    lines = docs.select(
        F.col(doc_id).alias("doc_id"), F.posexplode(raw_lines(F.col(text))).alias("line_no", "raw")
    )
    if max_line_bytes is not None:
        lines = lines.filter(F.octet_length("raw") < max_line_bytes)
    return lines.select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), without_terminator(F.col("raw")).alias("text")
    )


# A table of at most this many bytes, one split of a scan, may be dealt out anew.
SMALL_INPUT = 128 << 20


def spread_small_input(df: DataFrame) -> DataFrame:
    """Spread a small table whose scan has fewer splits than the cluster has cores.

    Only a table that a scan would read as one split is dealt out, a single file
    that would keep one core busy.  Any other, however few its splits, is left as
    it is, and so is a bucketed one, whose order by its key would be lost.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size > SMALL_INPUT or df.rdd.getNumPartitions() >= cores:
        return df
    bucketed = "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()
    return df if bucketed else df.repartition(cores)
