"""Token totals by source, language and tokenizer version, kept by deltas.

Totals are additive: inserting a document adds its count, deleting it adds the
negative, revising it adds the difference.  A *batch* of changes is folded to one
row per group and committed under its name: the write of a batch counts only
once a marker of its own, renamed into place last, is there, and a batch whose
marker is there is not written again.  So a batch that is sent twice, or whose
first attempt died half way, changes totals once.  Totals are the newest base and
the batches committed since; :func:`compact` adds these to a new base, whose
marker names all batches it holds.  One writer at a time commits to a folder.
Batches keep their files when a base holds them.

Null sources and languages are groups like any other, null texts have no tokens
but count as documents.  Groups whose documents and tokens are both zero are
left out.  Rows that repeat are changes of their own.  Texts of any length are
counted whole.  Empty changes are a batch like any other, and totals of a folder
without batches are empty.  Columns beside those named are not read.
"""

from __future__ import annotations

import json
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.mixing import size_of
from tokenloom.operators.wordlists import fits_broadcast
from tokenloom.session import settled

GROUP = ("source", "lang", "tokenizer")
BATCH = "source string, lang string, tokenizer string, docs long, tokens long"
MARKER = "_committed"


def counts(docs: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens`` of documents."""
    return docs.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


def words(docs: DataFrame) -> DataFrame:
    return counts(docs, "words-1", size_of(F.col("text")))


def utf8_bytes(docs: DataFrame) -> DataFrame:
    return counts(docs, "bytes-1", F.octet_length("text"))


def inserted(rows: DataFrame) -> DataFrame:
    return rows.select(*GROUP, F.lit(1).cast("long").alias("docs"), "tokens")


def deleted(rows: DataFrame) -> DataFrame:
    return rows.select(*GROUP, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changes that turn the counts ``before`` into ``after``, whatever changed."""
    return deleted(before).unionByName(inserted(after))


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _committed(spark: SparkSession, path: str) -> bool:
    marker, files = _path(spark, f"{path}/{MARKER}")
    return files.exists(marker)


def _mark(spark: SparkSession, path: str, content: list[str]) -> None:
    """Write the marker of ``path``; it appears whole or not at all."""
    begun, files = _path(spark, f"{path}/{MARKER}-begun")
    out = files.create(begun, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if not files.rename(begun, _path(spark, f"{path}/{MARKER}")[0]):
        raise RuntimeError(f"could not commit {path}")


def _content(spark: SparkSession, path: str) -> list[str]:
    marker, files = _path(spark, f"{path}/{MARKER}")
    opened = files.open(marker)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
    finally:
        opened.close()


def _named(spark: SparkSession, folder: str, kind: str) -> list[str]:
    """Names of the committed batches or bases of a folder, in order."""
    path, files = _path(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    return sorted(n for n in names if n.startswith(f"{kind}=") and _committed(spark, f"{folder}/{n}"))


def _folded(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def _standing(spark: SparkSession, folder: str) -> tuple[list[str], list[str]]:
    """Paths to add up, the newest base and the batches it lacks, and the names of all batches."""
    batches, bases = _named(spark, folder, "batch"), _named(spark, folder, "base")
    held = set(_content(spark, f"{folder}/{bases[-1]}")) if bases else set()
    return [f"{folder}/{n}" for n in [*bases[-1:], *(b for b in batches if b not in held)]], batches


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(BATCH).parquet(*paths) if paths else spark.createDataFrame([], BATCH)


def commit(folder: str, batch: str, changes: DataFrame) -> bool:
    """Commit ``changes`` under the name ``batch``; False if that was done before."""
    spark, path = changes.sparkSession, f"{folder}/batch={quote(batch, safe='')}"
    if _committed(spark, path):
        return False
    _folded(changes).write.mode("overwrite").parquet(path)
    _mark(spark, path, [batch])
    return True


def compact(spark: SparkSession, folder: str) -> bool:
    """Add the batches since the last base to it, as the next base; False if there are none."""
    paths, batches = _standing(spark, folder)
    if not any("/batch=" in p for p in paths):
        return False
    bases = _named(spark, folder, "base")
    path = f"{folder}/base={int(bases[-1][5:]) + 1 if bases else 0:08d}"
    _folded(_read(spark, paths)).write.mode("overwrite").parquet(path)
    _mark(spark, path, batches)
    return True


def totals(spark: SparkSession, folder: str, batches: list[str] | None = None) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` over all committed batches, or those of ``batches`` that are committed."""
    if batches is None:
        paths = _standing(spark, folder)[0]
    else:
        paths = [p for b in batches if _committed(spark, p := f"{folder}/batch={quote(b, safe='')}")]
    return _folded(_read(spark, paths)).where("docs <> 0 OR tokens <> 0")


def copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text a row of smaller id has, without the text.

    Only the digests that occur more than once, with the smallest id of each, meet
    the rows; up to a measured size they are broadcast, so that no task gets all
    rows of one text.  Beyond it Spark splits the rows of a frequent digest.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    first = docs.groupBy(digest.alias("__md5")).agg(F.min("doc_id").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    first = settled(first.where("__rows > 1").drop("__rows"))
    thin = docs.select("doc_id", "source", "lang", digest.alias("__md5"), size_of(F.col("text")).alias("tokens"))
    return thin.join(F.broadcast(first) if fits_broadcast(first) else first, "__md5").where("doc_id > __first").drop("__md5", "__first")
