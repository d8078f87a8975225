"""Command line: ``spark-submit`` or ``python -m tokenloom JOB ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tokenloom.functions.scoring import ASSUMED_DOCS
from tokenloom.plans import jobs


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tokenloom")
    commands = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    count = job("word-count", "corpus", "target")
    count.add_argument("--ignore-case", action="store_true")
    count.add_argument("--skip-patterns", action="append", metavar="FILE")
    count.add_argument("--max-line-bytes", type=int)
    job("top-words", "corpus", "target", "stop_words").add_argument("-k", type=int, default=50)
    pairs = job("pairs", "corpus", "target", "vocabulary")
    pairs.add_argument("-d", type=int, default=1)
    pairs.add_argument("--fold-by-line", action="store_true")
    job("stripes", "corpus", "target", "vocabulary").add_argument("-d", type=int, default=1)
    job("doc-freq", "corpus", "target", "stop_words")
    job("top-terms", "frequencies", "target").add_argument("-k", type=int, default=100)
    score = job("score", "corpus", "target", "terms")
    matrices = job("matrices", "corpus", "target", "vocabulary")
    everything = job("all", "corpus", "target", "stop_words")
    for sub in (matrices, everything):
        sub.add_argument("--distances", type=int, nargs="+", default=[1, 2, 3, 4])
    for sub in (score, everything):
        sub.add_argument("--n-docs", type=int, default=ASSUMED_DOCS)
        sub.add_argument("--unsorted", dest="ordered", action="store_false")
    return parser


JOBS = {
    "word-count": jobs.word_count_job,
    "top-words": jobs.top_words_job,
    "pairs": jobs.pairs_job,
    "stripes": jobs.stripes_job,
    "doc-freq": jobs.doc_freq_job,
    "top-terms": jobs.top_terms_job,
    "score": jobs.score_job,
    "matrices": jobs.matrices_job,
    "all": jobs.run_all,
}


def main(arguments: list[str] | None = None) -> None:
    options = vars(_parser().parse_args(arguments))
    job = JOBS[options.pop("job")]
    if "ignore_case" in options:
        options["case_sensitive"] = not options.pop("ignore_case")
    job(SparkSession.builder.appName("tokenloom").getOrCreate(), **options)


if __name__ == "__main__":
    main()
