"""Column expressions over text: words, lines, skip patterns."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what a word is.  ASCII letters, digits, `_` and `'`; accented
# letters separate words.
WORD = r"[\w']+"

# A line with its terminator: \n, \r\n or \r.  The last one may have none.
_RAW_LINE = r"[^\r\n]*+(?:\r\n|\r|\n)|[^\r\n]++"


def cased_words(text: Column) -> Column:
    """The words of ``text`` in order, as they are written."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def words(text: Column) -> Column:
    """The words of ``text`` in order, in lower case."""
    return cased_words(F.lower(text))


def counted_words(line: Column) -> Column:
    """The words of one line, with the empty word a plain split would add.

    An empty line holds one empty word; so does a line that opens with a
    separator, provided some word follows.
    """
    found = cased_words(line)
    opens_with_separator = ~line.rlike(r"^[\w']") & line.rlike(r"[\w']")
    return F.when(line == "", F.array(F.lit(""))).otherwise(
        F.when(opens_with_separator, F.array_prepend(found, F.lit(""))).otherwise(found)
    )


def raw_lines(text: Column) -> Column:
    """The lines of ``text``, each with its terminator; none for empty text."""
    return F.regexp_extract_all(text, F.lit(_RAW_LINE), F.lit(0))


def without_terminator(raw_line: Column) -> Column:
    return F.rtrim(raw_line, F.lit("\r\n"))


# As many replacements are nested in one expression; see `strip_patterns`.
NESTED_PATTERNS = 40


def without_patterns(text: Column, patterns: Sequence[str]) -> Column:
    """``text`` with every match of every pattern removed, pattern by pattern."""
    return reduce(lambda t, p: F.regexp_replace(t, F.lit(p), F.lit("")), patterns, text)


def strip_patterns(text: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """The one-column frame ``text`` with every match of every pattern removed, in their order.

    A long list goes in stages of :data:`NESTED_PATTERNS`.  Every pattern is a
    constant of its own, compiled once a task.  A generator between the stages
    keeps Catalyst from nesting them all in one expression again.  A text in
    which no pattern of a stage matches passes the stage as it is.
    """
    for at in range(0, len(patterns), NESTED_PATTERNS):
        stage = _stage(patterns[at : at + NESTED_PATTERNS])
        text = text.select(stage.alias("text") if at == 0 else F.explode(F.array(stage)).alias("text"))
    return text


# Below so many patterns a search for any of them saves nothing.
GUARDED_PATTERNS = 8


def _stage(patterns: Sequence[str]) -> Column:
    text = F.col("text")
    stripped = without_patterns(text, patterns)
    guard = any_of(patterns) if len(patterns) >= GUARDED_PATTERNS else None
    return stripped if guard is None else F.when(text.rlike(guard), stripped).otherwise(text)


def any_of(patterns: Sequence[str]) -> str | None:
    """One pattern that is found in a text if any of ``patterns`` is; None if they cannot be put together.

    Groups, escapes and flags may mean something else beside other patterns.
    Plain strings share their beginnings, so that one look tells that none starts here.
    """
    if any(re.search(r"[\\(]", p) for p in patterns):
        return None
    plain = sorted({p for p in patterns if not re.search(r"[.\[\]{})*+?^$|]", p)})
    rest = [f"(?:{p})" for p in dict.fromkeys(patterns) if p not in plain]
    return "|".join(([_either(plain)] if plain else []) + rest)


def _either(plain: Sequence[str]) -> str:
    """A pattern that is found where one of the sorted strings ``plain`` starts."""
    if "" in plain:
        return ""
    starts: dict[str, list[str]] = {}
    for p in plain:
        starts.setdefault(p[0], []).append(p)
    found = []
    for same in starts.values():
        shared = os.path.commonprefix(same)
        found.append(shared + (_either([p[len(shared) :] for p in same]) if len(same) > 1 else ""))
    return found[0] if len(found) == 1 else f"(?:{'|'.join(found)})"
