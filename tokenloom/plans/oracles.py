"""DuckDB SQL for the registered queries.

Written against the tables, not against the Spark plans: co-occurrence is a
plain self-join of token rows, and stems come from a chain of CTEs that tests
suffixes one after the other.
"""

from __future__ import annotations

from tokenloom.functions.scoring import ASSUMED_DOCS
from tokenloom.plans.queries import (
    BAD_TERM_LINES, BAD_VOCABULARY_LINES, DISTANCES, LINE_BYTES, LONG_LIST_COUNT, LONG_SKIP_PATTERNS, SKIP_PATTERNS, STOP,
    STOP_LINES, TOP_TERMS, TOP_WORDS,
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


WORD = _text(r"[\w']+")
DOCS = "docs AS (SELECT doc_id AS doc, doc_id AS row_key, text FROM documents)"
TURNS = (
    "docs AS (SELECT conv_id AS doc, concat_ws('-', conv_id, turn) AS row_key, text FROM conversations)"
)
LINES = r"""lines AS (
  SELECT doc, row_key, i - 1 AS line_no, parts[i] AS line, i < len(parts) AS ended
  FROM (SELECT doc, row_key, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc, row_key, string_split_regex(text, '\r\n|\r|\n') AS parts FROM docs))
  WHERE NOT (i = len(parts) AND parts[i] = ''))"""
TOKENS = f"""toks AS (
  SELECT doc, row_key, line_no, (generate_subscripts(w, 1) - 1)::INTEGER AS pos, unnest(w) AS tok
  FROM (SELECT doc, row_key, line_no, regexp_extract_all(lower(line), {WORD}) AS w FROM lines))"""
STOPS = f"stop AS (SELECT unnest([{', '.join(_text(w) for w in STOP)}]) AS word)"
COUNTS = """counts AS (
  SELECT tok AS word, count(*) AS n FROM toks
  WHERE tok NOT IN (SELECT word FROM stop) GROUP BY tok)"""
TOP = f"top AS (SELECT max(word) AS word, n FROM counts GROUP BY n ORDER BY n DESC LIMIT {TOP_WORDS})"
HITS = "hits AS (SELECT * FROM toks WHERE tok IN (SELECT word FROM top))"

_BASE = (DOCS, LINES, TOKENS)
_COUNTED = (*_BASE, STOPS, COUNTS)
_TOP = (*_COUNTED, TOP)
_HITS = (*_TOP, HITS)
_TALK_TOP = (TURNS, LINES, TOKENS, STOPS, COUNTS, TOP)


def _near(d: int | str) -> str:
    return (
        "hits a JOIN hits b ON a.row_key = b.row_key AND a.line_no = b.line_no "
        f"AND abs(a.pos - b.pos) BETWEEN 1 AND {d}"
    )


def _pairs(d: int) -> str:
    return f"SELECT a.tok AS w1, b.tok AS w2, count(*) AS n FROM {_near(d)} WHERE a.tok <> b.tok GROUP BY 1, 2"


def _stripe_rows(d: int) -> str:
    return f"SELECT a.tok AS word, b.tok AS neighbour, count(*) AS n FROM {_near(d)} GROUP BY 1, 2"


_STRIPE = "'{' || string_agg(neighbour || ':' || n, ', ' ORDER BY neighbour) || '}'"
_DISTANCES = f"(SELECT unnest([{', '.join(map(str, DISTANCES))}]) AS d)"


def _counted_words(line: str) -> str:
    found = f"regexp_extract_all({line}, {WORD})"
    return f"""CASE WHEN {line} = '' THEN ['']
      WHEN len({found}) > 0 AND NOT regexp_matches({line}, {_text("^[" + chr(92) + "w']")})
      THEN list_prepend('', {found}) ELSE {found} END"""


def _word_count(line: str, where: str = "true") -> str:
    return f"""SELECT word, count(*) AS n FROM (
      SELECT unnest({_counted_words('line')}) AS word FROM (SELECT {line} AS line FROM lines WHERE {where}))
    GROUP BY word"""


def _skipped(line: str, patterns: list[str]) -> str:
    for pattern in patterns:
        line = f"regexp_replace({line}, {_text(pattern)}, '', 'g')"
    return line


# -- stems -------------------------------------------------------------------

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"

# The published suffix tables once more, apart from those the
# Spark form uses, so that a slip in either shows.  "-" stands for nothing.
SQL_STEP_2 = """
ational ate, tional tion, enci ence, anci ance, izer ize, bli ble, alli al, entli ent, eli e, ousli ous, ization ize,
ation ate, ator ate, alism al, iveness ive, fulness ful, ousness ous, aliti al, iviti ive, biliti ble, logi log"""
SQL_STEP_3 = "icate ic, ative -, alize al, iciti ic, ical ic, ful -, ness -"
SQL_STEP_4 = """
al -, ance -, ence -, er -, ic -, able -, ible -, ant -, ement -, ment -, ent -, ion -, ou -, ism -, ate -, iti -, ous -,
ive -, ize -"""


def _suffixes(text: str) -> dict[str, str]:
    rows = (row.split() for row in text.split(","))
    return {suffix: "" if other == "-" else other for suffix, other in rows}


def _measure(text: str, above: int) -> str:
    return f"regexp_matches({text}, '^({_C})?({_V}{_C}){{{above + 1}}}')"


def _short(text: str) -> str:
    return f"regexp_matches({text}, '^{_C}[aeiouy][^aeiouwxy]$')"


def _vowel(text: str) -> str:
    return f"regexp_matches({text}, '[aeiouy]')"


def _less(k: int) -> str:
    return f"left(w, len(w) - {k})"


def _suffix_case(table: dict[str, str], above: int) -> str:
    arms = []
    for suffix in sorted(table, key=len, reverse=True):
        rest = _less(len(suffix))
        test = _measure(rest, above)
        if suffix == "ion":
            test += f" AND regexp_matches({rest}, '[st]$')"
        arms.append(f"WHEN suffix(w, '{suffix}') THEN CASE WHEN {test} THEN {rest} || '{table[suffix]}' ELSE w END")
    return "CASE " + "\n      ".join(arms) + " ELSE w END"


def _stem_ctes(source: str) -> tuple[str, ...]:
    """CTEs that end in ``stems(tok, stem)`` for the distinct words of ``source``."""
    doubled = (
        f"(right({_less(1)}, 1) = left(right({_less(1)}, 2), 1) AND len(w) > 2 AND "
        f"(regexp_matches({_less(1)}, '[^aeiouylsz]$') OR "
        f"regexp_matches({_less(1)}, '[aeiou]y(yy)+$') OR regexp_matches({_less(1)}, '[^aeiouy](yy)+$')))"
    )
    steps = [
        """CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN left(w, len(w) - 2)
           WHEN suffix(w, 'ss') THEN w WHEN suffix(w, 's') THEN left(w, len(w) - 1) ELSE w END""",
        f"""CASE WHEN suffix(w, 'eed') THEN CASE WHEN {_measure(_less(3), 0)} THEN {_less(1)} ELSE w END
           WHEN suffix(w, 'ed') THEN CASE WHEN {_vowel(_less(2))} THEN {_less(2)} || '#' ELSE w END
           WHEN suffix(w, 'ing') THEN CASE WHEN {_vowel(_less(3))} THEN {_less(3)} || '#' ELSE w END
           ELSE w END""",
        f"""CASE WHEN NOT suffix(w, '#') THEN w
           WHEN suffix(w, 'at#') OR suffix(w, 'bl#') OR suffix(w, 'iz#') THEN {_less(1)} || 'e'
           WHEN {doubled} THEN {_less(2)}
           WHEN {_short(_less(1))} THEN {_less(1)} || 'e' ELSE {_less(1)} END""",
        f"CASE WHEN suffix(w, 'y') AND {_vowel(_less(1))} THEN {_less(1)} || 'i' ELSE w END",
        _suffix_case(_suffixes(SQL_STEP_2), 0),
        _suffix_case(_suffixes(SQL_STEP_3), 0),
        _suffix_case(_suffixes(SQL_STEP_4), 1),
        f"""CASE WHEN suffix(w, 'e') AND ({_measure(_less(1), 1)}
           OR ({_measure(_less(1), 0)} AND NOT {_short(_less(1))})) THEN {_less(1)} ELSE w END""",
        f"CASE WHEN suffix(w, 'll') AND {_measure('w', 1)} THEN {_less(1)} ELSE w END",
    ]
    ctes = [
        f"""s0 AS MATERIALIZED (SELECT tok, CASE WHEN prefix(tok, 'y') THEN 'Y' || substr(tok, 2) ELSE tok END AS w
         FROM (SELECT DISTINCT tok FROM {source}) WHERE len(tok) > 2)"""
    ]
    for i, step in enumerate(steps):
        ctes.append(f"s{i + 1} AS MATERIALIZED (SELECT tok, {step} AS w FROM s{i})")
    ctes.append(
        f"""stems AS MATERIALIZED (SELECT tok, lower(w) AS stem FROM s{len(steps)}
         UNION ALL SELECT DISTINCT tok, tok AS stem FROM {source} WHERE len(tok) <= 2)"""
    )
    return tuple(ctes)


FREQ = """freq AS (
  SELECT stem, count(DISTINCT doc) AS df
  FROM toks JOIN stems USING (tok)
  WHERE tok NOT IN (SELECT word FROM stop) AND stem NOT IN (SELECT word FROM stop) GROUP BY stem)"""
TERMS = f"terms AS (SELECT stem, df FROM freq ORDER BY df DESC, stem LIMIT {TOP_TERMS})"
TF = """tfs AS (
  SELECT doc AS doc_id, stem, df, count(*) AS tf
  FROM toks JOIN stems USING (tok) JOIN terms USING (stem) GROUP BY doc, stem, df)"""
SCORES = f"""scores AS (
  SELECT doc_id, stem AS term, tf * log10({float(ASSUMED_DOCS)} / df + 1) AS score FROM tfs)"""

_FREQ = (*_BASE, STOPS, *_stem_ctes("toks"), FREQ)
_TALK_FREQ = (TURNS, LINES, TOKENS, STOPS, *_stem_ctes("toks"), FREQ)
_TERMS = (*_FREQ, TERMS)
_SCORES = (*_TERMS, TF, SCORES)
_LONG = f"top AS (SELECT word FROM counts WHERE n >= {LONG_LIST_COUNT})"
_EVERY = "top AS (SELECT DISTINCT tok AS word FROM toks)"
_TAB = "chr(9)"


def _list(lines: list[str]) -> str:
    text = ", ".join(_text(line) for line in lines)
    return f"unnest([{text}])"


# Side files as lines, parsed in SQL.
_TOP_LINES = (
    f"top_lines AS (SELECT word || {_TAB} || n AS value FROM top UNION ALL SELECT {_list(BAD_VOCABULARY_LINES)})",
    r"listed AS (SELECT DISTINCT string_split_regex(value, '\s+')[1] AS word FROM top_lines WHERE string_split_regex(value, '\s+')[1] <> '')",
    "hits AS (SELECT * FROM toks WHERE tok IN (SELECT word FROM listed))",
)
_TERM_LINES = (
    f"term_lines AS (SELECT stem || {_TAB} || df AS value FROM terms UNION ALL SELECT {_list(BAD_TERM_LINES)})",
    f"""read_terms AS (SELECT f[1] AS stem, CAST(f[2] AS BIGINT) AS df FROM
      (SELECT string_split(rtrim(value, {_TAB}), {_TAB}) AS f FROM term_lines) WHERE len(f) = 2)""",
    f"""read_tfs AS (SELECT doc AS doc_id, stem, df, count(*) AS tf
      FROM toks JOIN stems USING (tok) JOIN read_terms USING (stem) GROUP BY doc, stem, df)""",
)
_STOP_LINES = (
    rf"stop AS (SELECT DISTINCT lower(regexp_replace(value, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) AS word FROM (SELECT {_list(STOP_LINES)} AS value))"
)
# Texts written to files: every line ends with a terminator.
_FILE_LINES = rf"""lines AS (
  SELECT rtrim(raw, chr(13) || chr(10)) AS line FROM (
    SELECT unnest(regexp_extract_all(text || chr(10), '[^\r\n]*(?:\r\n|\r|\n)')) AS raw FROM docs)
  WHERE strlen(raw) < {LINE_BYTES})"""

_TOKEN_ROWS = "SELECT doc AS doc_id, line_no, pos, tok FROM toks"
_PAIRS_BY_LINE = (
    f"SELECT a.doc AS doc_id, a.line_no, a.tok AS w1, b.tok AS w2, count(*) AS n FROM {_near(2)} "
    "WHERE a.tok <> b.tok GROUP BY 1, 2, 3, 4"
)

ORACLES: dict[str, str] = {
    "line_scan": _with(DOCS, LINES) + "SELECT doc AS doc_id, line_no, line AS text FROM lines",
    "tokens": _with(*_BASE) + _TOKEN_ROWS,
    "tokens_no_stop": _with(*_BASE, STOPS) + _TOKEN_ROWS + " WHERE tok NOT IN (SELECT word FROM stop)",
    "tokens_in_vocab": _with(*_TOP) + _TOKEN_ROWS + " WHERE tok IN (SELECT word FROM top)",
    "word_count": _with(DOCS, LINES) + _word_count("line"),
    "word_count_any_case": _with(DOCS, LINES) + _word_count("lower(line)"),
    "word_count_skip": _with(DOCS, LINES) + _word_count(_skipped("lower(line)", SKIP_PATTERNS)),
    "word_count_skip_long": _with(DOCS, LINES) + _word_count(_skipped("lower(line)", LONG_SKIP_PATTERNS)),
    "word_count_bounded": _with(DOCS, LINES)
    + _word_count("line", f"strlen(line) + CASE WHEN ended THEN 1 ELSE 0 END < {LINE_BYTES}"),
    "word_count_bounded_files": _with(DOCS, _FILE_LINES) + _word_count("line"),
    "word_count_no_stop": _with(*_COUNTED) + "SELECT word, n FROM counts",
    "word_count_stop_lines": _with(*_BASE, _STOP_LINES, COUNTS) + "SELECT word, n FROM counts",
    "top50_words": _with(*_TOP) + "SELECT word, n FROM top",
    "top50_words_text": _with(*_TOP) + f"SELECT word || {_TAB} || n AS value FROM top",
    "top50_words_conversations": _with(*_TALK_TOP) + "SELECT word, n FROM top",
    **{f"cooc_pairs_d{d}": _with(*_HITS) + _pairs(d) for d in DISTANCES},
    "cooc_pairs_text_d2": _with(*_HITS)
    + f"SELECT w1 || ',' || w2 || {_TAB} || n AS value FROM ({_pairs(2)})",
    "cooc_pairs_sweep": _with(*_HITS)
    + f"SELECT g.d, a.tok AS w1, b.tok AS w2, count(*) AS n FROM {_near(max(DISTANCES))} "
    f"JOIN {_DISTANCES} g ON abs(a.pos - b.pos) <= g.d WHERE a.tok <> b.tok GROUP BY 1, 2, 3",
    "cooc_pairs_from_text_d2": _with(*_TOP, *_TOP_LINES) + _pairs(2),
    "cooc_matrices_text": _with(*_HITS) + " UNION ALL ".join(
        [
            f"SELECT {_text(layout)} AS layout, {d}::INTEGER AS d, w1 || ',' || w2 || {_TAB} || n AS value FROM ({_pairs(d)})"
            for d in DISTANCES for layout in ("pairs", "folded_pairs")
        ]
        + [
            f"SELECT 'stripes' AS layout, {d}::INTEGER AS d, word || {_TAB} || {_STRIPE} AS value FROM ({_stripe_rows(d)}) GROUP BY word"
            for d in DISTANCES
        ]
    ),
    "cooc_pairs_by_line": _with(*_HITS) + _PAIRS_BY_LINE,
    "cooc_pairs_refold": _with(*_HITS)
    + f"SELECT w1, w2, sum(n)::BIGINT AS n FROM ({_PAIRS_BY_LINE}) GROUP BY w1, w2",
    **{f"cooc_pairs_refold_d{d}": _with(*_HITS) + _pairs(d) for d in DISTANCES},
    "cooc_pairs_turns_long_list_d2": _with(TURNS, LINES, TOKENS, _EVERY, HITS) + _pairs(2),
    "cooc_pairs_long_list_d2": _with(*_COUNTED, _LONG, HITS) + _pairs(2),
    "cooc_pairs_conversations_d2": _with(*_TALK_TOP, HITS) + _pairs(2),
    **{f"cooc_stripes_rows_d{d}": _with(*_HITS) + _stripe_rows(d) for d in DISTANCES},
    **{
        f"cooc_stripes_text_d{d}": _with(*_HITS)
        + f"SELECT word || {_TAB} || {_STRIPE} AS value FROM ({_stripe_rows(d)}) GROUP BY word"
        for d in DISTANCES
    },
    "cooc_stripes_sweep": _with(*_HITS)
    + f"SELECT d, word, {_STRIPE} AS stripe FROM (SELECT g.d, a.tok AS word, b.tok AS neighbour, count(*) AS n "
    f"FROM {_near(max(DISTANCES))} JOIN {_DISTANCES} g ON abs(a.pos - b.pos) <= g.d GROUP BY 1, 2, 3) GROUP BY d, word",
    "stem_vocab": _with(*_BASE, *_stem_ctes("toks")) + "SELECT tok, stem FROM stems",
    "doc_freq": _with(*_FREQ) + "SELECT stem, df FROM freq",
    "doc_freq_conversations": _with(*_TALK_FREQ) + "SELECT stem, df FROM freq",
    "top100_df": _with(*_TERMS) + "SELECT stem, df FROM terms",
    "top100_df_text": _with(*_TERMS) + f"SELECT stem || {_TAB} || df AS value FROM terms",
    "term_freq": _with(*_TERMS, TF) + "SELECT doc_id, stem, df, tf FROM tfs",
    "tf_score": _with(*_SCORES) + "SELECT doc_id, term, round(score, 4) AS score FROM scores",
    "tf_score_from_text": _with(*_TERMS, *_TERM_LINES)
    + f"SELECT doc_id, stem AS term, round(tf * log10({float(ASSUMED_DOCS)} / df + 1), 4) AS score FROM read_tfs",
    "tf_score_text": _with(*_SCORES)
    + f"SELECT doc_id || {_TAB} || term || {_TAB} || printf('%.4f', score) AS value FROM scores",
    "tf_score_head": _with(*_SCORES)
    + "SELECT doc_id, term, round(score, 4) AS score FROM scores ORDER BY doc_id, term LIMIT 20",
}
