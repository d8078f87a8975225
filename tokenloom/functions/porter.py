"""Porter stemming as Spark projections.

Written from M. F. Porter, "An algorithm for suffix stripping" (Program 14(3),
1980), with the author's two later amendments (``bli -> ble`` and
``logi -> log``).  Words of one or two letters are left alone.

Every step is one projection over the whole column, so a word's stem needs no
join and no shuffle, and a word that makes up a third of the corpus costs no
more than any other.  The steps look at their input several times, which keeps
Catalyst from inlining them into each other, and the suffix tables are set
lookups rather than long ``CASE`` chains: the generated method has to stay
below the 8,000 bytecodes that HotSpot still compiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Suffix tables of the published algorithm, suffix -> replacement.
# The longest suffix that fits decides, even when the measure test then fails.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
    "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e",
    "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP_4 = {
    "al": "", "ance": "", "ence": "", "er": "", "ic": "", "able": "",
    "ible": "", "ant": "", "ement": "", "ment": "", "ent": "", "ion": "",
    "ou": "", "ism": "", "ate": "", "iti": "", "ous": "", "ive": "", "ize": "",
}

# A word is [C](VC)^m[V].  A `y` after a consonant is a vowel; the leading `y`,
# always a consonant, is written `Y` while the steps run.  Digits, `_` and `'`
# count as consonants.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
MEASURE_ABOVE_0 = f"^(?:{_C})?{_V}{_C}"
MEASURE_ABOVE_1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = "[aeiouy]"
# Measure one, ending consonant-vowel-consonant, the last not w, x or y.
SHORT_WORD = f"^{_C}[aeiouy][^aeiouwxy]$"
# A doubled consonant other than l, s, z; the last two arms settle runs of `y`.
DOUBLE_CONSONANT = r"(?:([^aeiouylsz])\1|[aeiou]y(?:yy)+|[^aeiouy](?:yy)+)$"

# Appended to a word that lost `ed` or `ing`, so that only such words are mended.
_MARK = "#"


# The word as the steps before left it, and the suffix found in it.
_W = "__w"
_SUFFIX = "__suffix"
_NO_SUFFIX = " ELSE '' END"


def _cut(letters: int | str) -> str:
    return f"left({_W}, length({_W}) - {letters})"


def _ends(*suffixes: str) -> str:
    return "(" + " OR ".join(f"endswith({_W}, '{s}')" for s in suffixes) + ")"


def _matches(text: str, pattern: str) -> str:
    return f"{text} RLIKE r'{pattern}'"


_PLURAL = f"""
    CASE WHEN NOT {_ends('s')} OR ({_ends('ss')} AND NOT {_ends('sses')}) THEN {_W}
         WHEN {_ends('sses', 'ies')} THEN {_cut(2)}
         ELSE {_cut(1)} END"""

_PAST_AND_GERUND = f"""
    CASE WHEN {_ends('eed')} THEN
              CASE WHEN {_matches(_cut(3), MEASURE_ABOVE_0)} THEN {_cut(1)} ELSE {_W} END
         WHEN {_ends('ed')} AND {_matches(_cut(2), HAS_VOWEL)} THEN concat({_cut(2)}, '{_MARK}')
         WHEN {_ends('ing')} AND {_matches(_cut(3), HAS_VOWEL)} THEN concat({_cut(3)}, '{_MARK}')
         ELSE {_W} END"""

_MEND = f"""
    CASE WHEN NOT {_ends(_MARK)} THEN {_W}
         WHEN {_matches(_cut(1), f'(?:at|bl|iz)$|{SHORT_WORD}')} THEN concat({_cut(1)}, 'e')
         WHEN {_matches(_cut(1), DOUBLE_CONSONANT)} THEN {_cut(2)}
         ELSE {_cut(1)} END"""

_FINAL_Y = f"""
    CASE WHEN {_ends('y')} AND {_matches(_cut(1), HAS_VOWEL)} THEN concat({_cut(1)}, 'i')
         ELSE {_W} END"""

_FINAL_E = f"""
    CASE WHEN {_ends('e')} AND {_matches(_cut(1), MEASURE_ABOVE_0)}
              AND NOT {_matches(_cut(1), SHORT_WORD)} THEN {_cut(1)}
         ELSE {_W} END"""

_FINAL_LL = f"""
    CASE WHEN {_ends('ll')} AND {_matches(_W, MEASURE_ABOVE_1)} THEN {_cut(1)} ELSE {_W} END"""


def _longest_suffix(table: dict[str, str]) -> str:
    """The longest suffix listed in ``table``, or an empty string."""
    longest_first = sorted(table, key=len, reverse=True)
    return "CASE " + " ".join(f"WHEN {_ends(s)} THEN '{s}'" for s in longest_first) + _NO_SUFFIX


def _replace_suffix(table: dict[str, str], measure: str) -> str:
    rest = _cut(f"length({_SUFFIX})")
    fits = f"{_SUFFIX} <> '' AND {_matches(rest, measure)}"
    if "ion" in table:  # goes only after s or t
        fits += f" AND ({_SUFFIX} <> 'ion' OR {_matches(rest, '[st]$')})"
    swaps = ", ".join(f"'{s}', '{r}'" for s, r in table.items() if r)
    ending = f"coalesce(try_element_at(map({swaps}), {_SUFFIX}), '')" if swaps else "''"
    return f"CASE WHEN {fits} THEN concat({rest}, {ending}) ELSE {_W} END"


_STEPS = [
    _PLURAL,
    _PAST_AND_GERUND,
    _MEND,
    _FINAL_Y,
    *(
        expression
        for table, measure in (
            (STEP_2, MEASURE_ABOVE_0), (STEP_3, MEASURE_ABOVE_0), (STEP_4, MEASURE_ABOVE_1)
        )
        for expression in (_longest_suffix(table), _replace_suffix(table, measure))
    ),
    _FINAL_E,
    _FINAL_LL,
]


def with_stem(df: DataFrame, word: str = "tok", stem: str = "stem") -> DataFrame:
    """Add the stem of the lower-case column ``word`` as column ``stem``."""
    others = [f"`{c}`" for c in df.columns if c != stem]
    word = f"`{word}`"
    known = f"coalesce({word}, '')"  # a column that cannot be NULL needs half the code
    columns = [
        f"CASE WHEN startswith({known}, 'y') THEN overlay({known} PLACING 'Y' FROM 1)"
        f" ELSE {known} END AS {_W}0"
    ]
    # One select: every step refers to the alias of the one before, which Spark
    # turns into one projection per step.
    at = 0
    for expression in _STEPS:
        sets_suffix = expression.endswith(_NO_SUFFIX)
        name = f"{_SUFFIX}{at}" if sets_suffix else f"{_W}{at + 1}"
        text = expression.replace(_W, f"{_W}{at}").replace(_SUFFIX, f"{_SUFFIX}{at}")
        columns.append(f"{text} AS {name}")
        at += not sets_suffix
    last = f"{_W}{at}"
    whole = (
        f"CASE WHEN length({word}) <= 2 THEN {word}"
        f" WHEN startswith({last}, 'Y') THEN lower({last}) ELSE {last} END"
    )
    # A generator stops Catalyst from pushing a later filter or join condition
    # on the stem down through the projections, multiplying them as it goes.
    return df.selectExpr(*others, *columns).selectExpr(*others, f"explode(array({whole})) AS `{stem}`")
