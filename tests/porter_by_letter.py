"""Porter's algorithm letter by letter, to check the expression form against."""

from __future__ import annotations

# The published rules, by the letter before the last as the paper
# lists them, written out here so that the tables under test are not their own check.
STEP_2 = dict(
    rule.split(">") for rule in
    "ational>ate tional>tion " "enci>ence anci>ance " "izer>ize " "bli>ble alli>al entli>ent eli>e ousli>ous "
    "ization>ize ation>ate ator>ate " "alism>al iveness>ive fulness>ful ousness>ous " "aliti>al iviti>ive biliti>ble "
    "logi>log".split()
)
STEP_3 = dict(rule.split(">") for rule in "icate>ic ative> alize>al " "iciti>ic " "ical>ic ful> " "ness>".split())
STEP_4 = dict.fromkeys(
    "al " "ance ence " "er " "ic " "able ible " "ant ement ment ent " "ion ou " "ism " "ate iti " "ous " "ive " "ize".split(), ""
)


def shape(word: str) -> str:
    """``c`` or ``v`` for every letter."""
    out = ""
    for i, letter in enumerate(word):
        if letter in "aeiou":
            out += "v"
        elif letter == "y" and i and out[-1] == "c":
            out += "v"
        else:
            out += "c"
    return out


def measure(word: str) -> int:
    return shape(word).count("vc")


def has_vowel(word: str) -> bool:
    return "v" in shape(word)


def doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c"


def short_end(word: str) -> bool:
    return shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def swap(word: str, table: dict[str, str], above: int) -> str:
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            rest = word[: len(word) - len(suffix)]
            fits = measure(rest) > above and (suffix != "ion" or rest[-1:] in ("s", "t"))
            return rest + table[suffix] if fits else word
    return word


def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    w = word
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]

    cut = ""
    if w.endswith("eed"):
        if measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and has_vowel(w[:-2]):
        cut = "ed"
    elif w.endswith("ing") and has_vowel(w[:-3]):
        cut = "ing"
    if cut:
        w = w[: -len(cut)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif doubled(w):
            if w[-1] not in "lsz":
                w = w[:-1]
        elif measure(w) == 1 and short_end(w):
            w += "e"

    if w.endswith("y") and has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = swap(w, STEP_2, 0)
    w = swap(w, STEP_3, 0)
    w = swap(w, STEP_4, 1)

    if w.endswith("e"):
        m = measure(w[:-1])
        if m > 1 or (m == 1 and not short_end(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and measure(w) > 1:
        w = w[:-1]
    return w
