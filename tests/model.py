"""Plain Python models of the operators, for comparison on small inputs."""

from __future__ import annotations

import re
from collections import Counter


def words(text: str) -> list[str]:
    return re.findall(r"[\w']+", text.lower(), re.ASCII)


def counted_words(line: str) -> list[str]:
    """What Java's split leaves: no trailing empty words, one leading if any."""
    parts = re.split(r"[^\w']+", line, flags=re.ASCII)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def lines(text: str) -> list[str]:
    parts = re.split(r"\r\n|\r|\n", text)
    return parts[:-1] if parts[-1] == "" else parts


def pairs(found_lines: list[str], vocabulary: set[str], d: int) -> Counter:
    counts: Counter = Counter()
    for line in found_lines:
        toks = words(line)
        for i, a in enumerate(toks):
            for j in range(i + 1, min(i + d, len(toks) - 1) + 1):
                b = toks[j]
                if a in vocabulary and b in vocabulary and a != b:
                    counts[a, b] += 1
                    counts[b, a] += 1
    return counts


def stripes(found_lines: list[str], vocabulary: set[str], d: int) -> Counter:
    counts: Counter = Counter()
    for line in found_lines:
        toks = words(line)
        for i, a in enumerate(toks):
            for j in range(max(0, i - d), min(len(toks) - 1, i + d) + 1):
                if i != j and a in vocabulary and toks[j] in vocabulary:
                    counts[a, toks[j]] += 1
    return counts
