"""Plain Python models to compare with: dynamic programming and brute force, on small inputs."""

import re


def lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[-1], row[j] + 1 if x == y else 0))
        row = new
    return row[-1]


def score(a: str, b: str, digits: int) -> float:
    total = len(a) + len(b)
    return round(100 * (2 * lcs(a, b) / total if total else 1.0), digits)


def fast_form(text: str) -> str:
    for ch in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
        text = text.lower().replace(ch, " ")
    return " ".join(sorted(w for w in text.split(" ") if w))


def fuzzy_form(text: str) -> str:
    kept = "".join(ch for ch in text if not 128 <= ord(ch) <= 255)
    return " ".join(sorted(re.sub(r"\W", " ", kept).lower().split()))


def best(items, candidates, cutoff, k, digits):
    """``items``: set of (block, text); ``candidates``: list of (block, id, text)."""
    out = set()
    for block, text in items:
        scored = [(-score(text, t, digits), i) for b, i, t in candidates if b == block]
        kept = sorted(s for s in scored if -s[0] >= cutoff)[:k]
        out |= {(block, text, i, -s, rank) for rank, (s, i) in enumerate(kept, start=1)}
    return out
