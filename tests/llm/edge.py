"""Small documents with everything that may go wrong in one table, and plain loops to compare with."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, `row` string, bucket string, "
    "score string, tokens string, kept string, node string, starts string, `size` string"
)


def words(rng: random.Random, n: int) -> list[str]:
    return [rng.choice("alpha beta gamma delta über naïve 日本 x1 foo, bar. Ends!".split()) + str(rng.randint(0, 400)) for _ in range(n)]


def rows() -> list[tuple]:
    rng = random.Random(5)
    base, passage = words(rng, 300), words(rng, 90)
    near = [*base]
    near[10], near[200] = "changed", "too"
    texts = [
        None, "", "   \n\t ", "one two three", "One TWO three", "short", " ".join(base), " ".join(near),
        " ".join(base), "\n".join(base).upper(), " ".join(words(rng, 50) + passage + words(rng, 40)),
        " ".join(words(rng, 7) + passage), "same " * 500, "same " * 900, "aé" * 700, " ".join(words(rng, 9000)),
        " ".join(passage), "\x00odd\x1f   space s", "<|endoftext|> and <|endoftext|>", "!!! 123 ???",
        " ".join(base[:260]), " ".join(base[20:]), "de la que el", "é" * 450,
    ]
    out = [
        (i, t, ("en", "fr", None)[i % 3], ("a", "b", None, "ß")[i % 4], len(t) if t else None, *"abcdefgh")
        for i, t in enumerate(texts)
    ]
    out += [(None, " ".join(base), None, None, None, *([None] * 8)), (None, None, "en", "a", 0, *([None] * 8))]
    out += [out[6], out[3], (7, "another text under a used id, with words enough", "en", "a", 3, *"abcdefgh")]
    return out


def documents(spark, chosen=None):
    return spark.createDataFrame(rows() if chosen is None else chosen, SCHEMA)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def without_repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    lists = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def without_bytes(texts: list[str | None], length: int) -> list[tuple[int, int, int, bytes]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))


def components(pairs: list[tuple[int, frozenset]]) -> list[int]:
    """Per row the smallest id it is linked with, 0.8 or more alike."""
    above = list(range(len(pairs)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, (_, a) in enumerate(pairs):
        for j in range(i):
            b = pairs[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                above[root(i)] = root(j)
    groups: dict[int, list] = {}
    for i, (doc, _) in enumerate(pairs):
        groups.setdefault(root(i), []).append(doc)
    low = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return [low[root(i)] for i in range(len(pairs))]
