"""Small tables with every awkward case, and plain reference versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

# Names that operators use inside; a table may have columns of these names too.
CLASHING = "row key size kept doc part packed place label target copies score predicted digest sketch shared quality word".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "", ",", ".")) for _ in range(n))


def changed(text: str, seed: int, times: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty, tiny and very long texts, copies, near copies, a passage that many
    rows share, text that repeats itself, ties, and rows that repeat as a whole."""
    base, passage = prose(1, 300), prose(2, 90)
    texts = [
        base,
        base.upper(),
        base.replace(" ", "  \t"),
        changed(base, 3, 4),
        changed(base, 4, 6),
        changed(base, 5, 60),
        None,
        "",
        "\n \t\x0b\f\r",
        "one",
        "two words",
        "One",
        "ÄÖ é́ ß 漢字 ½ İ \x1c x",
        "Released under the MIT License.\n" + prose(6, 40),
        "the MIT-license, MIT\nlicense; Apache License and GNU General Public License " + prose(7, 60),
        "x" * 3000,
        "ab " * 2000,
        "\n".join(["The same line again and again, no more and no less than that."] * 30),
        prose(8, 9000),
        prose(8, 9000) + " tail",
        *(prose(20 + i, 40 + i) + " " + passage + " " + prose(60 + i, 30) for i in range(12)),
        *(prose(100 + i, 30) for i in range(8)),
    ]
    rows = [(i * 3, t, "en", f"s{i % 4}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append((5, base, None, None, None))  # a copy whose columns are null
    rows.append((None, base, "en", "s1", 3))
    rows.append((None, None, None, None, None))
    rows += [rows[0], rows[0], rows[22], rows[7]]  # whole rows again
    return rows


def messy(spark, clash: bool = True, rows: list[tuple] | None = None, parts: int = 3):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(messy_rows() if rows is None else rows, SCHEMA).repartition(parts)
    if clash:
        docs = docs.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))
    return docs


def written(docs, folder) -> object:
    path = str(folder)
    docs.write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.parquet(path)


def counted(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def normal(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def weighted_similarity(a: str, b: str) -> float:
    first, second = shingles(a), shingles(b)
    total = sum((first | second).values())
    return sum((first & second).values()) / total if total else 1.0


def shingles(text: str, n: int = 5) -> Counter:
    words = split(text.lower())
    return Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else Counter()


def near_classes(rows: list[tuple]) -> list[int]:
    """The index of a root for each row, by all pairs."""
    texts = [(r[1] or "") for r in rows]
    keys = [tuple(split(t.lower())) for t in texts]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and (
                keys[i] == keys[j] or (keys[i] and keys[j] and weighted_similarity(texts[i], texts[j]) >= 0.8)
            ):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def removed_bytes(texts: list[bytes], size: int = 200) -> list[np.ndarray]:
    """Which bytes of each text go: windows that start in two places."""
    starts = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if starts[t[i : i + size]] > 1:
                gone[i : i + size] = True
        out.append(gone)
    return out


def kept_words(rows: list[tuple], size: int = 50) -> list[list[bytes]]:
    """The words of each row that stay: no window over them starts in a row of a smaller id."""
    order = [float("inf") if r[0] is None else r[0] for r in rows]
    words = [split(r[1]) for r in rows]
    first: dict[tuple, float] = defaultdict(lambda: float("inf"))
    for at, own in zip(order, words):
        for i in range(len(own) - size + 1):
            window = tuple(own[i : i + size])
            first[window] = min(first[window], at)
    out = []
    for at, own in zip(order, words):
        gone = [False] * len(own)
        for i in range(len(own) - size + 1):
            if first[tuple(own[i : i + size])] < at:
                gone[i : i + size] = [True] * size
        out.append([w for w, g in zip(own, gone) if not g])
    return out
