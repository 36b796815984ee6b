"""Tables that every corpus operator must take."""

from __future__ import annotations

import random

import pytest

#: Columns whose names clash with what the operators compute.
EXTRA = ["score", "predicted", "th", "t", "z", "j", "h", "line", "runs", "n_lines", "n_removed", "rank", "curve", "fp", "root", "ids", "key", "_text", "_id", "_hash", "_both"]


@pytest.fixture(scope="session")
def messy(spark):
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows and extra columns."""
    rng = random.Random(7)
    words = [f"wort{k}é" if k % 7 == 0 else f"w{k}" for k in range(150)]
    line = " ".join(words[:12])
    rows = [(None, None), (None, "a b c d e"), (500, None), (501, ""), (502, " \t\n"), (503, "x"), (504, "X"), (505, "12 34"),
            (506, "lang " * 30_000), (507, line), (508, f"{line}\nmore here\n{line}"), (509, "▁ a▁b  \0 日本語😀")]
    base = [[rng.choice(words) for _ in range(70)] for _ in range(12)]
    for k in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        cut = sorted(rng.sample(range(1, 69), 4))
        rows.append((k, "\n".join(" ".join(w[a:b]) for a, b in zip([0, *cut], [*cut, 70]))))
    rows += [(7, "same row"), (7, "same row"), (8, rows[40][1])]
    full = [(i, t, ("en", "fr", "de", None)[k % 4], f"src{k % 3}" if k % 5 else None, len(t or ""), *["clash"] * len(EXTRA)) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA))
    return df.repartition(5).cache(), rows


@pytest.fixture(scope="session")
def empty(messy):
    return messy[0].where("false")
