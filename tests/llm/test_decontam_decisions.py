"""Decisions of the decontamination against plain Python, block sizes and kinds of item ids."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from reviewlake.llm import decontam


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k + 1], row[k])
    return row[-1]


def slow_matches(texts, items, p):
    """Every window and every shared run of five words is a candidate, each decided by its definition."""
    out = []
    for text in texts:
        found = {}
        for i, item in enumerate(items):
            n = len(item)
            w = next((w for w in p.windows if w >= n), p.windows[-1])
            more, step, g = max(w // 2, n - w // 2), max(n // 2, 1), min(n, p.gram)
            regions = {(b - more, b + w + more) for b in range(0, len(text), w // 3) if (b == 0 or b < len(text) - w // 2) and any(text[b:b + w])}
            regions = {(a, min(b, len(text) + more)) for a, b in regions}
            for at in range(len(text) - g + 1):
                for o in range(n - g + 1):
                    if text[at:at + g] == item[o:o + g]:
                        begin = (at - o) // step * step
                        regions.add((begin - step, begin + 2 * step + n))
            for a, b in regions:
                part = text[max(a, 0):b]
                share = slow_lcs(item, part) / n
                tail = item[-p.answer_words:]
                answer = any(part[k:k + len(tail)] == tail for k in range(len(part)))
                if share >= p.copied or share >= p.partial and answer:
                    found[i] = max(found.get(i, (0, False)), (share, answer))
        out.append(found)
    return out


def test_decisions_equal_plain_python():
    rng = random.Random(2)
    terms = 60
    items = [[rng.randint(1, terms) for _ in range(n)] for n in (1, 4, 9, 20, 30, 41, 70)]
    texts = []
    for k in range(60):
        text = [rng.randint(0, terms) for _ in range(rng.randint(0, 120))]
        item = list(items[k % len(items)])
        for _ in range(rng.choice([0, len(item) // 5, len(item) // 3, len(item) // 2])):
            if rng.random() < 0.5 and len(item) > 1:
                del item[rng.randrange(len(item))]
            else:
                item[rng.randrange(len(item))] = 0
        at = rng.randrange(len(text) + 1)
        texts.append(text[:at] + item + text[at:])
    texts += [[], [0] * 30]
    space = np.abs(np.random.default_rng(1).standard_normal((terms + 1, 8))).astype(np.float32)
    space[0] = 0
    p = decontam.Params(cosine=-1, shared=-1)
    held = decontam.Items(pa.array(range(len(items))), [np.array(x, np.int32) for x in items], {f"w{k}": k for k in range(1, terms + 1)})
    got = decontam.searcher(held, space, p)([np.array(t, np.int32) for t in texts])
    want = slow_matches(texts, items, p)
    assert sum(map(len, want)) > 30
    assert [{i: round(v[0], 12) for i, v in x.items()} for x in got] == [{i: round(v[0], 12) for i, v in x.items()} for x in want]


def test_masks_in_parts_decide_alike(monkeypatch):
    rng = np.random.default_rng(3)
    items = [rng.integers(1, 50, n).astype(np.int32) for n in (8, 30, 30, 12, 70)]
    texts = [np.concatenate([rng.integers(0, 50, 40), items[k % 5], rng.integers(0, 50, 40)]).astype(np.int32) for k in range(15)]
    space = rng.standard_normal((50, 8)).astype(np.float32)
    space[0] = 0
    held = decontam.Items(pa.array(range(5)), items, {f"w{k}": k for k in range(1, 50)})
    whole = decontam.searcher(held, space, decontam.Params())(texts)
    monkeypatch.setattr(decontam, "MASK_BYTES", 8 * 50 * 2)
    assert decontam.searcher(held, space, decontam.Params())(texts) == whole
    assert all(k % 5 in x for k, x in enumerate(whole))


def test_words_by_bytes_are_the_words_of_the_pattern(monkeypatch):
    texts = ["", "Plain ASCII_word x1\t\x1c y-z", "Ünï cödé «quoted» a b c", "İstanbul ΟΔΟΣ ΣΑΣ' ΑΣ'Α", "日本語。テスト", "é ١٢ ²", " " * 50 + "end"]
    number = {w.encode(): k + 1 for k, w in enumerate(sorted({w for t in texts for w in decontam.WORD.findall(t.lower())}))}
    for piece in (decontam.PIECE, 3):
        monkeypatch.setattr(decontam, "PIECE", piece)
        for t in texts:
            want = [number[w.encode()] for w in decontam.WORD.findall(t.lower())]
            assert np.frombuffer(decontam.term_numbers(t, number, "<u2"), "<u2").tolist() == want


@pytest.mark.parametrize("kind", ["string", "int", "long", "date"])
def test_item_ids_of_any_type_and_blocks_of_any_size(spark, kind):
    rng = random.Random(4)
    item = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(30)) for _ in range(12)]
    rows = [(k, t) for k, t in enumerate(item)] + [(3, item[3]), (3, item[4]), (None, item[5]), (20, "")]
    bench = spark.createDataFrame(rows, "n long, text string").selectExpr("CAST(DATE'2020-01-01' + CAST(n AS INT) AS DATE) AS item_id" if kind == "date" else f"CAST(n AS {kind}) AS item_id", "text")
    docs = [(k, " ".join(f"v{rng.randint(0, 99)}" for _ in range(60)) + " " + t) for k, t in enumerate(item)]
    docs += [(100 + k, " ".join(w if j % 6 else "other" for j, w in enumerate(t.split()))) for k, t in enumerate(item)] + [(1, docs[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [sorted(map(tuple, decontam.matches(df, bench, decontam.Params(block_words=n)).collect()), key=str) for n in (50_000, 100, 1)]
    assert got[0] == got[1] == got[2]
    assert dict(decontam.matches(df, bench).dtypes)["item_id"] == {"long": "bigint"}.get(kind, kind)
    ids = dict(zip(range(12), [r[0] for r in bench.limit(12).collect()]))
    assert {(r[0], r[2]) for r in got[0]} >= {(k, ids[k]) for k in range(12)} | {(4, ids[3])}
    assert sum(r[0] == 1 for r in got[0]) == 2  # equal rows give equal rows
