"""Ranked search, vector codes and repeated phrases against brute force and DuckDB."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from reviewlake.llm import codes, phrases, queries, ranked

SF = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def in_duckdb(sql):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return sorted(con.execute(sql).fetchall(), key=str)


# Ranked search

TERMS = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_ranked(docs, items, top=10):
    """Scores of every document that shares a term, by the contract's formulas."""
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in held:
            if n:
                m = 25 + 75 * n * n_docs // n_terms
                score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in Counter(terms(text)).items() if c[t])
                found += [(-score, d is None, d or 0, d)] if score > 0 else []
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def test_sql_of_the_new_queries_is_registered():
    assert set(queries.oracle_sql()) >= {"op11_ranked", "op12_codes"}


@pytest.mark.parametrize("name", ["op11_ranked", "op12_codes"])
def test_query_equals_its_sql(spark, name):
    got = queries.queries()[name](spark, SF)
    want = in_duckdb(f"SELECT {', '.join(got.columns)} FROM ({queries.oracle_sql()[name]})")
    assert want and rows_of(got) == want


@pytest.mark.parametrize("p", [ranked.Params(), ranked.Params(block_docs=7, popped=1, item_bytes=300), ranked.Params(block_postings=50, top=3)])
def test_ranked_equals_brute_force(spark, messy, p):
    df, rows = messy
    rng = random.Random(1)
    texts = [t for _, t in rows if t]
    items = [(k, " ".join(rng.choice(texts).split()[:rng.randint(1, 30)] + ["w5", "W5", "wort7É", "nowhere"])) for k in range(25)] + [(90, None), (91, " ,;. "), (92, "nowhere else")]
    made = spark.createDataFrame([(i, t, "x") for i, t in items] + [(3, items[3][1], "again")], "item_id long, text string, rank string")
    got = rows_of(ranked.ranked(df, made, p))
    assert got == slow_ranked(rows, items, p.top)
    assert len({g[:2] for g in got}) == len(got)


def test_texts_of_one_item_and_items_without_an_id(spark):
    docs = [(1, "red fox"), (2, "red red dog"), (None, "fox"), (4, None), (5, ""), (1, "red fox")]
    made = spark.createDataFrame([("a", "red"), ("a", "dog"), (None, "fox")], "item_id string, text string")
    got = ranked.ranked(spark.createDataFrame(docs, "doc_id long, text string"), made)
    assert rows_of(got) == slow_ranked(docs, [("a", "red dog"), (None, "fox")])
    assert dict(got.dtypes)["item_id"] == "string"


def test_equal_scores_come_by_id_from_many_blocks(spark):
    docs = [(k, "common words here") for k in range(500, 0, -1)] + [(k, "other text") for k in range(1000, 1600)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    item = spark.createDataFrame([(1, "words")], "item_id long, text string")
    got = rows_of(ranked.ranked(df, item, ranked.Params(block_docs=16)))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11))


def test_range_maxima():
    rng = np.random.default_rng(0)
    df = np.array([1, 17, 64, 5])
    docs = np.concatenate([np.sort(rng.choice(100, n, replace=False)) for n in df])
    impact = rng.integers(1, 9, len(docs))
    p = ranked.Postings(df, docs, impact, 100)
    start = np.cumsum([0, *df])
    for k, n in enumerate(df):
        for a in range(n):
            for b in range(a + 1, n + 1):
                at = p.largest(np.array([start[k] + a]), np.array([start[k] + b]))[0]
                assert at == start[k] + a + impact[start[k] + a:start[k] + b].argmax()


def test_search_leaves_most_documents_unscored(monkeypatch):
    """The bounds do the work: a rare term's documents are found without scoring the others."""
    n = 4096
    df = np.array([n, 12])
    docs = np.concatenate([np.arange(n), np.arange(100, n, 340)[:12]])
    impact = np.concatenate([np.full(n, 5), np.full(12, 1000)])
    search = ranked.Search(ranked.Postings(df, docs, impact, n), np.array([0, 2]), np.array([0, 1]), np.array([1, 1]), 10, 1)
    scored, bounds = [], search.bounds
    monkeypatch.setattr(search, "bounds", lambda begin, *rest: scored.append(len(begin)) or bounds(begin, *rest))
    item, doc, score = search.run(np.array([0]), np.zeros(1, np.int64))
    assert doc.tolist() == np.arange(100, n, 340)[:10].tolist() and set(score) == {1005}
    assert sum(scored) < 60


# Vector codes

def slow_codes(rows, parts=16, entries=64, rounds=2):
    """The contract in plain Python, one vector at a time."""
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    vectors = [[math.floor(Fraction(float(np.float32(x))) * 256) for x in v] for _, v, _ in kept]
    width = len(vectors[0]) // parts
    cut = [[tuple(v[k * width:(k + 1) * width]) for k in range(parts)] for v in vectors]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, vectors[n]))[:entries]
    books = [[cut[n][k] for n in first] for k in range(parts)]

    def near(k, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[k]))

    for _ in range(rounds):
        got = [[near(k, c[k])[1] for k in range(parts)] for c in cut]
        for k in range(parts):
            for n in range(len(books[k])):
                mine = [c[k] for c, g in zip(cut, got) if g[k] == n]
                if mine:
                    books[k][n] = tuple(sum(x) // len(mine) for x in zip(*mine))
    coded = [[near(k, c[k]) for k in range(parts)] for c in cut]
    errors = [sum(d for d, _ in c) for c in coded]
    label = Counter()
    for (_, _, y), e in zip(kept, errors):
        label[y] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, y, [n for _, n in c], e, label[y], sha) for (i, _, y), c, e in zip(kept, coded, errors)), key=str)


CODED = "vec_id long, embedding array<float>, label int, codes string, mark string"


def messy_vectors():
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 1) for _ in range(32)], rng.choice([0, 1, 1, 1, None])) for k in range(200)]
    rows += [(500, None, 1), (501, [None, *[0.5] * 31], 1), (502, [math.nan] * 32, 1), (503, [math.inf] * 32, None), (504, [], 0), (505, [0.0] * 32, 0), (505, [0.0] * 32, 0),
             (None, [0.25] * 32, None), (7, rows[8][1], 3), (7, rows[7][1], 0)]
    return rows


@pytest.mark.parametrize("p", [codes.Params(), codes.Params(parts=4, entries=150, rounds=3), codes.Params(parts=32, entries=3, rounds=0)])
def test_codes_equal_brute_force(spark, p):
    rows = messy_vectors()
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], CODED).repartition(4)
    got = codes.compress(df, p)
    assert rows_of(got, "vec_id", "label", "codes", "error", "label_error", "codebooks_sha256") == slow_codes(rows, p.parts, p.entries, p.rounds)


def test_masks_hold_the_nearest_entry_and_few_others():
    rng = np.random.default_rng(2)
    book, x = rng.integers(-300, 300, (64, 4)), rng.integers(-400, 400, (3000, 4))
    s = codes.Slices(book)
    code, far = s.nearest(x)
    every = ((x[:, None] - book) ** 2).sum(2)
    assert (code == every.argmin(1)).all() and (far == every.min(1)).all()
    mask = s.candidates(x, np.ceil(np.sqrt(far)).astype(np.int64), 0)
    assert (mask >> code.astype(np.uint64) & np.uint64(1)).all()
    assert np.mean([int(m).bit_count() for m in mask]) < 8


def test_codes_of_few_or_no_vectors_and_of_unfit_ones(spark):
    empty = spark.createDataFrame([], CODED)
    assert codes.compress(empty).count() == 0 and codes.train(empty) is None
    few = [(k, [float(k + j % 3) for j in range(16)], None) for k in range(3)]
    got = codes.compress(spark.createDataFrame([(*r, "", "") for r in few], CODED))
    assert rows_of(got, "vec_id", "error") == [(0, 0), (1, 0), (2, 0)]
    for bad in ([(1, [0.0] * 16), (2, [0.0] * 32)], [(1, [0.0] * 17)], [(1, [1e30] * 16)]):
        with pytest.raises(Exception, match="vectors must have one length|components beyond"):
            codes.compress(spark.createDataFrame([(*r, 0, "", "") for r in bad], CODED)).count()


def test_decoded_vectors_are_near(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    books = codes.train(df)
    got = codes.encode(df, books, keep=("vec_id",)).join(df, "vec_id").collect()
    x, back = np.array([r["embedding"] for r in got]), codes.decode(books, np.array([r["codes"] for r in got]))
    assert ((x - back) ** 2).sum() < 0.5 * ((x - x.mean(0)) ** 2).sum()


# Phrases

def slow_phrases(rows, window=35):
    split = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


PHRASED = ("doc_id", "n_words", "n_removed", "kept_sha256")
SMALL = phrases.Params(window=12, gram=4, shard_windows=40, unit=50, stretch=32, stream=3)


def test_phrases_of_messy_documents(messy):
    df, rows = messy
    assert rows_of(phrases.remove_phrases(df), *PHRASED) == slow_phrases(rows)
    assert rows_of(phrases.remove_phrases(df, SMALL), *PHRASED) == slow_phrases(rows, 12)


@pytest.mark.parametrize("p", [phrases.Params(), SMALL, phrases.Params(window=9, gram=1, shard_windows=5, unit=9, stretch=9, stream=1)])
def test_crossing_overlapping_and_hot_phrases(spark, p):
    rng = random.Random(p.window)
    passages = [[rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(rng.randint(20, 120))] for _ in range(8)]
    hot = [f"hot{k}" for k in range(p.window)]
    rows = [(1, "x " * (p.window - 1)), (2, "x " * (p.window * 4)), (3, "a\vb\x85c " * 60), (4, "a\vb\x85c " * 60), (5, "  x" * 90)]
    for k in range(10, 150):
        w = [f"own{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            q = rng.choice(passages)
            a, at = rng.randrange(len(q)), rng.randrange(len(w) + 1)
            w[at:at] = q[a:rng.randrange(a, len(q) + 1)]
        if k % 3 == 0:
            w[len(w) // 2:len(w) // 2] = hot
        rows.append((k, " \n\t"[k % 3].join(w)))
    got = phrases.remove_phrases(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), p)
    assert rows_of(got, *PHRASED) == slow_phrases(rows, p.window)
    assert all(len(r["kept"].split()) == r["n_words"] - r["n_removed"] for r in got.collect())


def test_blocks_of_words_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(9)
    base = [str(rng.randint(0, 50)) for _ in range(400)]
    rows = [(k, " ".join(base[k * 7:k * 7 + 150])) for k in range(30)]
    monkeypatch.setattr(phrases, "BLOCK", 41)
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(phrases.remove_phrases(texts), *PHRASED) == slow_phrases(rows)


def test_automaton_finds_only_confirmed_windows():
    p = phrases.Params(window=5, gram=2)
    words = [str(k).encode() for k in range(12)]
    a = phrases.Automaton([(b" ".join(words), [0, 1, 6])], p)
    def at(*stretches):
        return [x.tolist() for x in a.occurrences(list(stretches))]

    assert at(words) == [[0, 0, 0], [0, 1, 6]]
    assert at([b"other", *words[6:11], b"other", *words[2:8], *words[:5]]) == [[0, 0], [1, 13]]
    assert at(words[:3], words[3:], [], words[:5], words[1:6]) == [[1, 3, 4], [3, 0, 0]]
    assert at(words[:4]) == [[], []] == at([]) == at()


def test_words_of_any_length_and_place_are_hashed_alike(monkeypatch):
    rng = random.Random(3)
    words = [bytes(rng.choice(b"ab\x85\xc3\xff") for _ in range(n)) for n in (1, 2, 3, 5, 4095, 4096, 4097, 20_000)] * 2
    raw = [b"", b"  " + words[0], b"\x0b".join(words), b"\n", b"\t".join(reversed(words)) + b" ", b"x" * 300 + b" " + b"x" * 301, b""]
    want = [w for b in raw for w in b.split()]
    made = []
    for part in (phrases.PART, 7):
        monkeypatch.setattr(phrases, "PART", part)
        lanes, ends = phrases.word_lanes(raw)
        assert ends.tolist() == np.cumsum([len(b.split()) for b in raw]).tolist()
        made.append([tuple(x) for x in zip(*(h.tolist() for h in lanes))])
    assert made[0] == made[1] and len(made[0]) == len(want)
    assert len(set(made[0])) == len(set(want)) == len(set(zip(made[0], want)))
    assert phrases.word_lanes([])[1].tolist() == [] and phrases.word_lanes([b"", b" "])[1].tolist() == [0, 0]


def test_documents_without_a_repeat_and_no_documents(spark, empty):
    one = spark.createDataFrame([(1, " ".join(map(str, range(100)))), (None, None)], "doc_id long, text string")
    assert rows_of(phrases.remove_phrases(one), *PHRASED) == slow_phrases([(1, " ".join(map(str, range(100)))), (None, None)])
    assert phrases.remove_phrases(empty).count() == 0
    made = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked.ranked(empty, made).count() == 0 == ranked.ranked(one, made.where("false")).count()
