"""The corpus operators against brute force, held-out labels and messy tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from reviewlake.llm import ann, decontam, langid, linededup, quality, queries, sharding, simhash, spm, substring, toxicity
from reviewlake.llm.common import table

SF = "/root/testdata/sf0.001"
LABELLED = "/root/testdata/sf0.01"
def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


# SimHash

def slow_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}).encode())
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(n), 2):
        if linked(i, j):
            parent[find(i)] = find(j)
    return [find(i) for i in range(n)]


def test_simhash_equals_brute_force(messy):
    df, rows = messy
    fps = [slow_fingerprint(t) for _, t in rows]
    group = groups_of(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    ids = defaultdict(list)
    for (d, _), g in zip(rows, group):
        ids[g] += [] if d is None else [d]
    want = sorted(((d, f"{f:016x}", min(ids[g], default=None)) for (d, _), f, g in zip(rows, fps, group)), key=str)
    assert rows_of(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id") == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = kept.select("doc_id", "text").collect()
    assert len(got) == len(set(group))
    assert Counter(r["doc_id"] for r in got) == Counter(min(ids[g], default=None) for g in set(group))


def test_simhash_variants_reach_every_pair_within_the_distance():
    for low_bits in (2, 4, 7):
        cut = simhash.segments(low_bits)
        assert sum(w for _, w in cut) == 64
        rng = random.Random(low_bits)
        for _ in range(300):
            flips = rng.sample(range(64), low_bits)
            assert min(sum(a <= b < a + w for b in flips) for a, w in cut) <= 1


def test_simhash_dense_bucket_needs_one_link_a_member():
    run = np.arange(512, dtype=np.uint64)
    us, vs = simhash.linked(run, 4)
    assert sum(map(len, us)) == 511
    assert {0, *np.concatenate(vs).tolist()} == set(range(512))


# Substrings

def slow_substrings(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


SUBSTRING = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_substrings_equal_brute_force(messy):
    df, rows = messy
    assert rows_of(substring.remove_repeats(df), *SUBSTRING) == slow_substrings(rows)


def test_substring_spans_of_crossing_and_self_overlapping_repeats(spark):
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(150, 700))) for _ in range(6)]
    rows = [(1, "x" * 199), (2, "x" * 900), (3, "ab" * 300)]
    for k in range(10, 90):
        t = "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 500)))
        for _ in range(rng.randint(0, 2)):
            q = rng.choice(passages)
            a = rng.randrange(len(q))
            at = rng.randrange(len(t) + 1)
            t = t[:at] + q[a:rng.randrange(a, len(q) + 1)] + t[at:]
        rows.append((k, t))
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, *SUBSTRING) == slow_substrings(rows)
    for r in got.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] == r["n_bytes"] - len(r["kept"])


# Lines

def slow_lines(rows, least=8):
    """Places of the shortest runs of enough words, by their lines, and the lines of each distinct (doc_id, text)."""
    docs = sorted({(d is None, d or 0, t) for d, t in rows if t is not None}, key=lambda x: (x[0], x[1]))
    same_id = Counter(d[:2] for d in docs)
    assert max(same_id.values()) <= 2
    runs, held = defaultdict(list), {}
    for key in docs:
        lines = [x for x in key[2].split("\n") if x.strip()]
        held[key] = lines
        for j in range(len(lines)):
            n = 0
            for k in range(j, len(lines)):
                n += len(lines[k].split())
                if n >= least:
                    runs[tuple(lines[j:k + 1])].append((key, j, k))
                    break
    return runs, held


def test_lines_equal_duckdb_on_generated_documents(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(queries.OP8_SQL).fetchall(), key=str)
    assert rows_of(queries.op8_lines(spark, SF)) == want
    assert any(r[2] for r in want)


def test_lines_of_messy_documents(messy):
    df, rows = messy
    runs, held = slow_lines(rows)
    # Two texts of one id are ordered by a hash; only runs that do not depend on it are compared.
    ids = Counter(k[:2] for k in held)
    gone = defaultdict(set)
    unsure = set()
    for places in runs.values():
        places = sorted(places, key=lambda p: (p[0][0], p[0][1], p[1]))
        tied = [p for p in places if ids[p[0][:2]] > 1]
        for n, (key, j, k) in enumerate(places):
            if n:
                gone[key] |= set(range(j, k + 1))
        if tied and len(places) > 1:
            unsure |= {p[0] for p in places}
    checked = 0
    for r in linededup.dedup(df).select("doc_id", "text", "n_lines", "n_removed").distinct().collect():
        match = [k for k in held if (k[0], k[1]) == (r["doc_id"] is None, r["doc_id"] or 0)]
        if len(match) != 1 or match[0] in unsure or len({t for d, t in rows if d == r["doc_id"]}) != 1:
            continue
        key = match[0]
        kept, j = [], 0
        for x in key[2].split("\n"):
            if not x.strip():
                kept.append(x)
                continue
            if j not in gone[key]:
                kept.append(x)
            j += 1
        want = "" if held[key] and len(gone[key]) == len(held[key]) else "\n".join(kept)
        assert (r["text"], r["n_lines"], r["n_removed"]) == (want, len(held[key]), len(gone[key]))
        checked += 1
    assert checked > 100


def test_long_runs_of_short_lines_need_several_doublings(spark):
    a = "\n".join(f"l{k}" for k in range(40))
    rows = [(1, a), (2, "head\n" + "\n".join(a.split("\n")[5:30]) + "\ntail"), (3, "\n".join(a.split("\n")[:7]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup(docs).collect()}
    assert got == {1: a, 2: "head\ntail", 3: rows[2][1]}  # seven words are no run
    assert [(r["doc"], [tuple(x) for x in r["runs"]]) for r in linededup.maximal_runs(docs).collect()] == [(2, [(1, 26)])]


def drawn_lines(seed):
    """Documents of few different lines, copies, stretches of copies and one line over and over."""
    rng = random.Random(seed)
    kinds = [" ".join(f"k{k}x{i}" for i in range(rng.choice([1, 1, 2, 4, 9]))) for k in range(12)]
    passage = [rng.choice(kinds) for _ in range(45)]
    docs = [[rng.choice(kinds) for _ in range(rng.randint(0, 12))] for _ in range(20)]
    for k in range(30):
        a = rng.randrange(45)
        docs.append([f"own {k}", *passage[a:rng.randint(a, 45)], rng.choice(kinds)])
    docs += [["k0x0"] * 21, ["a b", *["k0x0"] * 13, "c d"], *[passage] * 4, *[docs[30]] * 3]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_array_and_common_prefixes_equal_brute_force(spark, seed):
    docs = drawn_lines(seed)
    df = spark.createDataFrame([(k, "\n".join(x)) for k, x in enumerate(docs)], "doc_id long, text string").repartition(3)
    scratch = linededup.Scratch(spark, "test")
    linededup.bounded_batches(spark)
    found = scratch.store(linededup.repeated_lines(df, scratch), "found")
    placed = linededup.placed_documents(found, scratch)
    lines = scratch.store(linededup.suffixes(found.join(placed, linededup.DOC).select("base", "lines"), linededup.Params()), "lines")
    array, levels = linededup.suffix_array(lines, scratch)
    got = {r["sa"]: (r["pos"], r["lcp"]) for r in linededup.common_prefixes(array, levels, scratch).collect()}
    assert len(levels) == 7  # the passage has 45 lines
    ids = {r["pos"]: r["h"] for r in lines.collect()}
    times = Counter(x for d in docs for x in d)
    base = {r["doc"]: r["base"] for r in placed.collect()}
    assert [base[k] for k in sorted(base)] == sorted(base.values()) and len(set(base.values())) == len(base)
    want = []
    for k, d in enumerate(docs):
        for j, x in enumerate(d):
            if times[x] > 1:
                stop = next((e for e in range(j, len(d)) if times[d[e]] < 2), len(d))
                want.append(([ids[base[k] + i] for i in range(j, stop)], base[k] + j))
    want.sort()
    assert [got[k][0] for k in range(len(want))] == [pos for _, pos in want] and len(got) == len(want)
    prefixes = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for (a, _), (b, _) in itertools.pairwise(want)]
    assert [got[k][1] for k in range(len(want))] == prefixes and max(prefixes) == 45


@pytest.mark.parametrize("seed", [3, 4])
def test_runs_of_drawn_lines_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(linededup, "BLOCK", 3)  # sums, maxima and intervals pass from block to block
    docs = drawn_lines(seed)
    rows = [(k, "\n".join(x)) for k, x in enumerate(docs)]
    runs, held = slow_lines(rows)
    gone = defaultdict(set)
    for places in runs.values():
        for key, j, k in sorted(places)[1:]:
            gone[key[1]] |= set(range(j, k + 1))
    got = {r["doc"]: [tuple(x) for x in r["runs"]] for r in linededup.maximal_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: {j for a, b in x for j in range(a, b)} for d, x in got.items()} == gone
    assert all(a[1] < b[0] for x in got.values() for a, b in itertools.pairwise(x))


def test_a_run_goes_on_as_far_as_the_common_prefix_of_its_copies(spark):
    eight, more = " ".join("abcdefgh"), " ".join("ijklmnop")
    rows = [(1, f"{eight}\ntail\n{more}"), (2, f"{eight}\ntail\n{more}\nx"), (3, f"y\n{eight}\ntail\nz"), (4, f"tail\nx\n{more}")]
    scratch = linededup.Scratch(spark, "test")
    found, placed = linededup.later_copies(spark.createDataFrame(rows, "doc_id long, text string"), scratch)
    got = sorted((r["doc"], r["j"], r["len"], r["lcp"]) for r in found.join(placed, "base").collect())
    assert got == [(2, 0, 1, 2), (2, 1, 2, 2), (2, 2, 1, 1), (3, 1, 1, 2), (4, 2, 1, 1)]


# Decontamination

def test_benchmark_passages_are_found_copied_and_reworded(spark):
    docs, bench = table(spark, LABELLED, "documents"), table(spark, LABELLED, "benchmark")
    items = [(r["item_id"], decontam.WORD.findall(r["text"].lower())) for r in bench.collect()]
    items.sort()
    rng = random.Random(5)
    planted, ids = [], itertools.count(10_000_000)
    texts = [r["text"] for r in docs.select("text").limit(400).collect()]
    for item, words in items[:60]:
        if len(words) < 20:
            continue
        w = list(words)
        for k in rng.sample(range(len(w) - decontam.Params().answer_words), len(w) // 5):
            w[k] = f"other{k}"
        host = rng.choice(texts).split()
        at = rng.randrange(len(host) + 1)
        planted.append((next(ids), item, " ".join(host[:at] + w + host[at:])))
    more = spark.createDataFrame([(i, t) for i, _, t in planted], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs.select("doc_id", "text").union(more), bench).collect()}
    norm = {d: f" {' '.join(decontam.WORD.findall((t or '').lower()))} " for d, t in docs.select("doc_id", "text").collect()}
    copied = {(d, i) for d, t in norm.items() for i, w in items if f" {' '.join(w)} " in t}
    assert copied and copied <= got
    assert sum((d, i) in got for d, i, _ in planted) >= 0.95 * len(planted)
    assert not {d for d, _ in got} - {d for d, _ in copied} - {d for d, _, _ in planted}


def test_common_subsequences():
    rng = random.Random(1)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for k, y in enumerate(b):
                last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k + 1], row[k])
        return row[-1]
    for _ in range(50):
        a, b = ([rng.randint(1, 6) for _ in range(rng.randint(1, 64))] for _ in range(2))
        masks = np.zeros((1, 8), np.uint64)
        for k, t in enumerate(a):
            masks[0, t] |= np.uint64(1 << k)
        assert decontam.common_subsequence(masks, np.array([0]), np.array([b]))[0] == slow(a, b) == decontam.long_subsequence(np.array(a), np.array(b))


def drawn_items(lengths, terms):
    rng = np.random.default_rng(3)
    words = [rng.permutation(np.arange(1, terms + 1))[:n] for n in lengths]
    return decontam.Items(pa.array(range(len(lengths))), words, {f"w{k}": k for k in range(1, terms + 1)})


@pytest.mark.parametrize("size", [1.0, 1e-9])
def test_exact_copies_do_not_depend_on_the_latent_space(size):
    items = drawn_items([30, 12, 3, 1, 90], 200)
    items.vocabulary.update({f"x{k}": k for k in range(201, 211)})
    space = np.zeros((211, 4), np.float32)
    space[1:201, 0] = size
    space[201:, 1] = 100 * size  # words beside the item swamp it
    around = np.random.default_rng(4).integers(201, 211, 60)
    search = decontam.searcher(items, space, decontam.Params())
    for k, w in enumerate(items.words):
        found, = search([np.concatenate([around, w, around])])
        assert found[k][0] == 1.0 and found[k][2]
    halves = [np.concatenate([around, items.words[0][:15]]), np.concatenate([items.words[0][15:], around])]
    assert not any(0 in x for x in search(halves))


def test_latent_bounds_are_relative_to_the_space():
    items = drawn_items([40, 25], 100)
    space = np.random.default_rng(5).standard_normal((101, 8)).astype(np.float32)
    space[0] = 0
    texts = [np.where(np.arange(len(w)) % 5 == 2, 0, w) for w in items.words]  # every fifth word exchanged
    large, small = (decontam.searcher(items, space * np.float32(x), decontam.Params())(texts) for x in (1, 1e-8))
    assert [{k: (v[0], round(v[1], 4), v[2]) for k, v in x.items()} for x in large] == [{k: (v[0], round(v[1], 4), v[2]) for k, v in x.items()} for x in small]
    assert all(k in x for k, x in enumerate(large))


@pytest.mark.parametrize("weighted", [0, 1, 2])
def test_items_of_few_weighted_words_are_searched_everywhere(weighted):
    items = drawn_items([25], 40)
    items.vocabulary.update({f"x{k}": k for k in range(41, 51)})
    space = np.zeros((51, 4), np.float32)
    space[items.words[0][:weighted], 0] = 1
    space[41:, 1] = 100
    copy = np.where(np.arange(25) % 5 == 2, 0, items.words[0])  # every fifth word exchanged: no five in a row
    assert weighted < 1 or copy[0] == items.words[0][0]
    for around in (np.zeros(70, int), np.full(70, 45)):  # words without weight, and words that swamp the item's
        found, = decontam.searcher(items, space, decontam.Params())([np.concatenate([around, copy, around])])
        assert found[0][0] == 0.8


def test_benchmark_blocks_and_messy_items(spark, messy):
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8"), (2, None), (3, ""), (4, " ".join(f"w{k}" for k in range(1, 90))), (None, "w1 w2")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "z " * 40 + "w1 w2 w3 w4 w5 w6 w7 w8 " + "y " * 40), (2, " ".join(f"w{k}" for k in range(1, 90))), (3, None), (4, "")], "doc_id long, text string")
    one = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, bench).collect()}
    many = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, bench, decontam.Params(block_words=5)).collect()}
    assert one == many == {(1, 1), (2, 1), (2, 4)}
    df, _ = messy
    assert decontam.keep_clean(df, bench).columns == df.columns
    assert decontam.keep_clean(df, bench.where("false")).count() == df.count()


# SentencePiece

@pytest.fixture(scope="module")
def unigram():
    """The model file read by its own library as a unigram model: the same pieces and scores, Viterbi instead of merges."""
    raw = open(spm.MODEL, "rb").read()
    at = raw.rindex(b"tok_v0") + 6
    assert raw[at:at + 2] == b"\x18\x02"
    return sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2:])


def test_words_get_the_best_segmentation(spark, unigram):
    texts = [r["text"] for r in table(spark, SF, "documents").where("text IS NOT NULL").collect()]
    words = sorted({w for t in texts for w in t.split()})
    v = spm.load()
    score = np.full(len(v.pieces), v.scores.min() - spm.UNKNOWN_PENALTY)
    score[v.ids] = v.scores
    ours, theirs = spm.Encoder(v).encode(words), unigram.encode(words)
    # The library adds in single precision, which the penalty of an unknown character uses up.
    known = [(a, b) for a, b in zip(ours, theirs) if not set(a.tolist()) & set(v.byte_ids)]
    assert len(known) > 0.9 * len(words)
    assert sum(a.tolist() != b for a, b in known) < 0.01 * len(known)
    assert all(score[a].sum() >= score[b].sum() for a, b in known)  # where they differ, ours is as good or better


def test_viterbi_equals_trying_all_segmentations():
    v = spm.load()
    score = {v.pieces[i].decode().replace(" ", spm.BLANK): s for i, s in zip(v.ids.tolist(), v.scores.tolist())}

    def slow(word):
        best = [0.0] + [-np.inf] * len(word)
        for j in range(1, len(word) + 1):
            best[j] = max(best[i] + score.get(word[i:j], v.scores.min() - spm.UNKNOWN_PENALTY if j - i == 1 else -np.inf) for i in range(j))
        return best[-1]
    rng = random.Random(4)
    words = [spm.BLANK + "".join(rng.choice("theaonring.é日") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    by_id = np.full(len(v.pieces), np.nan)
    by_id[v.ids] = v.scores
    for word in words:
        ids = np.frombuffer(spm.best_segmentation([word], v)[0], "<i4")
        if not set(ids.tolist()) & set(v.byte_ids):
            assert by_id[ids].sum() == slow(word)


def test_long_words_are_segmented_in_stretches(monkeypatch):
    v = spm.load()
    score = np.full(len(v.pieces), v.scores.min() - spm.UNKNOWN_PENALTY)
    score[v.ids] = v.scores
    rng = random.Random(6)
    words = ["".join(rng.choice(s) for _ in range(n)) for s, n in (("abcdeinrst", 3000), ("a", 2500), ("xéß日😀", 1500), ("=-", 2000), ("theandofing", 5000))]
    whole = [np.frombuffer(b, "<i4") for w in words for b in spm.best_segmentation([w], v)]
    for size in (16, 40, 700):
        monkeypatch.setattr(spm, "LONG_WORD", size)
        for w, ids in zip(words, whole):
            made = np.frombuffer(spm.long_segmentation(w, v), "<i4")
            assert b"".join(v.pieces[i] for i in made) == b"".join(v.pieces[i] for i in ids) == w.encode()
            assert abs(score[made].sum() - score[ids].sum()) < 1e-6 * len(w)


def test_round_trip_of_any_text(spark, messy):
    df, rows = messy
    assert all(r["decoded_equal"] for r in spm.round_trip(df).collect())
    back = spm.decode(spm.encode(df, ["doc_id", "lang"]), ["doc_id", "lang"])
    assert rows_of(back, "doc_id", "text") == sorted(((d, t or "") for d, t in rows), key=str)
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab ▁\n\té😀\0<x0A>") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    v = spm.load()
    assert [spm.decode_ids(i.tolist(), v) for i in spm.Encoder(v).encode(texts)] == texts
    long = "no" * 60_000
    assert spm.decode_ids(spm.Encoder(v).encode([long])[0].tolist(), v) == long


# Classifiers

def held(doc_id, buckets, remainder):
    return zlib.crc32(str(doc_id).encode()) % buckets == remainder


def test_toxicity_on_held_out_rows(spark):
    y = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    got = queries.op9_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == table(spark, "/root/testdata/sf0.1", "documents").count()
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    pairs = [(y[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in y]
    caught = sum(a and p for a, p in pairs)
    assert caught >= 0.75 * sum(a for a, _ in pairs) and caught >= 0.95 * sum(p for _, p in pairs)


def test_quality_on_held_out_rows(spark):
    y = {r["doc_id"]: r["quality"] for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    got = queries.op1_quality(spark, "/root/testdata/sf0.1").collect()
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) and r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    pairs = [(y[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in y]
    assert np.mean([p for a, p in pairs if a]) > 0.98 and np.mean([p for a, p in pairs if not a]) < 0.1


def test_languages_of_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, LABELLED, "documents").collect()}
    got = queries.op3_language(spark, LABELLED).collect()
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in got if r["held_out"]]) > 0.98


def test_classifiers_on_messy_and_empty_tables(spark, messy, empty):
    df, rows = messy
    labels = spark.createDataFrame([(k, k % 2, int(k % 9 == 0)) for k in [*range(60), 3, 3]] + [(None, 1, 1), (61, None, None), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.where("false")
    for docs, y in ((df, labels), (df, none), (empty, labels)):
        for out in (quality.quality(docs, y), toxicity.toxicity(docs, y), langid.language(docs)):
            got = out.collect()
            assert len(got) == docs.count()
            assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in docs.collect())
            assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    und = {d for d, t in rows if not any(c.isalpha() for c in t or "")}
    assert und == {r["doc_id"] for r in langid.language(df).collect() if r["lang_pred"] == "und"} | ({None} & und)
    kept = toxicity.keep_clean(df, labels)
    assert kept.columns == df.columns


def test_copies_do_not_shrink_the_sample_of_a_language(spark):
    rng = random.Random(9)

    def text(alphabet):
        return " ".join("".join(rng.choices(alphabet, k=5)) for _ in range(12))
    rows = [("xa", text("abcdefg")) for _ in range(200)] + [("xb", text("nopqrst")) for _ in range(40)]
    docs = spark.createDataFrame([(k, lang, t) for k, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
    hot = spark.range(200_000).select("id", F.lit("xb").alias("lang"), F.when(F.col("id") % 2 == 0, F.lit("one text that is copied")).otherwise(F.concat(F.col("id").cast("string"), F.lit(" !"))).alias("text"))
    p = langid.Params(docs_per_language=30)
    m = langid.train(docs.union(hot), p)
    assert set(m.families.classes) == {"only xa", "only xb"}
    got = Counter((r["lang"], r["lang_pred"]) for r in langid.predict(docs, m, p, ["lang"]).collect())
    assert got[("xb", "xb")] >= 39 and got[("xa", "xa")] >= 198


def test_family_first():
    assert langid.family("en-GB") == langid.family("de") != langid.family("fr") == langid.family("es")
    assert langid.family("xx") == "only xx"


# Shards

def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1).max() == 1


def test_shards_hold_equal_counts(spark, messy, empty):
    df, rows = messy
    got = sharding.shards(df).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shards(empty).count() == 0
    assert {r["shard"] for r in sharding.shards(df.limit(3)).collect()} <= set(range(8))


def test_sources_that_share_a_beginning_have_cells_of_their_own(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
                                   F.when(F.col("id") % 9 > 0, F.concat(F.lit("https://host"), F.col("id") % 4)).alias("source"))
    shard = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(docs, 1).collect()}
    flat = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(docs.withColumn("source", F.substring("source", 12, 2)), 1).collect()}
    assert shard == flat  # the common beginning changes nothing


def test_written_shards_prune_in_several_dimensions(spark, tmpdir_path):
    docs = table(spark, LABELLED, "documents")
    sharding.write(docs, f"{tmpdir_path}/s", 8)
    back = spark.read.parquet(f"{tmpdir_path}/s")
    assert back.columns == docs.columns and back.exceptAll(docs).isEmpty() and back.count() == docs.count()
    ranges = back.selectExpr("input_file_name() AS f", "doc_id").groupBy("f").agg({"doc_id": "max"}).collect()
    low = back.selectExpr("input_file_name() AS f", "doc_id").groupBy("f").agg({"doc_id": "min"}).collect()
    width = np.mean([a[1] - b[1] for a, b in zip(sorted(ranges), sorted(low))])
    assert width < 0.8 * docs.count()


# Neighbours

def slow_neighbours(rows, top=20):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            out[i] = sorted(((-float((v * q).sum()), j) for j, v in ok if j != i))[:top]
    return out


def test_neighbours_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(int(k), rng.standard_normal(8).round(2).tolist()) for k in range(300)]
    rows += [(300 + k, rows[5][1]) for k in range(60)] + [(400 + k, rows[0][1]) for k in range(25)]
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [float("inf")] + [1.0] * 7), (1080, [None] + [1.0] * 7), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, score int")
    got = defaultdict(list)
    for r in ann.nearest(df, df["vec_id"] % 20 == 0, ann.Params(ratio=100.0)).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = slow_neighbours(rows)
    assert set(got) == set(want)
    for q, near in want.items():
        found = sorted(got[q])
        assert [x[0] for x in found] == list(range(1, len(near) + 1))
        assert [x[1] for x in found] == [j for _, j in near]
        assert np.allclose([x[2] for x in found], [-s for s, _ in near], rtol=0, atol=1e-12)


def test_few_candidates_and_no_vector(spark):
    df = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(4)], "vec_id long, embedding array<double>")
    assert rows_of(ann.nearest(df, df["vec_id"] % 20 == 0), "query_id", "rank", "vec_id") == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert ann.nearest(df.where("false"), df["vec_id"] % 20 == 0).count() == 0
    pairs = ann.Params(top=3, list_size=2, replicas=1, ratio=1.0)  # one list is too small for a query: it probes all
    many = spark.createDataFrame([(k, [float(k % 7), float(k)]) for k in range(40)], "vec_id long, embedding array<double>")
    assert ann.nearest(many, many["vec_id"] % 20 == 0, pairs).groupBy("query_id").count().collect()[0]["count"] == 3


def clustered(n, dim, spread, seed=0):
    """Unit vectors around centres that are unequally large."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(n // 150, 2), dim))
    weight = rng.exponential(size=len(centres))
    x = centres[rng.choice(len(centres), n, p=weight / weight.sum())] + spread * rng.standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def recall_of(spark, x, p=ann.Params()):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(6)
    got = defaultdict(set)
    for r in ann.nearest(df, df["vec_id"] % 20 == 0, p).collect():
        got[r["query_id"]].add(r["vec_id"])
    share = []
    for k in range(0, len(x), 20):
        s = x @ x[k]
        s[k] = -np.inf
        share.append(len(got[k] & set(np.lexsort((np.arange(len(x)), -s))[:20].tolist())) / 20)
    return np.mean(share)


@pytest.mark.parametrize("spread, list_size", [(0.3, 64), (0.6, 64), (0.6, 16)])
def test_recall_and_share_of_probed_lists(spark, spread, list_size):
    x = clustered(12_000, 32, spread)
    p = ann.Params(list_size=list_size)
    assert recall_of(spark, x, p) >= 0.9
    graph = ann.CentroidGraph(ann.balanced_centroids(ann.lifted(x, 1.0), len(x) // list_size), p.degree)
    some = x[ann.spaced(len(x), p.max_asked)]
    boundary, ratio = ann.fitted(graph, x, 1.0, p, some, [x[np.argsort(-(x @ q))[1:21]] for q in some])
    assert len(ann.joined(graph, ann.lifted(x, 1.0), boundary, p)[0]) < 3 * len(x)
    lists = ann.within(graph, np.c_[x[::20], np.zeros(len(x[::20]))], ratio, p.beam)[1]
    assert len(lists) < 0.2 * len(graph.c) * len(x[::20])


def test_recall_without_any_clusters(spark):
    x = np.random.default_rng(1).standard_normal((4000, 24))
    assert recall_of(spark, x / np.linalg.norm(x, axis=1, keepdims=True)) >= 0.9
    assert recall_of(spark, x) >= 0.9  # unequal norms: the longest vectors are near everything


def test_blocks_on_both_sides_give_the_same(spark):
    x = clustered(3000, 8, 0.5)
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = [rows_of(ann.nearest(df, df["vec_id"] % 20 == 0, p), "query_id", "rank", "vec_id", "score")
           for p in (ann.Params(list_size=32), ann.Params(list_size=32, block=50, asked_block=7), ann.Params(list_size=32, together=1))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 3000


def test_repeated_ids_and_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(4).round(2).tolist()) for k in range(60)]
    more = rows + [rows[7]] * 31 + [(20, [-9.0, 1.0, 1.0, 1.0]), (33, [-9.0, 2.0, 2.0, 2.0])]  # the greater vector of an id counts
    want = slow_neighbours([(i, max([v, *(w for j, w in more if j == i)])) for i, v in rows])
    df = spark.createDataFrame(more, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, df["vec_id"] % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got == {q: [j for _, j in near] for q, near in want.items()}
    with pytest.raises(ValueError, match="differ in length"):
        ann.nearest(df.union(spark.createDataFrame([(99, [1.0])], df.schema)), df["vec_id"] % 20 == 0)


def test_ties_of_many_distinct_vectors(spark):
    x = np.random.default_rng(7).integers(0, 2, (600, 14)).astype(float)
    rows = [(int(k), v) for k, v in zip(np.random.default_rng(8).permutation(600), x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = slow_neighbours(rows)
    for p in (ann.Params(ratio=100.0), ann.Params(ratio=100.0, list_size=16)):
        got = defaultdict(list)
        for r in ann.nearest(df, df["vec_id"] % 20 == 0, p).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append(r["vec_id"])
        assert got == {q: [j for _, j in near] for q, near in want.items()}


def test_no_query_is_cut_at_a_number_of_lists(spark):
    x = np.random.default_rng(6).standard_normal((1500, 12))
    rows = [(k, v) for k, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = slow_neighbours(rows)
    got = defaultdict(list)
    for r in ann.nearest(df, df["vec_id"] % 20 == 0, ann.Params(list_size=8, beam=4, ratio=100.0)).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert got == {q: [j for _, j in near] for q, near in want.items()}


def test_no_list_is_joined_or_probed_twice(spark):
    x = np.random.default_rng(2).standard_normal((3000, 6))
    graph = ann.CentroidGraph(ann.balanced_centroids(x, 1200), 16)
    ids, dist = graph.search(x[:200], 96)
    assert all(len(set(i[np.isfinite(d)].tolist())) == np.isfinite(d).sum() for i, d in zip(ids, dist))
    norm = float(np.sqrt((x * x).sum(1).max()))
    graph = ann.CentroidGraph(ann.balanced_centroids(ann.lifted(x, norm), 1200), 16)
    for row, lists in (ann.joined(graph, ann.lifted(x, norm), 1.3, ann.Params()), ann.within(graph, np.c_[x, np.zeros(len(x))], 1.05, 32)):
        assert len(set(zip(row.tolist(), lists.tolist()))) == len(row) > 3000


# Empty tables

def test_empty_documents(empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    assert substring.remove_repeats(empty).count() == 0
    assert linededup.dedup(empty).count() == 0
    assert spm.round_trip(empty).count() == 0 and spm.encode(empty).count() == 0


# Ids of other types, many languages

def test_string_ids(spark):
    line = " ".join(f"w{k}" for k in range(12))
    rows = [(f"id{k % 7}" if k != 5 else None, f"{line}\nown {k}", "en", "s") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    got = linededup.dedup(docs).select("doc_id", "text", "n_removed").collect()
    assert sum(r["n_removed"] for r in got) == 11
    first = min((r for r in rows if r[0]), key=lambda r: r[0])[0]
    assert [r["doc_id"] for r in got if not r["n_removed"]] == [first]
    out = sharding.shards(docs).collect()
    assert sorted(Counter(r["shard"] for r in out).values()) == [1] * 4 + [2] * 4 and {r["doc_id"] for r in out} == {r[0] for r in rows}


def test_more_languages_than_are_learnt(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(210):
        own = rng.sample(letters, 5)
        rows += [(4 * k + 1 + j, " ".join("".join(rng.choice(own) for _ in range(6)) for _ in range(30)), f"l{k:03d}") for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = langid.Params(rounds=3, dims=256)
    got = langid.language(docs, p).collect()
    assert len(got) == 420 and len({r["lang_pred"] for r in got}) > 150
    few = langid.language(docs, langid.Params(rounds=3, dims=256, max_languages=5)).collect()
    assert len({r["lang_pred"] for r in few}) <= 5
