"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into passages; a distributed randomised SVD of their
TF-IDF matrix gives a small latent space.  Windows of every text as long as
the items are compared with them by cosine there, also when words were
exchanged or moved.  Copies do not depend on the space: every place where a
text has a few words in a row as an item has them is a candidate too.  Each
candidate is confirmed by the longest common subsequence of words and by the
item's answer, its last words.

Columns of the matrix are the words of the benchmark: no other word can add
to an inner product with an item.  Document frequencies and the SVD cover
all passages of all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import Scratch, bounded_batches, map_texts, unused

WORD = re.compile(r"\w+")
#: The same words by bytes: blanks for what is no part of a word, outside ASCII and in it; ASCII in lower case.
OUTSIDE = re.compile(r"[^\w\x00-\x7f]+")
WORD_BYTES = bytes(c if c > 127 else ord(chr(c).lower()) if WORD.match(chr(c)) else 32 for c in range(256))
PIECE = 1 << 20       # bytes of a text whose words are held at once
BLOCK = 1 << 18       # words searched together
MASK_BYTES = 1 << 25  # of the items' place masks that are held at once
DIGITS = 4            # of a reported cosine: float sums depend on the partitions beyond them


@dataclass(frozen=True)
class Params:
    passage: int = 64            # words of a passage of the matrix
    rank: int = 64               # latent dimensions
    oversample: int = 8
    stop_share: float = 0.05     # words in more passages than that have no weight
    windows: tuple[int, ...] = (24, 48, 96, 192, 384)  # an item is searched in windows of the next length; each doubles, the first is divided by 3
    cosine: float = 0.3
    shared: float = 0.3          # least inner product, as a share of what the item or the part of it in a window has
    gram: int = 5                # so many of the item's words in a row, or all of a shorter item, make a candidate at any cosine
    copied: float = 0.8          # of the item's words in order: contaminated
    partial: float = 0.6         # the same, if the answer is there too
    answer_words: int = 5
    few_words: int = 3           # an item with fewer different words of weight is searched everywhere,
    few_share: float = 0.1       # and one with a smaller share of them among its words
    block_words: int = 50_000    # benchmark words searched at once; more are done block after block, with the same results


@dataclass(frozen=True)
class Items:
    ids: pa.Array
    words: list[np.ndarray]      # term numbers from 1
    vocabulary: dict[str, int]


def read_items(benchmark: DataFrame) -> Items:
    """The benchmark's different items, with one vocabulary for all; null and wordless items match nothing.

    The benchmark is held whole, 4 bytes a word, and so is its vocabulary.
    """
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct().orderBy("item_id", "text")
    ids, words, numbers = [], [], {}
    for r in rows.toLocalIterator():
        if found := WORD.findall(r["text"].lower()):
            ids.append(r["item_id"])
            words.append(np.array([numbers.setdefault(w, len(numbers)) for w in found], np.int32))
    ordered = sorted(numbers)
    number = np.empty(len(ordered), np.int32)
    number[[numbers[w] for w in ordered]] = np.arange(1, len(ordered) + 1)
    kind = benchmark.select("item_id").limit(0).toArrow().schema.field("item_id").type
    return Items(pa.array(ids, kind), [number[w] for w in words], {w: k + 1 for k, w in enumerate(ordered)})


def blocks(items: Items, p: Params) -> Iterator[Items]:
    """The items in blocks of bounded size; the vocabulary stays that of all."""
    first, size = 0, 0
    for k, w in enumerate(items.words):
        if k > first and size + len(w) > p.block_words:
            yield Items(items.ids[first:k], items.words[first:k], items.vocabulary)
            first, size = k, 0
        size += len(w)
    if first < len(items.words):
        yield Items(items.ids[first:], items.words[first:], items.vocabulary)


def term_numbers(text: str, number: dict[bytes, int], kind: str) -> bytes:
    """The numbers of a text's words in lower case, 0 for words that have none; some words at a time are held."""
    b = (text if text.isascii() else OUTSIDE.sub(" ", text.lower())).encode().translate(WORD_BYTES)
    out, at = [], 0
    while at < len(b):
        end = b.find(b" ", at + PIECE)
        found = b[at:end if end >= 0 else len(b)].split()
        out.append(np.fromiter(map(number.get, found, repeat(0)), kind, len(found)).tobytes())
        at = end if end >= 0 else len(b)
    return b"".join(out)


def term_kind(items: Items) -> str:
    return "<u2" if len(items.vocabulary) < 65535 else "<u4"


def numbered(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, th, terms): every text as its words' term numbers, 0 for words outside the benchmark."""
    number, kind = {w.encode(): k for w, k in items.vocabulary.items()}, term_kind(items)

    def start():
        def run(texts):
            return [pa.array([term_numbers(t, number, kind) if t else b"" for t in texts], pa.binary())]
        return run

    return map_texts(docs.select("doc_id", F.xxhash64("text").alias("th"), "text"), ["doc_id", "th"], start, "terms binary")


def term_arrays(batch: pa.RecordBatch, items: Items) -> list[np.ndarray]:
    return [np.frombuffer(x, term_kind(items)).astype(np.int32) for x in batch.column("terms").to_pylist()]


def frequencies(texts: DataFrame, items: Items, p: Params) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and all passages; index 0 stays 0."""
    size = len(items.vocabulary) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(size, np.int64), 0
        for batch in batches:
            part, key, held = [], [], 0
            for k, a in enumerate(arrays := term_arrays(batch, items)):
                known = np.flatnonzero(a)
                part.append(a[known])
                key.append(known // p.passage + total)
                total += -(-len(a) // p.passage)
                held += len(known)
                if held and (held > BLOCK or k == len(arrays) - 1):  # bounded memory
                    a, passage = np.concatenate(part), np.concatenate(key)
                    # Sorted by term, a term's places in one passage are neighbours.
                    order = np.argsort(a.astype(np.uint16) if size < 1 << 16 else a, kind="stable")  # 16 bits sort by radix
                    a, passage = a[order], passage[order]
                    counts += np.bincount(a[np.concatenate([[True], (a[1:] != a[:-1]) | (passage[1:] != passage[:-1])])], minlength=size)
                    part, key, held = [], [], 0
        counts[0] = total
        kept = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int32)), pa.array(counts[kept])], ["term", "n"])

    out = np.zeros(size, np.int64)
    for r in texts.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row for each benchmark word
        out[r["term"]] = r["n"]
    total, out[0] = int(out[0]), 0
    return out, total


def summed(columns: np.ndarray, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row of ``columns`` the sums of its values at ``index`` in the segments from ``starts`` on: one row at a time, which stays in the cache."""
    return np.stack([np.add.reduceat(c.take(index), starts) for c in columns])


def gram_product(texts: DataFrame, items: Items, weight: np.ndarray, g: np.ndarray, p: Params) -> np.ndarray:
    """A'A g for the matrix A of all passages, each of length one: every task adds up its own rows."""
    weighted, columns = np.ascontiguousarray((g * weight[:, None]).T.astype(np.float32)), g.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(g.shape)
        for batch in batches:
            arrays = term_arrays(batch, items)
            k = 0
            while k < len(arrays):
                part, key, size, seen = [], [], 0, 0
                while k < len(arrays) and size < 1 << 17:  # bounded memory
                    held = np.flatnonzero(weight[arrays[k]] > 0)
                    part.append(arrays[k][held])
                    key.append(held // p.passage + seen)
                    seen += len(arrays[k]) // p.passage + 1
                    size += len(held)
                    k += 1
                for at in range(0, size, 1 << 18):
                    a, passage = np.concatenate(part)[at:at + (1 << 18)], np.concatenate(key)[at:at + (1 << 18)]
                    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
                    rows = summed(weighted, a, starts) / np.add.reduceat(weight[a] ** 2, starts).astype(np.float32)
                    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(a))))
                    order = np.argsort(a.astype(np.uint16) if len(weight) < 1 << 16 else a, kind="stable")  # 16 bits sort by radix
                    sorted_a = a[order]
                    first = np.flatnonzero(np.concatenate([[True], sorted_a[1:] != sorted_a[:-1]]))
                    out[sorted_a[first]] += (summed(rows, owner[order], first) * weight[sorted_a[first]].astype(np.float32)).T
        kept = np.flatnonzero(out.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int32)), *(pa.array(out[kept, c]) for c in range(columns))], ["term", *(f"c{c}" for c in range(columns))])

    schema = "term int, " + ", ".join(f"c{c} double" for c in range(columns))
    total = np.zeros(g.shape)
    for r in texts.select("terms").mapInArrow(run, schema).groupBy("term").agg(*[F.sum(f"c{c}").alias(f"c{c}") for c in range(columns)]).collect():
        total[r["term"]] = r[1:]
    return total


def latent_space(texts: DataFrame, items: Items, p: Params) -> np.ndarray:
    """For each term its weighted place in the latent space, each dimension divided by its singular value.

    Randomised SVD in one pass: a random orthonormal test matrix G through
    A'A gives Y, and Y (G'Y)^-1 Y' has nearly the same leading eigenvectors;
    they come from the singular vectors of a matrix as thin as G.
    """
    df, total = frequencies(texts, items, p)
    weight = np.log((1 + total) / (1 + df))
    weight[0] = 0
    weight[df > max(p.stop_share * total, 1)] = 0
    columns = min(p.rank + p.oversample, len(weight))
    test = np.linalg.qr(np.random.default_rng(0).standard_normal((len(weight), columns)))[0]
    sketch = gram_product(texts, items, weight, test, p)
    shift = 1e-6 * np.linalg.norm(sketch) + 1e-12  # keeps the small matrix positive definite
    sketch = sketch + shift * test
    core = np.linalg.cholesky((test.T @ sketch + sketch.T @ test) / 2)
    vectors, singular, _ = np.linalg.svd(np.linalg.solve(core, sketch.T).T, full_matrices=False)
    values = singular ** 2 - shift
    kept = np.flatnonzero(values > max(values.max(), 0) * 1e-6)[:p.rank]
    return (vectors[:, kept] / np.sqrt(values[kept]) * weight[:, None]).astype(np.float32)


def common_subsequence(masks: np.ndarray, item: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of ``terms`` with its item of at most 64 words.

    ``masks[item, term]`` has a bit for each place of the term in the item.
    """
    state = np.full(len(item), np.iinfo(np.uint64).max, np.uint64)
    flat, base = masks.ravel(), item * masks.shape[1]
    for column in terms.T:
        hit = state & flat[base + column]
        state = (state + hit) | (state - hit)
    return np.bitwise_count(~state).astype(np.int64)


def long_subsequence(item: np.ndarray, terms: np.ndarray) -> int:
    """The same for an item of any length."""
    places: dict[int, int] = {}
    for k, t in enumerate(item.tolist()):
        places[t] = places.get(t, 0) | 1 << k
    full = (1 << len(item)) - 1
    state = full
    for t in terms.tolist():
        hit = state & places.get(t, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(item) - state.bit_count()


def gram_hashes(a: np.ndarray, words: int) -> np.ndarray:
    """64 bits of the ``words`` terms from each place on."""
    out = np.full(max(len(a) - words + 1, 0), words, np.uint64)
    terms = a.astype(np.uint64)
    for k in range(words):
        out ^= terms[k:k + len(out)]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Grams:
    """Where the items have which words in a row: all runs of ``words`` terms of the items ``own``."""

    def __init__(self, words: int, own: np.ndarray, items: Items):
        self.words = words
        made = [gram_hashes(items.words[k], words) for k in own]
        every, sizes = np.concatenate(made), np.array([len(x) for x in made])
        order = np.argsort(every, kind="stable")
        self.item = np.repeat(own, sizes)[order]
        self.offset = (np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order]
        self.hash, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.sieve = np.zeros(1 << 20, bool)  # most places of a text end here
        self.sieve[self.hash >> np.uint64(44)] = True

    def places(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, item, offset) of every run that a place of ``a`` shares with an item."""
        made = gram_hashes(a, self.words)
        at = np.flatnonzero(self.sieve[made >> np.uint64(44)])
        near = np.minimum(np.searchsorted(self.hash, made[at]), len(self.hash) - 1)
        same = self.hash[near] == made[at]
        at, near = at[same], near[same]
        many = self.count[near]
        row = np.repeat(self.first[near] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(at, many), self.item[row], self.offset[row]


def searcher(items: Items, space: np.ndarray, p: Params):
    """A function from texts' terms to their matches: item -> (share, cosine, answer) of the best window."""
    space = space / max(float(np.linalg.norm(space, axis=1).max()), 1e-30)  # bounds below are relative to the longest word
    dimensions = np.ascontiguousarray(space.T)
    vectors = np.stack([space[w].sum(0) for w in items.words])
    norms = np.linalg.norm(vectors, axis=1)
    length = np.array([len(w) for w in items.words])
    window_of = np.array([next((w for w in p.windows if w >= n), p.windows[-1]) for n in length])
    groups = [(w, np.flatnonzero((window_of == w) & (norms > 1e-6))) for w in sorted(set(window_of.tolist()))]
    columns = len(items.vocabulary) + 1
    together = max(1, MASK_BYTES // (8 * columns))  # items whose masks are held at once
    held_masks: dict[int, np.ndarray] = {}

    def masks_of(some: int) -> np.ndarray:
        """Place masks of the items from ``some`` * together on; only one such group is held.

        Places beyond an item never match, so they stay set and count nothing.
        """
        if some not in held_masks:
            held_masks.clear()
            made = np.zeros((min(together, len(length) - some * together), columns), np.uint64)
            for k in range(len(made)):
                terms = items.words[some * together + k]
                if len(terms) <= 64:
                    np.bitwise_or.at(made[k], terms, np.uint64(1) << np.arange(len(terms), dtype=np.uint64))
            held_masks[some] = made
        return held_masks[some]

    answers = [w[-p.answer_words:] for w in items.words]
    weighty = np.abs(space).sum(1) > 0
    few = np.array([len(np.unique(w[weighty[w]])) < p.few_words or weighty[w].mean() < p.few_share for w in items.words])
    blind = np.flatnonzero(few | (norms <= 1e-6))  # nearly all stop words: every window is a candidate
    more = np.maximum(window_of // 2, length - window_of // 2)
    runs_of = np.minimum(length, p.gram)
    grams = [Grams(int(n), np.flatnonzero(runs_of == n), items) for n in np.unique(runs_of)]

    def likeness(x: np.ndarray, item: int) -> float:
        return float(x @ vectors[item] / max(float(np.linalg.norm(x) * norms[item]), 1e-30))

    def confirm(a: np.ndarray, item: np.ndarray, start: np.ndarray, stop: np.ndarray, cosine: np.ndarray | None, texts: list[int], found: list[dict]) -> None:
        order = np.argsort(item, kind="stable")  # neighbours read the same masks
        item, start, stop = item[order], start[order], stop[order]
        size, share, kept = stop - start, np.zeros(len(item)), [np.flatnonzero(length[item] > 64)]
        for some in np.unique(item // together):
            small = np.flatnonzero((item // together == some) & (length[item] <= 64))
            if not len(small):
                continue
            # Places of the item whose word is there at all bound the subsequence from above.
            flat, base = masks_of(int(some)).ravel(), (item[small] - some * together) * columns
            at, many, there = start[small], size[small], np.zeros(len(small), np.uint64)
            shortest = int(many.min())
            for k in range(int(many.max())):
                terms = a.take(at + k, mode="clip")
                there |= flat[base + (terms if k < shortest else terms * (many > k))]
            kept.append(small[np.bitwise_count(there) >= p.partial * length[item[small]]])
        kept = np.sort(np.concatenate(kept))
        if not len(kept):
            return
        # The words of what is left, 0 behind each end.
        item, start, size, order, share = item[kept], start[kept], size[kept], order[kept], share[kept]
        width = int(size.max())
        part = a.take(start[:, None] + np.arange(width), mode="clip")
        part[np.arange(width) >= size[:, None]] = 0
        for some in np.unique(item // together):
            small = np.flatnonzero((item // together == some) & (length[item] <= 64))
            if len(small):
                share[small] = common_subsequence(masks_of(int(some)), item[small] - some * together, part[small]) / length[item[small]]
        for k in np.flatnonzero(length[item] > 64):
            share[k] = long_subsequence(items.words[item[k]], part[k]) / length[item[k]]
        for k in np.flatnonzero(share >= p.partial):
            tail = answers[item[k]]
            views = np.lib.stride_tricks.sliding_window_view(part[k], len(tail)) if part.shape[1] >= len(tail) else np.zeros((0, len(tail)))
            answer = bool((views == tail).all(1).any())
            if share[k] >= p.copied or answer:
                own = found[texts[order[k]]]
                like = likeness(space[part[k]].sum(0), item[k]) if cosine is None else float(cosine[order[k]])
                own[int(item[k])] = max(own.get(int(item[k]), (0.0, 0.0, False)), (float(share[k]), like, answer))

    def run(arrays: list[np.ndarray]) -> list[dict[int, tuple[float, float, bool]]]:
        """Matches of each text; the texts are laid end to end and no window crosses from one to the next."""
        found: list[dict[int, tuple[float, float, bool]]] = [{} for _ in arrays]
        reach, k, rest = int(2 * max(window_of.max(), length.max())), 0, 0
        while k < len(arrays):
            pieces, owner = [], []
            while k < len(arrays) and sum(map(len, pieces)) < BLOCK:  # bounded memory; a long text goes on in the next block
                piece = arrays[k][rest:rest + BLOCK + reach]
                pieces.append(piece)
                owner.append(k)
                k, rest = (k, rest + BLOCK) if rest + len(piece) < len(arrays[k]) else (k + 1, 0)
            search(np.concatenate(pieces), np.cumsum([0, *map(len, pieces)]), owner, found)
        return found

    def copies(a: np.ndarray, bounds: np.ndarray, owner: list[int], found: list[dict]) -> None:
        for g in grams:
            at, item, offset = g.places(a)
            text = np.searchsorted(bounds, at, "right") - 1
            inside = at + g.words <= bounds[text + 1]
            text, item = text[inside], item[inside]
            # Runs of one copy point to the same beginning, or a near one if words came in or fell out.
            step = np.maximum(length[item] // 2, 1)
            begin = (at - offset)[inside] - bounds[text]
            text, item, begin = np.unique(np.stack([text, item, begin // step * step]), axis=1)
            step = np.maximum(length[item] // 2, 1)
            start, stop = bounds[text] + begin - step, bounds[text] + begin + 2 * step + length[item]
            rows = max(1, min(8192, (1 << 22) // int(3 * length.max())))
            for c in range(0, len(text), rows):
                r = slice(c, c + rows)
                confirm(a, item[r], np.maximum(start[r], bounds[text[r]]), np.minimum(stop[r], bounds[text[r] + 1]), None, [owner[t] for t in text[r].tolist()], found)

    def search(a: np.ndarray, bounds: np.ndarray, owner: list[int], found: list[dict]) -> None:
        copies(a, bounds, owner, found)
        # Sums over steps of the smallest windows; a window is three steps, a longer one three of doubled length.
        sizes, pad = np.diff(bounds), 1 << len(p.windows) - 1
        steps = -(-sizes // (p.windows[0] // 3 * pad)) * pad
        first = np.cumsum(steps) - steps
        text = np.repeat(np.arange(len(sizes)), sizes)
        held = np.flatnonzero(weighty[a])
        step_of = first[text[held]] + (held - bounds[text[held]]) // (p.windows[0] // 3)
        runs = np.flatnonzero(np.concatenate([[True], step_of[1:] != step_of[:-1]])) if len(held) else held
        total = np.zeros((int(steps.sum()), space.shape[1]), np.float32)
        if len(held):
            total[step_of[runs]] = summed(dimensions, a[held], runs).T
        count = np.bincount(step_of, minlength=len(total))
        for level, w in enumerate(p.windows):
            own = next((g for size, g in groups if size == w), None)
            if level:
                total, count = total[::2] + total[1::2], count[::2] + count[1::2]
            if own is None or not len(own):
                continue
            owner_of = np.repeat(np.arange(len(sizes)), steps >> level)
            place = np.arange(len(total)) - (first >> level)[owner_of]
            left = (steps >> level)[owner_of] - place  # steps from here to the end of the text
            sums, some = total.copy(), count.copy()
            for ahead in (1, 2):
                inside = np.flatnonzero(left > ahead)
                sums[inside] += total[inside + ahead]
                some[inside] += count[inside + ahead]
            begin = place * (w // 3)
            kept = np.flatnonzero((some >= 1) & ((place == 0) | (begin < sizes[owner_of] - w // 2)))
            # An inner product is at most the product of both norms: shorter sums reach no item.
            least = max(p.shared, 0) * (norms[own] * np.minimum(1, w / length[own])).min() * (1 - 1e-5)
            kept = kept[np.einsum("ij,ij->i", sums[kept], sums[kept]) >= least ** 2]
            text, sums = owner_of[kept], sums[kept]
            start = bounds[text] + begin[kept]
            stop = np.minimum(start + w, bounds[text + 1])
            for at in range(0, len(start), 1 << 15):
                r = slice(at, at + (1 << 15))
                x = sums[r]
                inner = x @ vectors[own].T
                row, col = np.nonzero(inner > p.shared * norms[own] ** 2 * np.minimum(1, w / length[own]))
                cosine = inner[row, col] / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[row] * norms[own][col], 1e-30)
                near = cosine >= p.cosine
                row, col, cosine = row[near] + at, col[near], cosine[near]
                for c in range(0, len(row), 8192):
                    q, item = row[c:c + 8192], own[col[c:c + 8192]]
                    # More on either side: an item seldom begins where a window does, or may be longer.
                    confirm(a, item, np.maximum(start[q] - more[item], bounds[text[q]]), np.minimum(stop[q] + more[item], bounds[text[q] + 1]),
                            cosine[c:c + 8192], [owner[t] for t in text[q].tolist()], found)
        for k in blind:
            n = int(length[k])
            member = np.zeros(len(weighty), bool)
            member[items.words[k]] = True
            inside = np.concatenate([[0], np.cumsum(member[a])])
            many = -(-sizes // n)
            text = np.repeat(np.arange(len(sizes)), many)
            start = bounds[text] + (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * n
            stop = np.minimum(start + 2 * n, bounds[text + 1])
            near = np.flatnonzero(inside[stop] - inside[start] >= p.partial * n)  # a subsequence has no more than these
            rows = max(1, min(8192, (1 << 22) // (2 * n)))
            for c in range(0, len(near), rows):
                r = near[c:c + rows]
                confirm(a, np.full(len(r), k), start[r], stop[r], None, [owner[t] for t in text[r].tolist()], found)

    return run


def matches(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, th, item_id, cosine, lcs_share, answer_found): items that a text contains, copied or reworded.

    A row for each document and item, from the window with the largest
    share of the item's words in order; th is the text's hash.  Null, empty
    and wordless texts match nothing, and an empty benchmark gives no row;
    equal rows of ``docs`` give equal rows, and equal items count once.  An
    item_id may have any type and comes back in it; two texts of one id are
    two items.  Of ``docs`` only doc_id and text are read, of ``benchmark``
    item_id and text.  Cosines are rounded to 4 decimals.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, th long, item_id {item_kind}, cosine double, lcs_share double, answer_found boolean"
    items = read_items(benchmark)
    out = spark.createDataFrame([], schema)
    if not items.words:
        return out
    texts = Scratch(spark, "decontam").store(numbered(docs, items), "terms")
    space = latent_space(texts, items, p)
    for some in blocks(items, p):
        def run(batches: Iterator[pa.RecordBatch], some=some) -> Iterator[pa.RecordBatch]:
            search = searcher(some, space, p)
            for batch in batches:
                owner, item, cosine, share, answer = [], [], [], [], []
                for k, matched in enumerate(search(term_arrays(batch, some))):
                    for i, (s, c, f) in sorted(matched.items()):
                        for column, x in zip((owner, item, cosine, share, answer), (k, i, round(c, DIGITS), s, f)):
                            column.append(x)
                at = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("th").take(at), some.ids.take(pa.array(item, pa.int64())), pa.array(cosine, pa.float64()),
                                                  pa.array(share, pa.float64()), pa.array(answer, pa.bool_())], ["doc_id", "th", "item_id", "cosine", "lcs_share", "answer_found"])

        out = out.union(texts.mapInArrow(run, schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text contains no item."""
    ident, own, other = (unused(docs, c) for c in ("_id", "_own_hash", "_hash"))
    hit = matches(docs, benchmark, p).select(F.col("doc_id").alias(ident), F.col("th").alias(other)).distinct()
    hit = Scratch(docs.sparkSession, "leaks").store(hit, "hit")
    return docs.withColumn(own, F.xxhash64("text")).join(
        hit, F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col(own) == F.col(other)), "left_anti").drop(own)
