"""SentencePiece encoding and decoding: batched Viterbi over equal-length words.

A text is cut where no piece can reach across: before each run of blanks and
around characters that no piece holds.  Words of equal length advance
together through one lattice: hashes of all substrings of a length probe the
sorted piece keys at once, and one maximum for each position stores the back
pointers of the whole batch.  Segmentations are the best sum of the piece
scores, as in a unigram model; characters outside every piece become bytes.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import map_texts

BLANK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BASE = 0x9E3779B97F4A7C15 | 1
UNKNOWN_PENALTY = 10.0
CELLS = 1 << 20          # substrings probed at once
SEEN_BITS = 20
CACHE_WORDS = 300_000    # words whose segmentation a task remembers
TEXT_CHARS = 1 << 21     # texts segmented together
LONG_WORD = 1 << 14      # characters of a longer word are segmented a stretch at a time


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[bytes, ...]   # what an id decodes to
    keys: np.ndarray            # sorted hashes of the pieces that the lattice uses
    ids: np.ndarray             # and their ids and scores, in the same order
    scores: np.ndarray
    byte_ids: tuple[int, ...]
    longest: int
    cuts: str                   # control characters that no piece holds
    powers: np.ndarray
    seen: np.ndarray            # by a key's highest bits: whether any piece has them


def substring_keys(codes: np.ndarray, length: int, powers: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Hashes of all substrings of one length; ``prefix`` has the hashes of the prefixes."""
    return (prefix[:, length:] - prefix[:, :codes.shape[1] + 1 - length] * powers[length]) ^ np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64))


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * np.uint64(BASE) + codes[:, j] + np.uint64(1)
    return out


def matrix(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(len(words), -1)


def load(path: str = MODEL) -> Vocabulary:
    """The pieces of a model file; it must have an identity normaliser, a blank put in front, and byte pieces."""
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    if m.normalize("A  ﬁ ") != f"{BLANK}A{BLANK * 2}ﬁ{BLANK}":
        raise ValueError("only models whose normaliser keeps the text are supported")
    size = m.get_piece_size()
    text = [m.id_to_piece(i) for i in range(size)]
    byte_of = {int(text[i][3:5], 16): i for i in range(size) if m.is_byte(i)}
    if len(byte_of) != 256:
        raise ValueError("the model has no byte pieces")
    used = [i for i in range(size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    if any(BLANK in text[i].lstrip(BLANK) for i in used):
        raise ValueError("a piece has a blank after another character")
    longest = max(len(text[i]) for i in used)
    powers = np.array([pow(BASE, k, 1 << 64) for k in range(longest + 1)], np.uint64)
    keys = np.zeros(size, np.uint64)
    for n in range(1, longest + 1):
        if same := [i for i in used if len(text[i]) == n]:
            codes = matrix([text[i] for i in same])
            keys[same] = substring_keys(codes, n, powers, prefix_hashes(codes))[:, 0]
    ids = np.array(used)[np.argsort(keys[used])]
    if len(np.unique(keys[ids])) != len(ids):
        raise ValueError("two pieces share a hash")
    seen = np.zeros(1 << SEEN_BITS, bool)
    seen[(keys[ids] >> np.uint64(64 - SEEN_BITS)).astype(np.int64)] = True
    held = set("".join(text[i] for i in used))
    lattice = frozenset(used)
    decoded = tuple(bytes([int(t[3:5], 16)]) if m.is_byte(i) else t.replace(BLANK, " ").encode() if i in lattice else b""
                    for i, t in enumerate(text))
    return Vocabulary(decoded, keys[ids], ids.astype(np.int32), np.array([m.get_score(int(i)) for i in ids]),
                      tuple(byte_of[b] for b in range(256)), longest, "".join(c for c in map(chr, range(32)) if c not in held), powers, seen)


def lattice(words: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """For each place of some words of one length the best last piece before it: its length and id, -1 for an unknown character."""
    n, count = len(words[0]), len(words)
    codes = matrix(words)
    prefix = prefix_hashes(codes)
    unknown = v.scores.min() - UNKNOWN_PENALTY
    top = min(v.longest, n)
    best = np.full((count, n + 1), -np.inf)
    best[:, 0] = 0
    back, piece = np.zeros((count, n + 1), np.int16), np.full((count, n + 1), -1, np.int32)
    rows, span = np.arange(count), max(256, CELLS // max(1, count * top))
    for first in range(0, n, span):
        # Scores and ids of the pieces that end at positions first+1 .. last, by length from the longest.
        last = min(n, first + span)
        score = np.full((count, last - first, top), -np.inf)
        found = np.full((count, last - first, top), -1, np.int32)
        score[:, :, top - 1] = unknown
        for k in range(1, top + 1):
            begin = max(first, k - 1)  # position of the last character
            if begin >= last:
                continue
            keys = (prefix[:, begin + 1:last + 1] - prefix[:, begin + 1 - k:last + 1 - k] * v.powers[k]) ^ np.uint64(k * 0xD6E8FEB86659FD93 % (1 << 64))
            row, col = np.nonzero(v.seen[(keys >> np.uint64(64 - SEEN_BITS)).astype(np.int32)])  # few pass without being a piece
            probe = keys[row, col]
            at = np.minimum(np.searchsorted(v.keys, probe), len(v.keys) - 1)
            hit = v.keys[at] == probe
            row, col, at = row[hit], col[hit] + begin - first, at[hit]
            score[row, col, top - k] = v.scores[at]
            found[row, col, top - k] = v.ids[at]
        for j in range(first + 1, last + 1):
            reach = min(top, j)
            paths = best[:, j - reach:j] + score[:, j - 1 - first, top - reach:]
            choice = paths.argmax(1)  # the first maximum: the longest piece
            best[:, j] = paths[rows, choice]
            back[:, j] = reach - choice
            piece[:, j] = found[rows, j - 1 - first, top - reach + choice]
    return back, piece


def long_segmentation(word: str, v: Vocabulary) -> bytes:
    """The same for one long word, in bounded memory.

    The best paths to the last places of a stretch, as many as a piece is
    long, have a place in common further back: every longer path goes
    through it, so the pieces before it are final and the next stretch
    starts there.
    """
    out, at, size = [], 0, LONG_WORD
    while at < len(word):
        part = word[at:at + size]
        back, piece = (x[0] for x in lattice([part], v))
        common = len(part)
        if at + size < len(word):
            live = set(range(max(0, len(part) - v.longest + 1), len(part) + 1))
            while len(live) > 1:
                last = max(live)
                live.remove(last)
                live.add(last - int(back[last]))
            common = live.pop()
            if not common:
                size *= 2
                continue
        ids, end = [], common
        while end:
            own = int(piece[end])
            ids += [own] if own >= 0 else [v.byte_ids[b] for b in reversed(part[end - 1].encode())]
            end -= int(back[end])
        out.append(np.array(ids[::-1], "<i4").tobytes())
        at, size = at + common, LONG_WORD
    return b"".join(out)


def best_segmentation(words: list[str], v: Vocabulary) -> list[bytes]:
    """Ids (little-endian int32) of each of some words of one length; ties take the longer last piece."""
    back, piece = lattice(words, v)
    n, count = len(words[0]), len(words)
    rows = np.arange(count)
    chain, at = [], np.full(count, n)
    while (at > 0).any():
        chain.append((np.where(at > 0, piece[rows, at], -2), at))
        at = at - np.where(at > 0, back[rows, at], 0)
    ids = np.stack([c for c, _ in reversed(chain)], 1)
    if not (ids == -1).any():
        return [r[r >= 0].astype("<i4").tobytes() for r in ids]
    ends = np.stack([e for _, e in reversed(chain)], 1)
    out = []
    for word, r, e in zip(words, ids.tolist(), ends.tolist()):
        made: list[int] = []
        for i, end in zip(r, e):
            if i >= 0:
                made.append(i)
            elif i == -1:
                made += [v.byte_ids[b] for b in word[end - 1].encode()]
        out.append(np.array(made, "<i4").tobytes())
    return out


class Encoder:
    """Segments lists of texts; remembers a bounded number of words."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}
        cut = re.escape(v.cuts)
        self.cutter = re.compile(f"[{cut}]|{BLANK}*[^{BLANK}{cut}]+|{BLANK}+" if cut else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self.literal = np.array([v.byte_ids[b] for b in BLANK.encode()], "<i4").tobytes()

    def words(self, text: str | None) -> list[list[str]]:
        """Words of the stretches between literal U+2581 signs, which are encoded as bytes."""
        if not text:
            return [[]]
        stretches = [s.replace(" ", BLANK) for s in text.split(BLANK)]
        if stretches[0]:
            stretches[0] = BLANK + stretches[0]
        return [self.cutter.findall(s) for s in stretches]

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        by_length: dict[int, list[str]] = {}
        for w in words - self.known.keys():
            by_length.setdefault(len(w), []).append(w)
        for n, same in by_length.items():
            if n > LONG_WORD:
                self.known.update((w, long_segmentation(w, self.v)) for w in same)
                continue
            step = max(1, CELLS // (n * min(n, self.v.longest)))
            for k in range(0, len(same), step):
                self.known.update(zip(same[k:k + step], best_segmentation(same[k:k + step], self.v)))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out, k = [], 0
        while k < len(texts):
            group, chars = [], 0
            while k < len(texts) and (not group or chars < TEXT_CHARS):
                group.append(self.words(texts[k]))
                chars, k = chars + len(texts[k] or ""), k + 1
            self.learn({w for t in group for s in t for w in s})
            out += [np.frombuffer(self.literal.join(b"".join(map(self.known.__getitem__, s)) for s in t), "<i4") for t in group]
        return out


def decode_ids(ids, v: Vocabulary) -> str:
    """The text of a sequence of ids: the blank put in front is taken off again."""
    return b"".join(map(v.pieces.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


def lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)))


def encode(docs: DataFrame, keep: list[str] | None = None, model: str = MODEL) -> DataFrame:
    """``keep`` columns (default doc_id), ``ids`` array<int>, ``n_tokens`` and ``decoded_equal`` of every row.

    Null and empty texts have no ids.  Whole texts are encoded, however
    long, and decoded again to compare; columns not named are not read.
    """
    v = load(model)

    def start():
        e = Encoder(v)

        def run(texts):
            ids = e.encode(texts)
            return [lists(ids), np.array([len(i) for i in ids], np.int64),
                    np.array([decode_ids(i.tolist(), v) == (t or "") for i, t in zip(ids, texts)], bool)]
        return run

    return map_texts(docs, keep or ["doc_id"], start, "ids array<int>, n_tokens long, decoded_equal boolean")


def decode(encoded: DataFrame, keep: list[str] | None = None, model: str = MODEL) -> DataFrame:
    """``keep`` columns and ``text`` of every row of ``ids``; null ids give an empty text."""
    v = load(model)

    def start():
        return lambda rows: [pa.array([decode_ids(r or [], v) for r in rows], pa.string())]

    return map_texts(encoded, keep or ["doc_id"], start, "text string", text="ids")


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_bytes, n_tokens, ids_sha256 (of little-endian int32 ids) and whether the ids decode to the text."""
    v = load(model)

    def start():
        e = Encoder(v)

        def run(texts):
            ids = e.encode(texts)
            return [np.array([len((t or "").encode()) for t in texts], np.int64), np.array([len(i) for i in ids], np.int64),
                    [hashlib.sha256(i.tobytes()).hexdigest() for i in ids],
                    np.array([decode_ids(i.tolist(), v) == (t or "") for i, t in zip(ids, texts)], bool)]
        return run

    return map_texts(docs, ["doc_id"], start, "n_bytes long, n_tokens long, ids_sha256 string, decoded_equal boolean").select(
        F.col("doc_id"), "n_bytes", "n_tokens", "ids_sha256", "decoded_equal")
