"""Language identification in two levels: the family, then the language within it.

Texts become vectors of hashed character n-grams.  Linear support vector
machines separate first each family from the others, and then, one for each
pair, the closely related languages of the family that won.  Every machine
is trained in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import held_out, map_texts

# Families of common language codes; others are a family of their own.
FAMILIES = {
    "germanic": "en de nl sv da no is",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk pl cs sk bg sr hr sl",
    "indo-aryan": "hi bn mr gu pa ur ne",
    "turkic": "tr az kk uz",
    "semitic": "ar he am mt",
}


@dataclass(frozen=True)
class Params:
    dims: int = 2048              # hashed n-grams
    orders: tuple[int, ...] = (1, 2, 3)
    docs_per_language: int = 1000  # bound of the labelled sample of each language
    max_docs: int = 16_000         # bound of the whole sample: with many languages each gets fewer
    max_languages: int = 1_000     # the most frequent ones are learnt; rarer labels than these teach nothing
    cost: float = 1.0
    rounds: int = 30


def family(lang: str) -> str:
    code = lang.lower().split("-")[0].split("_")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), f"only {lang}")


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; every run of other characters is one blank, also at the ends."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else text.lower()
    codes = np.frombuffer(f" {kept} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    codes = np.where((codes < 128) & ((codes < 97) | (codes > 122)), np.uint32(32), codes)
    blank = codes == 32
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def vector(text: str | None, p: Params) -> np.ndarray | None:
    """Unit vector of the square roots of n-gram counts; None without a letter."""
    codes = letters(text or "")
    if len(codes) < 2:
        return None
    counts = np.zeros(p.dims, np.float32)
    for at in range(0, len(codes), 1 << 18):  # bounded memory for very long texts
        for n in p.orders:
            part = codes[at:at + (1 << 18) + n - 1]
            if len(part) < n:
                continue
            h = np.full(len(part) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ part[k:len(part) - n + 1 + k]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            counts += np.bincount((h * np.uint32(0x9E3779B1) >> np.uint32(8)) % np.uint32(p.dims), minlength=p.dims)
    root = np.sqrt(counts)
    return root / np.linalg.norm(root)


def svm(x: np.ndarray, y: np.ndarray, cost: float, rounds: int) -> np.ndarray:
    """Weights, the constant last, of a linear machine with squared hinge loss, by dual coordinate steps."""
    x = np.c_[x, np.ones(len(x), x.dtype)].astype(np.float64)
    w, a, diag = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(1) + 0.5 / cost
    for r in range(rounds):
        moved = 0.0
        for i in np.random.default_rng(r).permutation(len(x)):
            new = max(0.0, a[i] - (y[i] * (x[i] @ w) - 1 + a[i] * 0.5 / cost) / diag[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                moved, a[i] = max(moved, abs(new - a[i])), new
        if moved < 1e-3:
            break
    return w


@dataclass(frozen=True)
class Machines:
    """Linear machines between classes; positive: the first of a pair, or a class against all others (-1)."""
    classes: tuple[str, ...]
    pairs: tuple[tuple[int, int], ...]
    weights: np.ndarray

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Shares of the classes for each row: logistic votes, made to add up to 1."""
        out = np.full((len(x), len(self.classes)), 1.0 if len(self.classes) == 1 else 0.0)
        if self.pairs:
            first = 1 / (1 + np.exp(-np.clip(4 * (x @ self.weights[:, :-1].T + self.weights[:, -1]), -30, 30)))
            for k, (i, j) in enumerate(self.pairs):
                out[:, i] += first[:, k]
                if j >= 0:
                    out[:, j] += 1 - first[:, k]
        return out / out.sum(1, keepdims=True)


@dataclass(frozen=True)
class Model:
    families: Machines
    within: dict[str, Machines]


def machine_tasks(kin: list[str], langs: list[str]) -> list[tuple[str | None, int, int]]:
    """(family, i, j) of all machines: each family against the others, each two languages of a family against each other.

    Family None stands for the families themselves.  Their number follows
    the families and the pairs of close languages, not all pairs.
    """
    families = sorted(set(kin))
    out: list[tuple[str | None, int, int]] = [(None, i, -1) for i in range(len(families))] if len(families) > 1 else []
    for f in families:
        own = sorted({lang for lang, k in zip(langs, kin) if k == f})
        out += [(f, i, j) for i in range(len(own)) for j in range(i)]
    return out


def machines(spark: SparkSession, x: np.ndarray, langs: list[str], p: Params) -> Model:
    """All machines, each trained in a task of its own; the sample's vectors, bounded by ``max_docs``, are broadcast."""
    kin = [family(lang) for lang in langs]
    jobs = machine_tasks(kin, langs)
    sample = spark.sparkContext.broadcast((x, langs, kin))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, langs, kin = sample.value
            names, families = np.array(langs), np.array(kin)
            made = []
            for job in batch.column("job").to_pylist():
                f, i, j = jobs[job]
                if f is None:
                    rows, sign = np.arange(len(x)), np.where(families == sorted(set(kin))[i], 1.0, -1.0)
                else:
                    own = sorted(set(names[families == f].tolist()))
                    rows = np.flatnonzero((names == own[i]) | (names == own[j]))
                    sign = np.where(names[rows] == own[i], 1.0, -1.0)
                made.append(svm(x[rows], sign, p.cost, p.rounds).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("job"), pa.array(made, pa.binary())], ["job", "w"])

    weights = {}
    if jobs:
        numbers = spark.createDataFrame([(k,) for k in range(len(jobs))], "job int").repartition(min(len(jobs), 256), "job")
        weights = {r["job"]: np.frombuffer(r["w"], "<f8") for r in numbers.mapInArrow(run, "job int, w binary").collect()}
    sample.unpersist()

    def of(f: str | None, classes: list[str]) -> Machines:
        own = [k for k, job in enumerate(jobs) if job[0] == f]
        return Machines(tuple(classes), tuple(jobs[k][1:] for k in own), np.array([weights[k] for k in own]).reshape(-1, x.shape[1] + 1))

    families = sorted(set(kin))
    return Model(of(None, families), {f: of(f, sorted({lang for lang, k in zip(langs, kin) if k == f})) for f in families})


def train(docs: DataFrame, p: Params = Params()) -> Model | None:
    """Fit on (text, lang) of ``docs``; null languages and texts without a letter teach nothing.

    At most ``docs_per_language`` distinct texts of each of the
    ``max_languages`` most frequent languages, and about ``max_docs`` in all, are used, chosen by the hash of the text, and their vectors, of fixed size, reach the
    driver.  None if no row is left.
    """
    h = F.xxhash64("text")
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Copies of one text are one: they must not lower the share of the others.
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang", h.alias("h")).agg(F.lit(1)).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(p.max_languages).collect()}
    if not counts:
        return None
    each = max(1, min(p.docs_per_language, p.max_docs // len(counts)))
    # A hash threshold for each language lets eight deviations more than the bound through; the rest is cut exactly.
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (each + 8 * each ** 0.5 + 32) / n))])
    some = (known.where(F.col("lang").isin(list(counts)) & (F.pmod(h, F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))).groupBy("lang", h.alias("h"))
            .agg(F.max("text").alias("text")))
    sample = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h"))).where(F.col("rank") <= each)

    def start():
        def run(texts):
            made = [vector(t, p) for t in texts]
            return [[None if v is None else v.astype("<f4").tobytes() for v in made]]
        return run

    rows = map_texts(sample, ["lang", "h"], start, "v binary").where("v IS NOT NULL").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["h"]))
    x, y = np.stack([np.frombuffer(r["v"], "<f4") for r in rows]), [r["lang"] for r in rows]
    return machines(docs.sparkSession, x, y, p)


def predict(docs: DataFrame, m: Model | None, p: Params = Params(), keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), lang_pred and score of every row.

    The score is the family's share times the language's share within it.
    ``und`` with score 0 for null texts, texts without a letter, and all
    texts if there is no model.
    """
    def start():
        def run(texts):
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            made = [(i, v) for i, t in enumerate(texts) if m and (v := vector(t, p)) is not None]
            if made:
                x = np.stack([v for _, v in made])
                shares = m.families.votes(x)
                best = shares.argmax(1)
                for f in np.unique(best):
                    own = np.flatnonzero(best == f)
                    group = m.within[m.families.classes[f]]
                    inner = group.votes(x[own])
                    for k, c in zip(own, inner.argmax(1)):
                        lang[made[k][0]] = group.classes[c]
                    score[[made[k][0] for k in own]] = shares[own, f] * inner.max(1)
            return [lang, score]
        return run

    return map_texts(docs, keep or ["doc_id"], start, "lang_pred string, score double")


def language(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; learnt from rows not held out."""
    out = held_out(F.col("doc_id"), 5, 0)
    return predict(docs, train(docs.where(~out), p), p).select("doc_id", out.alias("held_out"), "lang_pred", "score")
