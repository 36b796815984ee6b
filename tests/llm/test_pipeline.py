"""The stages of the corpus pipeline, each on its own input, against brute force."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from reviewlake.llm import decontam, simhash, toxicity
from reviewlake.llm.common import table

SF = "/root/testdata/sf0.01"


def test_stages_and_their_decisions(spark, tmpdir_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    at = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF)
        assert k == len(corpus_pipeline.STAGES) - 1 or made.columns == columns
        made.write.parquet(f"{tmpdir_path}/{name}")
        at[name] = docs = spark.read.parquet(f"{tmpdir_path}/{name}")
    text = {n: dict(d.select("doc_id", "text").collect()) for n, d in at.items() if n != "sentencepiece"}
    first = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    rejected = {r["doc_id"] for r in toxicity.toxicity(table(spark, SF, "documents"), table(spark, SF, "labels")).collect() if r["predicted"]}
    assert set(first) - set(text["toxicity"]) == rejected and all(first[i] == t for i, t in text["toxicity"].items())
    # Lines of eight words or more are there once over all documents.
    assert set(text["line_dedup"]) == set(text["toxicity"])
    lines = Counter(x for t in text["line_dedup"].values() for x in (t or "").split("\n") if len(x.split()) >= 8)
    assert max(lines.values()) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in at["line_dedup"].where("text IS NOT NULL").collect())
    # One document of each group, and every document is near a kept one or was kept.
    prints = {i: simhash.fingerprint(t) for i, t in text["line_dedup"].items()}
    group = {i: i for i in prints}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4 and find(a) != find(b):
                group[max(find(a), find(b))] = min(find(a), find(b))
    assert set(text["simhash"]) == {find(i) for i in ids}
    # No benchmark item is left word for word, and nothing else went.
    norm = {i: f" {' '.join(decontam.WORD.findall((t or '').lower()))} " for i, t in text["simhash"].items()}
    items = [" ".join(decontam.WORD.findall(r["text"].lower())) for r in table(spark, SF, "benchmark").collect()]
    holding = {i for i, t in norm.items() if any(f" {x} " in t for x in items)}
    assert holding and set(text["simhash"]) - set(text["decontamination"]) >= holding
    gone = set(text["simhash"]) - set(text["decontamination"]) - holding
    assert gone <= {r["doc_id"] for r in decontam.matches(at["simhash"], table(spark, SF, "benchmark")).collect()}
    last = at["sentencepiece"].collect()
    assert {r["doc_id"] for r in last} == set(text["decontamination"]) and all(r["decoded_equal"] and r["n_tokens"] == len(r["ids"]) for r in last)


def test_run_equals_the_stages(spark):
    made = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert made.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded_equal"] and made.count() > 0
