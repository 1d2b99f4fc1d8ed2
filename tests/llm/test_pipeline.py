"""The pipeline, stage by stage, against the operators' plain versions."""

from collections import Counter

import corpus_pipeline
from samples import frame
from layerwell.llm import decontamination, near_dedup, packing, quality_rules
from layerwell.sinks.parquet import stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    steps = dict(corpus_pipeline.STAGES)

    cleaned = stage(steps["quality_rules"](spark, docs, SF))
    want = {}
    for r in docs.collect():
        row, left = quality_rules.clean(r.text)
        if row["kept"]:
            want[r.doc_id] = left
    assert cleaned.columns == names and {r.doc_id: r.text for r in cleaned.collect()} == want

    unique = stage(steps["simhash_dedup"](spark, cleaned, SF))
    prints = {i: near_dedup.fingerprint(t) for i, t in want.items()}
    group = {i: i for i in prints}
    changed = True
    while changed:
        best = {i: min(group[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3) for i in prints}
        changed, group = best != group, best
    assert unique.columns == names and {r.doc_id for r in unique.collect()} == set(group.values())

    cut = stage(steps["substring_dedup"](spark, unique, SF))
    seen, repeated = set(), 0
    for r in sorted(cut.collect(), key=lambda r: r.doc_id):
        assert r.n_chars == len(r.text)
        words = r.text.lower().split()
        grams = {tuple(words[p : p + 55]) for p in range(len(words) - 54)}
        repeated += bool(grams & seen)
        seen |= grams
    assert cut.columns == names and repeated == 0

    clean = stage(steps["decontamination"](spark, cut, SF))
    items = [decontamination.tokens(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: " ".join(decontamination.tokens(r.text)) for r in cut.collect()}
    leaks = {i for i, t in texts.items() if any(" ".join(x) in t for x in items)}
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == names and not leaks & kept and len(texts) - len(kept) <= len(leaks) + 1

    packed = steps["packing"](spark, clean, SF).collect()
    own = packing.encoder(packing.VOCABULARY)
    want_tokens = {r.doc_id: len(own.whole(r.text)) // 2 + 1 for r in clean.collect()}
    assert sum((Counter({r.doc_id: r.length}) for r in packed), Counter()) == Counter(want_tokens)


def test_run_and_odd_rows(spark, odd_rows):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for rows in (odd_rows, []):
        docs = frame(spark, rows)
        for name, step in corpus_pipeline.STAGES[:-1]:
            made = stage(step(spark, docs, SF))
            assert made.columns == docs.columns
            docs = made
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0
