"""The pipeline's stages, one after the other, and the guard around them."""

from collections import Counter

import corpus_pipeline
from virotide.llm import langid

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns, name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs.collect()
    before = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id for r in seen["language"]}
    filters = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    assert kept == {i for i, r in before.items() if filters.decide(r.text)[1] >= 0.25}
    assert Counter(r.doc_id for r in seen["line_dedup"]) == Counter(kept)
    assert sum(r.n_chars for r in seen["line_dedup"]) < sum(before[i].n_chars for i in kept)
    single = Counter(r.doc_id for r in seen["simhash_near_dedup"])
    assert set(single.values()) == {1} and 0 < len(single) < len(kept)
    mixed = Counter(r.doc_id for r in seen["mix_sources"])
    assert set(mixed) <= set(single) and max(mixed.values()) > 1
    packed = Counter(r.doc_id for r in seen["best_fit_packing"] if r.piece == 0)
    assert packed == mixed


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
