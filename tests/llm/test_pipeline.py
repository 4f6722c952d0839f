"""The pipeline's stages on the smallest tables, each against its own input."""

import corpus_pipeline
from strata.session import cut_lineage
from tests.llm import cases
from tests.llm.test_mixing import plain_targets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = [], docs
    columns = docs.columns
    results = {"input": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        kept = cut_lineage(stage(spark, kept, SF), name)
        results[name] = kept.collect()
        assert kept.columns[: len(columns)] == columns
    assert names == ["language", "near_duplicates", "benchmark", "mixing", "sharding"]
    spoken = {r["doc_id"] for r in results["input"] if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in results["language"]} <= spoken and len(results["language"]) >= 0.99 * len(spoken)

    want = cases.components({r["doc_id"]: cases.shingles(r["text"], 5) for r in results["language"]})
    assert {r["doc_id"] for r in results["near_duplicates"]} == set(want.values())

    items = [cases.shingles(r["text"], 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = set()
    for r in results["near_duplicates"]:
        have = cases.shingles(r["text"], 5)
        if not any(100 * len(have & item) >= 80 * len(item) for item in items if item):
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in results["benchmark"]} == clean

    sizes, taken = {}, {}
    for r in results["benchmark"]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(cases.words(r["text"]))
    for r in results["mixing"]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(cases.words(r["text"]))
    longest = max(len(cases.words(r["text"])) for r in results["benchmark"])
    for source, target in plain_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 2 * longest + 1

    assert sorted(r["doc_id"] for r in results["sharding"]) == sorted(r["doc_id"] for r in results["mixing"])
    assert all(r["oversized"] or r["shard_bytes"] <= 1 << 20 for r in results["sharding"])


def test_stages_bear_messy_documents(spark):
    kept = cases.messy(spark)
    for name, stage in corpus_pipeline.STAGES:
        kept = cut_lineage(stage(spark, kept, SF), name)
        assert set(cases.SCHEMA.names) - {"shard"} <= set(kept.columns)
    assert kept.count() > 0
    kept = cases.empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        kept = cut_lineage(stage(spark, kept, SF), name)
    assert kept.count() == 0
