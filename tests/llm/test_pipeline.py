"""The pipeline's stages, one after the other, on a small corpus."""

import random

import corpus_pipeline
from tests.llm.test_operators import SCHEMA, clashing, prose


def test_stages(spark, tmp_path):
    rng = random.Random(8)
    item = prose(rng, 30)
    clean = [(i, "\n".join(prose(rng, 12) for _ in range(12)), "en", "s", 1) for i in range(30)]
    rows = [*clean, (100, clean[3][1], "en", "s", 1), (101, f"{prose(rng, 40)} {item} {prose(rng, 20)}", "en", "s", 1), (102, "too short", "en", "s", 1), (103, None, None, None, None), (104, prose(rng, 60, "*** "), "en", "s", 1)]
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now, kept = docs, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out-{i}"))
        now = spark.read.parquet(str(tmp_path / f"out-{i}"))
        assert name == "packing" or now.columns == docs.columns
        kept.append({r.doc_id for r in now.select("doc_id").collect()})
    whole = set(range(30))
    assert kept[0] == whole | {100, 101} and kept[1] == kept[0]
    assert kept[3] == kept[2] - {101} and whole <= kept[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()
