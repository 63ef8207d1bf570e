import zlib

import corpus_pipeline
import numpy as np
from docframe.llm import packing, quality


def test_stages_and_run(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    kept, before = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf).cache()
        assert after.columns == docs.columns
        kept[name] = [r.doc_id for r in after.select("doc_id").collect()]
        before = after
    scores = {r.doc_id: r.score for r in quality.QualityModel.fit(docs, spark.read.parquet(f"{sf}/labels.parquet")).apply(docs).collect()}
    assert set(kept["quality"]) == {i for i, s in scores.items() if s >= 0.3}
    text = {r.doc_id: r.text for r in docs.collect()}
    last = {}
    for i in sorted(kept["quality"]):
        last[text[i]] = i
    assert sorted(kept["exact_dedup"]) == sorted(last.values())
    assert set(kept["mixing"]) <= set(kept["near_dedup"]) <= set(kept["exact_dedup"])
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(kept["mixing"])
    whole = next(i for i in kept["mixing"] if kept["mixing"].count(i) == 1 and len(packing.encode(text[i])) < 2000)
    ids = np.array([*packing.encode(text[whole]), 1], "<u4")
    parts = sorted((r for r in rows if r.doc_id == whole), key=lambda r: r.start)
    if parts[0].doc_tokens == len(ids):
        assert [r.ids_crc32 for r in parts] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in parts]
