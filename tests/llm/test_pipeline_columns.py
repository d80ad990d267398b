"""Input columns may have any names, also those the stages use themselves."""

import corpus_pipeline
from helpers import rng, sentence


def test_clashing_columns(spark, tmp_path):
    r, d = rng(5), str(tmp_path)
    texts = [sentence(r, 30) for _ in range(30)]
    texts += [texts[0], texts[1] + " tail", sentence(r, 30)]
    own = "gone_id long, gone_digest binary, id long, key string, digest binary, slot int, " \
          "mix_slot int, place int, kept boolean, score double, component_id long, uid long"
    names = [c.split()[0] for c in own.split(", ")]
    rows = [(i, t, f"s{i % 2}", i, b"x", 7, "k", b"y", 1, 2, 3, True, 0.5, 9, 8)
            for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, " + own).write.parquet(
        f"{d}/documents.parquet")
    spark.createDataFrame([(1, sentence(r, 20))], "item_id long, text string").write.parquet(
        f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(20)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:]:
        kept = stage(spark, docs, d)
        assert kept.columns[:len(docs.columns)] == docs.columns
        assert {tuple(x)[:2] for x in kept.collect()} <= {(r[0], r[1]) for r in rows}
        docs = kept
    assert docs.columns == ["doc_id", "text", "source", *names, "mix_mix_slot", "mix_place"]
    assert len(set(docs.columns)) == len(docs.columns)
    assert sorted(x.doc_id for x in docs.collect()) == sorted(set(range(33)) - {0, 31})
