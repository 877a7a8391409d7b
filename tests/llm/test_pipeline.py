"""Stages one by one and the whole run."""

import corpus_pipeline
from tidemark.llm import minhash, suffix_dedup
from tidemark.llm.queries import QUERIES


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names


def test_stages_keep_the_columns_and_do_their_work(spark, docs, sf_dir):
    columns = docs.columns
    frames = {"documents": docs}
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        current = corpus_pipeline.stored(stage(spark, current, sf_dir), f"test-{name}")
        frames[name] = current
        if name != corpus_pipeline.STAGES[-1][0]:
            assert current.columns == columns and current.count() > 0, name
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "repeats", "mix", "pack"]
    assert 0 < frames["near_dedup"].count() < frames["quality"].count() < docs.count()
    assert minhash.near_duplicates(frames["near_dedup"]).filter("NOT kept").count() == 0
    assert suffix_dedup.remove_repeats(frames["repeats"]).filter("n_removed > 0").count() <= 1
    packed = frames["pack"].groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in frames["mix"].select("doc_id").distinct().collect()}


def test_odd_documents(spark, odd_docs, no_docs, tmp_path):
    for k, frame in enumerate((odd_docs.drop("odd name"), no_docs.drop("odd name"))):
        frame.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        assert "ids_crc32" in packed.columns
        assert packed.count() > 0 if k == 0 else packed.count() == 0
