import hashlib

import corpus_pipeline
from accesslens.llm import catalog
from tests.llm.cases import rows

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_all_are_run(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
        kept.append(after.count())
        before = after
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.4 * docs.count()
    last = spark.read.parquet(f"{tmp_path}/{len(corpus_pipeline.STAGES) - 2}")
    texts = {r.doc_id: r.text for r in last.collect()}
    for r in before.collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.n_tokens * 4 == len(r["ids"])
    again = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, r.ids_sha256) for r in again.collect()} == {(r.doc_id, r.ids_sha256) for r in before.collect()}


def test_stages_bear_awkward_documents(spark):
    texts = [(1, None), (2, ""), (None, "words of no document"), (4, "one line\nand another one\n" * 3), (4, "one line\nand another one\n" * 3)]
    frame = spark.createDataFrame([r[:6] for r in rows(texts)], "doc_id long, text string, lang string, source string, n_chars long, score double")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, frame, SF)
        assert out.count() <= len(texts), name
        assert stage(spark, frame.limit(0), SF).count() == 0, name
    assert corpus_pipeline.quality_classifier(spark, frame, SF).columns == frame.columns


def test_one_query_a_number():
    names = sorted(int(n[2:].split("_")[0]) for n in catalog.queries())
    assert names == list(range(1, 14))
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
