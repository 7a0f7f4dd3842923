"""The pipeline on the smallest table: what each stage may and may not do."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm import brute


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    good = P.filter_by_quality(spark, docs, sf).cache()
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == columns
    assert all((d in kept) == (r["quality"] == 1) for d, r in labels.items())

    single = P.drop_near_duplicates(spark, good, sf).cache()
    roots = brute.near_components({d: texts[d] for d in kept}, P.SHINGLE, 80)
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for c in roots.values()})

    clean = P.mask_personal_data(spark, single, sf).cache()
    assert clean.columns == columns and clean.count() == single.count()
    for r in clean.collect():
        assert not brute.personal(r["text"])
        if not brute.personal(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]

    mixed = P.mix_to_weights(spark, clean, sf).cache()
    assert mixed.columns == columns
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in clean.collect()}

    encoded = P.encode(spark, mixed, sf)
    assert encoded.count() == mixed.count()
    assert encoded.where("NOT exact").isEmpty()


def test_repeated_rows_leave_one(spark, sf, make):
    text = "one two three four five six seven eight"
    docs = make([(1, text), (1, text), (2, text), (None, text), (3, ""), (3, ""), (4, None)])
    rows = P.drop_near_duplicates(spark, docs, sf)
    assert rows.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in rows.where("text <> ''").collect()) == [(1, text)]
    assert rows.count() == 4


def test_run_over_everything(spark, sf):
    rows = P.run(spark, sf)
    assert rows.columns == ["doc_id", "lang", "source", "ids", "n_pieces", "exact"]
    assert rows.count() > 50


RESERVED = ["__text", "__doc_id", "__row", "__hit", "__spans", "__source", "__mix", "__TEXT_"]


def test_columns_with_the_names_used_inside(spark, sf, make):
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "mail a.b@example.org now"), (4, None)]
    docs = make(rows)
    for i, name in enumerate(RESERVED):
        docs = docs.withColumn(name, F.lit(f"kept {i}"))
    for stage in (P.drop_near_duplicates, P.mask_personal_data, P.mix_to_weights):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        found = out.collect()
        assert all(r[name] == f"kept {i}" for r in found for i, name in enumerate(RESERVED))
        if stage is P.drop_near_duplicates:
            assert sorted(r["doc_id"] for r in found) == [1, 3, 4]
        if stage is P.mask_personal_data:
            assert len(found) == 4 and not any("example.org" in (r["text"] or "") for r in found)


def test_empty_documents(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    out = P.drop_near_duplicates(spark, docs, sf)
    assert out.columns == docs.columns and out.count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    rows = P.run(spark, str(tmp_path))
    assert rows.columns == ["doc_id", "lang", "source", "ids", "n_pieces", "exact"]
    assert rows.count() == 0
