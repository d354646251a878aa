"""The pipeline's stages on awkward rows and empty tables, and held-out accuracy on the driver's tables."""

import os

import pytest
from llm_data import EDGE_DOCS

import corpus_pipeline
from edgeloom.llm.catalog import oracle_sql, queries

SF = "/root/testdata/sf0.01"
driver_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_duplicates", "decontamination", "personal_data", "mixing"]


@pytest.mark.parametrize("which", ["edge_dir", "empty_dir"])
@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_keeps_the_columns(spark, request, name, which):
    folder = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage(name)(spark, docs, folder)
    if name != "mixing":
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
    assert out.count() <= len(EDGE_DOCS)


def test_near_duplicates_leave_one(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    left = [r.doc_id for r in stage("near_duplicates")(spark, docs, edge_dir).collect()]
    assert {1, 2, 3, -5} & set(left) == {-5} and left.count(None) == 2 and left.count(18) == 2
    assert set(d for d, _, _, _ in EDGE_DOCS) - set(left) == {1, 2, 3}


def test_near_duplicates_take_five_words_and_four_fifths(spark, scratch_dir):
    base = [f"w{i}" for i in range(49)]  # 45 shingles of five words; one changed word inside leaves 40 of 50
    near, far = base[:], base[:]
    near[20] = "x"
    far[20], far[30] = "x", "y"
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert sorted(r.doc_id for r in stage("near_duplicates")(spark, docs, scratch_dir).collect()) == [1]
    docs = docs.where("doc_id <> 2")
    assert sorted(r.doc_id for r in stage("near_duplicates")(spark, docs, scratch_dir).collect()) == [1, 3]


def test_decontamination_drops_contaminated_only(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    flags = queries()["op2_decontaminate"](spark, edge_dir).collect()
    left = stage("decontamination")(spark, docs, edge_dir)
    assert left.count() == sum(not r.contaminated for r in flags)
    assert 10 not in [r.doc_id for r in left.collect()]


def test_personal_data_is_masked(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = {r.doc_id: r for r in stage("personal_data")(spark, docs, edge_dir).collect()}
    assert out[11].text == "Call [PHONE], mail [EMAIL] or [IP]; card [CARD]." and out[11].n_chars == len(out[11].text)
    texts = {d: t for d, t, _, _ in EDGE_DOCS}
    assert all(r.text == texts[d] for d, r in out.items() if d not in (11, None))


def test_run_passes_each_stage_on(spark, edge_dir):
    out = corpus_pipeline.run(spark, edge_dir)
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert not {1, 2, 3, 10} & {r.doc_id for r in out.collect()}


@driver_tables
def test_held_out_quality(spark):
    got = queries()["op9_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows) > 0


@driver_tables
def test_held_out_language(spark):
    got = queries()["op10_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.9 * len(rows) > 0


@driver_tables
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    from oracle_check import compare, duck

    folder = "/root/testdata/sf0.001"
    r = compare(spark, duck(folder), name, queries()[name], oracle_sql()[name], folder)
    assert r["ok"], r
