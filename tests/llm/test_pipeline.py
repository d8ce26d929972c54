"""Every stage of the corpus pipeline on awkward tables, and the whole run."""

import pytest

import corpus_pipeline as P
from conftest import SF
from feedspark.llm import toxicity

STAGES = dict(P.STAGES)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def mild(spark):
    """A toxicity model that rejects documents with one word."""
    docs = spark.createDataFrame([(k, ("vile", "", "plain", "other")[k % 4]) for k in range(80)], "doc_id long, text string")
    return toxicity.fit_toxicity(docs, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(80)], "doc_id long, toxic int"))


def test_order_of_the_stages():
    assert list(STAGES) == ["toxicity", "line dedup", "n-gram Jaccard join", "secret scans", "packing"]


def test_toxicity_stage_rejects_and_keeps(spark, wild, nothing, mild):
    more = wild.unionByName(spark.createDataFrame([(70, "so vile", *[None] * 7), (70, "so vile", *[None] * 7)], wild.schema))
    assert rows(toxicity.drop_toxic(more, mild)) == rows(wild)
    assert toxicity.drop_toxic(nothing, mild).collect() == []
    out = STAGES["toxicity"](spark, wild, SF)
    assert out.columns == wild.columns and set(rows(out)) <= set(rows(wild))


@pytest.mark.parametrize("name", ["line dedup", "n-gram Jaccard join", "secret scans"])
def test_stages_keep_columns_and_clean_rows(spark, wild, nothing, name):
    out = STAGES[name](spark, wild, SF)
    assert out.columns == wild.columns
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r)
    if name == "n-gram Jaccard join":            # texts 6 and 7, and the two rows of document 9, are copies
        assert set(got) >= {1, 2, 3, 4, 8, 10, 11, 12, 13, 14, None} and len({6, 7} & set(got)) == 1
    else:
        assert sum(map(len, got.values())) == wild.count() and len(got[9]) == 2
    kept = {r["doc_id"]: r["text"] for x in got.values() for r in x}
    assert kept[8] == [r["text"] for r in wild.where("doc_id = 8").collect()][0]
    if name == "secret scans":
        assert "hunter2" not in kept[13] and kept[2] is None
    assert all(r["score"] == "x" and r["block"] == "y" for x in got.values() for r in x)
    assert STAGES[name](spark, nothing, SF).collect() == []


def test_packing_stage(spark, wild, nothing):
    out = STAGES["packing"](spark, wild, SF).collect()
    assert len({(r["doc_id"], r["start"]) for r in out}) >= wild.select("doc_id").distinct().count()
    assert all(0 < r["length"] <= 2048 for r in out)
    assert STAGES["packing"](spark, nothing, SF).collect() == []


def test_whole_run(spark):
    out = P.run(spark, SF)
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    all_ids = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert ids < all_ids and len(ids) > 0.5 * len(all_ids)
