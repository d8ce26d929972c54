"""P01-P03 on the edge records of FIXTURES.md §3."""

from pyspark.sql import functions as F

from feedspark.functions.ids import invalid_reason, is_uuid, is_valid_id, with_id_pick
from feedspark.functions.json import strict_parse

RECORDS = [
    ('{"id":"a1"}', "a1"),
    ('{"id":"","eventId":"b"}', "b"),
    ('{"id":0,"event_id":"c"}', "c"),
    ('{"id":"0"}', "0"),
    ('{"id":false,"eventId":"z"}', "z"),
    ('{"id":null,"_id":"d"}', "d"),
    ('{"id":"undefined","eventId":"e"}', None),
    ('{"id":"null"}', None),
    ('{"x":1}', None),
    ("not json", None),
    ('{"id":1.0}', "1"),
    ('{"id":12345678901234567890}', "12345678901234567890"),
    ('{"id":{"a":1}}', None),
    ('{"id":1e3}', "1000"),
    ('{"id":true}', "true"),
    ('{"id":"a"} junk', None),
]


def _picked(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(RECORDS)], "n int, j string")
    df = with_id_pick(df.withColumn("v", strict_parse("j")), "v")
    return {r["n"]: r for r in df.select(
        "n", "id", "id_kind", F.when(is_valid_id("id"), F.col("id")).alias("valid"),
        invalid_reason("id", "id_kind", parsed_ok=F.col("v").isNotNull()).alias("reason")).collect()}


def test_truthiness_and_sentinels(spark):
    got = _picked(spark)
    for i, (rec, want) in enumerate(RECORDS):
        assert got[i]["valid"] == want, rec


def test_quarantine_reasons(spark):
    got = _picked(spark)
    reasons = {RECORDS[i][0]: r["reason"] for i, r in got.items()}
    assert reasons['{"id":{"a":1}}'] == "object_id"
    assert reasons['{"id":"null"}'] == "sentinel"
    assert reasons['{"id":"undefined","eventId":"e"}'] == "sentinel"
    assert reasons['{"x":1}'] == "no_id"
    assert reasons["not json"] == "unparsable"
    assert reasons['{"id":"a"} junk'] == "unparsable"
    assert reasons['{"id":"a1"}'] is None


def test_uuid_strict(spark):
    df = spark.createDataFrame([("12345678-aaaa-bbbb-cccc-1234567890ab",), ("12345678-aaaa-bbbb-cccc-1234567890a",),
                                ("12345678aaaabbbbcccc1234567890abcdef",), (None,)], "u string")
    assert [r[0] for r in df.select(is_uuid("u")).collect()] == [True, False, False, False]
