"""Dumps cut in parallel, against a JSON parser."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedspark.sources import split
from feedspark.sources.feed import parse_ndjson_lenient, parse_pages


def put(folder, docs):
    os.makedirs(folder, exist_ok=True)
    for name, text in docs.items():
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(text)
    return folder


@pytest.fixture()
def tiny_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    yield lambda n: [spark.conf.set(k, str(v)) for k, v in zip(keys, (n, 1))]
    for k, v in before.items():
        spark.conf.set(k, v)


def got(spark, path):
    rows = split.split_dump(spark, path).collect()
    name = os.path.basename
    return (sorted((name(r["file"]), r["element"], r["id"]) for r in rows if r["reason"] is None),
            sorted((name(r["file"]), r["element"], r["reason"]) for r in rows if r["reason"] is not None))


HARD = [{"id": "a,b"}, {"id": 'q"]},{["x', "n": [1, [2, {"k": ","}]]}, "plain", {"id": "back\\slash\\"}, {"eventId": 7}, None, 3,
        {"id": "é, 漢"}, {"x": {"id": "inner"}}, {"id": ""}, "", "undefined", {"id": "tab\t,\n"}, [], {}]
IDS = [(0, "a,b"), (1, 'q"]},{["x'), (2, "plain"), (3, "back\\slash\\"), (4, "7"), (7, "é, 漢"), (12, "tab\t,\n")]


@pytest.mark.parametrize("size", [7, 33, 1 << 20])
def test_every_element_whatever_the_blocks(spark, tmp_dir, tiny_blocks, size):
    tiny_blocks(size)
    text, pretty = json.dumps(HARD), json.dumps(HARD, indent=2, ensure_ascii=False)
    docs = {"a": text, "b": pretty, "c": f'{{"n": {{"data": [1, 2]}}, "data": {text}, "hasMore": true}}',
            "d": f' {{"ids": ["x"], "events": [1], "data":{pretty} }}\n', "e": '{"data": 5, "ids": ["y", "null"], "events": []}',
            "f": "[]", "g": '{"data": [ ]}', "h": '["one"]', "i": '{"data":["old"],"data":["new","er"]}', "j": ""}
    ids, lost = got(spark, put(os.path.join(tmp_dir, "d"), docs))
    want = [(f, e, i) for f in "abcd" for e, i in IDS] + [("e", 0, "y"), ("h", 0, "one"), ("i", 0, "new"), ("i", 1, "er")]
    assert ids == sorted(want) and lost == []


@pytest.mark.parametrize("size", [9, 1 << 20])
def test_rejects_come_from_the_same_pass(spark, tmp_dir, tiny_blocks, size):
    tiny_blocks(size)
    docs = {"a": '["x", {"id": oops}, "y", , "z"]', "b": '["x", "y', "c": '[["x"], "y"', "d": '["x"], ["y"]', "e": '{"a": 1, "b": [2]}',
            "f": "7", "g": '["x"]]', "h": '["x"] junk', "i": '{"data": "x"}'}
    ids, lost = got(spark, put(os.path.join(tmp_dir, "d"), docs))
    assert ids == [("a", 0, "x"), ("a", 2, "y"), ("a", 4, "z")]
    assert lost == [("a", 1, "not parsed"), ("a", 3, "not parsed"), ("b", None, "unbalanced"), ("c", None, "unbalanced"),
                    ("d", None, "not one value"), ("e", None, "no array"), ("f", None, "no array"), ("g", None, "not one value"),
                    ("h", 0, "not parsed"), ("i", None, "no array")]


def test_one_dump_spans_many_tasks(spark, tmp_dir, tiny_blocks):
    """20,000 elements in one file and one line, read by some fifty tasks."""
    tiny_blocks(30_000)
    n = 20_000
    elements = [{"id": f"e{i}", "note": 'a,"b\\],{' * (i % 5), "deep": [[i], {"x": [1, 2]}]} for i in range(n)]
    path = put(os.path.join(tmp_dir, "d"), {"dump.json": json.dumps({"meta": [1, 2], "events": elements}, separators=(",", ":"))})
    assert spark.read.option("lineSep", ",").text(path).rdd.getNumPartitions() >= 40
    rows = split.read_dump_ids(spark, path).collect()
    assert sorted((r["element"], r["id"]) for r in rows) == [(i, f"e{i}") for i in range(n)]


def test_an_element_longer_than_blocks(spark, tmp_dir, tiny_blocks):
    tiny_blocks(50)
    path = put(os.path.join(tmp_dir, "d"), {"a": json.dumps(["x", {"id": "long", "v": ["w,]"] * 100}, "y"])})
    assert [r["id"] for r in split.read_dump_ids(spark, path).orderBy("element").collect()] == ["x", "long", "y"]


def test_no_stored_row_for_every_piece(spark, tmp_dir, monkeypatch):
    """What is kept between passes is chunks and elements, not the pieces between commas."""
    kept, cut = [], split.cut_lineage

    def keep(df):
        out = cut(df)
        kept.append(out.count())
        return out
    monkeypatch.setattr(split, "cut_lineage", keep)
    monkeypatch.setattr(split, "CHUNK_BYTES", 500, raising=False)
    n = 300
    path = put(os.path.join(tmp_dir, "d"), {"a": json.dumps([{"id": f"e{i}", "n": list(range(20))} for i in range(n)])})
    assert sorted((r["element"], r["id"]) for r in split.read_dump_ids(spark, path).collect()) == [(i, f"e{i}") for i in range(n)]
    assert max(kept) < 2 * n


VALUES = st.recursive(st.none() | st.booleans() | st.integers(-9, 10 ** 9) | st.text('ab",[]{}\\: \n', max_size=6),
                      lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["id", "k", "data"]), x, max_size=2),
                      max_leaves=6)


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(VALUES, max_size=8), st.integers(5, 60), st.booleans())
def test_like_a_parser(spark, tmp_path_factory, tiny_blocks, elements, size, wrapped):
    from feedspark.sources.feed import parse_dump
    tiny_blocks(size)
    text = json.dumps({"k": [9], "data": elements} if wrapped else elements)
    path = put(str(tmp_path_factory.mktemp("dump")), {"a": text})
    ids, lost = got(spark, path)
    whole = parse_dump(spark.createDataFrame([(text,)], "value string"))
    assert lost == [] and sorted(i for _, _, i in ids) == sorted(r["id"] for r in whole.collect())


def test_repeated_keys_do_not_depend_on_call_order(spark):
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    line = spark.createDataFrame([('{"id":"a1aaaa","id":"b2bbbb"}',)], "value string")
    page = spark.createDataFrame([('{"data":[{"id":"x","id":"y"}]}',)], "value string")
    assert [r["id"] for r in parse_ndjson_lenient(line).collect()] == ["b2bbbb"]
    assert [r["id"] for r in parse_pages(page).collect()] == ["y"]
    assert [r["id"] for r in parse_ndjson_lenient(line).collect()] == ["b2bbbb"]


def test_strict_parse_takes_no_text_that_closes_its_wrapping(spark):
    from feedspark.functions.json import strict_parse, with_strict_parse
    texts = ['"x"] junk', '{"id":"a"}] x', '[1]', '[1],2', '{"a":[1]}', '{"a":[1]}}', '1}', ' [ ] ', '"]"']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = with_strict_parse(df, "t", "v").select("t", "v", strict_parse("t").alias("w")).collect()
    assert [r["t"] for r in out if r["v"] is not None] == ["[1]", '{"a":[1]}', " [ ] ", '"]"']
    assert all((r["v"] is None) == (r["w"] is None) for r in out)
