"""Source parsers on hand-made text."""

import pytest

from feedspark.sources import feed


def lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_pages_nested_and_flat(spark):
    nested = '{"data":[{"id":"a"},{"eventId":"b"}],"pagination":{"hasMore":true,"nextCursor":"c1"}}'
    flat = '{"data":[{"_id":"c"}],"hasMore":false,"nextCursor":null}'
    df = lines(spark, [nested, flat])
    rows = {r["id"]: r for r in feed.parse_pages(df, nested=True).collect()}
    assert rows["a"]["has_more"] is True and rows["a"]["next_cursor"] == "c1"
    assert rows["c"]["has_more"] is False and rows["c"]["next_cursor"] is None
    flat_rows = {r["id"]: r for r in feed.parse_pages(df, nested=False).collect()}
    assert flat_rows["a"]["has_more"] is None


def test_dump_shapes(spark):
    docs = ['[{"id":"a"}]', '{"data":[{"id":"b"}]}', '{"ids":["c","null",""]}', '{"events":[{"id":"d"}]}',
            '{"data":[],"ids":["x"]}']
    assert ids(feed.parse_dump(lines(spark, docs))) == ["a", "b", "c", "d"]


def test_ndjson_lenient_bare_id_bounds(spark):
    vals = ['{"id":"o1"}', '"s1"', "abcde", "abcdef", "123456", "x" * 199, "x" * 200, "123456789", "true", "null",
            "", "   ", "12345678-aaaa-bbbb-cccc-1234567890ab", "{bad json"]
    got = ids(feed.parse_ndjson_lenient(lines(spark, vals)))
    assert got == sorted(["o1", "s1", "abcdef", "x" * 199, "12345678-aaaa-bbbb-cccc-1234567890ab",
                          "{bad json"])


def test_ndjson_strict_raises(spark):
    ok = feed.parse_ndjson_strict(lines(spark, ['{"id":"a"}', '{"eventId":"b"}']))
    assert ids(ok) == ["a", "b"]
    with pytest.raises(Exception, match="bad NDJSON line"):
        feed.parse_ndjson_strict(lines(spark, ['{"id":"a"}', "oops"])).collect()


def test_sse(spark):
    vals = ['data: {"id":"a"}', 'data: {"_id":"gated"}', 'data: "s1"', 'data: [{"_id":"b"},"c"]',
            "data: [DONE]", "data:", "event: x", "data: plain-id-1", "data: {broken", "data: abcde"]
    assert ids(feed.parse_sse(lines(spark, vals))) == ["a", "b", "c", "plain-id-1", "s1"]


def test_csv_first_matching_column(spark, tmp_dir):
    df = spark.createDataFrame([("u1", "e1", "1"), ("u2", "undefined", "2"), ("u3", None, "3")],
                               "user string, eventId string, id string")
    df.coalesce(1).write.option("header", True).csv(tmp_dir + "/csv")
    assert ids(feed.read_csv_ids(spark, tmp_dir + "/csv")) == ["e1"]
    df.select("user").write.option("header", True).csv(tmp_dir + "/noid")
    assert feed.read_csv_ids(spark, tmp_dir + "/noid").count() == 0


def test_id_lines_and_stats_doc(spark):
    got = ids(feed.parse_id_lines(lines(spark, ["  a ", "", "b", "\t"])))
    assert got == ["a", "b"]
    doc = ('{"counts":{"events":3},"distributions":{"eventTypes":[{"type":"click","count":2}],'
           '"deviceTypes":[{"type":"mobile","count":1}]},"cache":{}}')
    rows = {(r["section"], r["name"]): r["count"] for r in feed.parse_stats_doc(lines(spark, [doc])).collect()}
    assert rows == {("counts", "events"): 3, ("eventTypes", "click"): 2, ("deviceTypes", "mobile"): 1}


def test_file_readers(spark, tmp_dir):
    import os
    pages = os.path.join(tmp_dir, "pages")
    os.makedirs(pages)
    docs = ['{"data":[{"id":"a"},{"id":"b"}],\n "pagination":{"hasMore":true,"nextCursor":"c1"}}',
            '{"data":[{"eventId":"c"}],\n "hasMore":false}']
    for i, d in enumerate(docs):
        with open(os.path.join(pages, f"page-{i}.json"), "w") as f:
            f.write(d)
    got = {r["id"]: (r["has_more"], r["next_cursor"]) for r in feed.read_pages(spark, pages).collect()}
    assert got == {"a": (True, "c1"), "b": (True, "c1"), "c": (False, None)}
    lines_dir = os.path.join(tmp_dir, "lines")
    os.makedirs(lines_dir)
    with open(os.path.join(lines_dir, "p.jsonl"), "w") as f:
        f.write('{"data":[{"id":"x"}],"hasMore":false}\n{"data":[{"id":"y"}]}\n')
    assert ids(feed.read_pages(spark, lines_dir, whole_file=False)) == ["x", "y"]
    journal = os.path.join(tmp_dir, "journal")
    os.makedirs(journal)
    with open(os.path.join(journal, "j.wal"), "w") as f:
        f.write(" a \n\nb\nb\n")
    assert ids(feed.read_id_lines(spark, journal)) == ["a", "b", "b"]
    stats = os.path.join(tmp_dir, "stats")
    os.makedirs(stats)
    with open(os.path.join(stats, "s.json"), "w") as f:
        f.write('{\n "counts": {"events": 5, "users": 2},\n "distributions": {"eventTypes": []},\n "cache": {}\n}')
    rows = {(r["section"], r["name"]): r["count"] for r in feed.read_stats_doc(spark, stats).collect()}
    assert rows == {("counts", "events"): 5, ("counts", "users"): 2}


def test_ndjson_number_text_like_javascript(spark):
    """Numbers print as JavaScript's String() does; non-JSON constants are bare ids."""
    vals = ['{"id":1e400}', '{"id":-1e400}', '{"id":1.5}', '{"id":2.0}', '{"id":1e3}', '{"id":-0}',
            "NaN", "Infinity", "0x1F2E3D", "012345"]
    got = {r["n"]: r["id"] for r in feed.parse_ndjson_lenient(lines(spark, vals), keep=["n"]).collect()}
    assert [got.get(i) for i in range(len(vals))] == [
        "Infinity", "-Infinity", "1.5", "2", "1000", None, None, "Infinity", "0x1F2E3D", "012345"]


def test_repeated_keys_and_lost_documents(spark):
    """The last value of a repeated key counts; what cannot be read is kept whole."""
    pages = ['{"data":[{"id":"a","id":"b"},{"id":"c"}],"hasMore":true,"hasMore":false}', '{"data":[{"id":"t"},{"i',
             '{"data":[{"id":"j"}]} junk', '{"hasMore":false}', None, '{"data":[]}']
    df = lines(spark, pages)
    assert sorted((r["id"], r["has_more"]) for r in feed.parse_pages(df).collect()) == [("b", False), ("c", False)]
    lost = [("not parsed", pages[1]), ("not parsed", pages[2]), ("no array", pages[3])]
    assert [(r["reason"], r["value"]) for r in feed.page_quarantine(df, ["n"]).orderBy("n").collect()] == lost
    dumps = lines(spark, ['[{"id":"a","id":"b"}]', '{"ids":["c"],"ids":["d"]}', '["e"', "7"])
    assert ids(feed.parse_dump(dumps)) == ["b", "d"]
    got = feed.dump_quarantine(dumps, ["n"]).orderBy("n").collect()
    assert [(r["n"], r["reason"]) for r in got] == [(2, "not parsed"), (3, "no array")]


def test_documents_cut_into_parts_read_the_same(spark, monkeypatch):
    """Documents too large for one Variant are read by element, with the same rows."""
    pages = lines(spark, ['{"data":[{"id":"a"},{"id":"b","x":[1,{"id":"n"}]}],"pagination":{"hasMore":true,"nextCursor":"c"}}',
                          ' {"data":[{"_id":"d"},null,3],"hasMore":false,"nextCursor":null}', '{"hasMore":true}'])
    dumps = lines(spark, [' [{"id":"a"},"b",7]', '{"data":[{"id":"c"}],"ids":["x"]}', '{"ids":["null","d"]}', '{"a":1}'])

    def read():
        return [sorted(map(str, df.collect())) for df in (
            feed.parse_pages(pages, keep=["n"]), feed.parse_pages(pages, nested=False, keep=["n"]),
            feed.parse_dump(dumps, keep=["n"]), feed.page_quarantine(pages, ["n"]), feed.dump_quarantine(dumps, ["n"]))]

    whole = read()
    monkeypatch.setattr(feed, "WHOLE_BYTES", 0)
    assert read() == whole and all(whole)


def test_rows_and_rejects_of_one_pass(spark, tmp_dir):
    """Pages and dumps that cannot be read are rows of the same frame, stored by one job."""
    from feedspark.operators import sinks
    pages = lines(spark, ['{"data":[{"id":"a"},{"id":""}],"hasMore":true}', '{"data":[{"id":"t"},{"i', '{"hasMore":false}', None,
                          '{"data":[]}'])
    df = feed.parse_pages(pages, keep=["n"], rejects=True)
    got = sorted((r["n"], r["id"], r["reason"], r["value"]) for r in df.collect())
    assert got == [(0, "a", None, None), (1, None, "not parsed", '{"data":[{"id":"t"},{"i'), (2, None, "no array", '{"hasMore":false}')]
    rows, lost = sinks.write_with_rejects(df, tmp_dir + "/out")
    assert [r["id"] for r in rows.collect()] == ["a"] and sorted(r["n"] for r in lost.collect()) == [1, 2]
    assert "PartitionFilters: [" in rows._jdf.queryExecution().toString()
    dumps = feed.parse_dump(lines(spark, ['["x",{"id":"y"}]', "oops", "{}"]), keep=["n"], rejects=True)
    assert sorted((r["n"], str(r["id"]), str(r["reason"])) for r in dumps.collect()) == [
        (0, "x", "None"), (0, "y", "None"), (1, "None", "not parsed"), (2, "None", "no array")]


def test_csv_header_of_each_file(spark, tmp_dir):
    """Spaced, quoted and missing id columns; every file by its own header; blank lines; a BOM."""
    import os
    files = {"a": "user, id\nu1,i1\nu2 , i2 \n", "b": '"id","x"\n"i,3",1\n\n undefined ,2\n', "c": "user,type\nu4,click\n",
             "d": "\ufeffeventId\ni5\n", "e": "\n\n k,event_id,id\n1,i6,no\n2\n3,,no\n", "f": "", "g": "id\n"}
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name + ".csv"), "w") as f:
            f.write(text)
    assert ids(feed.read_csv_ids(spark, tmp_dir)) == ["i,3", "i1", "i2", "i5", "i6"]
    os.makedirs(tmp_dir + "/none")
    with open(tmp_dir + "/none/x.csv", "w") as f:
        f.write("user\nu1\n")
    assert feed.read_csv_ids(spark, tmp_dir + "/none").collect() == []


def test_ndjson_strict_reads_any_value_but_null(spark):
    vals = ['"abc123"', "17", "[1]", '{"id":"a"}', '{"id":null}', " "]
    assert ids(feed.parse_ndjson_strict(lines(spark, vals))) == ["a"]
    with pytest.raises(Exception, match="bad NDJSON line"):
        feed.parse_ndjson_strict(lines(spark, ["null"])).collect()


def test_stats_doc_keeps_what_it_does_not_know(spark):
    doc = ('{"counts":{"events":3,"odd":"x"},"distributions":{"countries":[{"type":"fr","count":2},7],"hours":{"0":1}},'
           '"cache":{"ttl":5,"on":true},"build":{"v":1}}')
    got = [tuple(r) for r in feed.parse_stats_doc(lines(spark, [doc, "oops", "[1]", None]), ["n"]).collect()]
    assert sorted(got, key=str) == sorted([
        (0, "counts", "events", 3, None), (0, "counts", "odd", None, None), (0, "countries", "fr", 2, None),
        (0, "countries", None, None, "7"), (0, "hours", None, None, '{"0":1}'), (0, "cache", "ttl", None, "5"),
        (0, "cache", "on", None, "true"), (0, "unexpected", "build", None, '{"v":1}'),
        (1, "rejected", None, None, "oops"), (2, "rejected", None, None, "[1]")], key=str)
