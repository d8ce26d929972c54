"""Default text patterns (P12-P17) on derived text: the test pages hold none."""

from feedspark.operators import extract

HTML = ('<html><script type="module" src="/assets/app-1.js"></script><script src="/x.css"></script>'
        '<script defer src="https://cdn.example/lib.js"></script><script src="/assets/b"></script>'
        '<script src="/extra.js"></script>'
        '<script>fetch("/api/v1/events?limit=10&cursor=x"); fetch( \'/internal/stats\' ); fetch(`/other`);'
        ' const p = "/api/v2/ids"; const q = "/api/v1/events?limit=10"; const r = \'/api/v1/users\'; const h = {"Api-Key": k, "X-API-Key": k, '
        '"Content-Type": "a", "lower-case": 1};</script></html>')


def test_patterns(spark):
    pages = spark.createDataFrame([(1, HTML, "https://x.example/p?page=2&ref=x&page=3")],
                                  "page_id long, html string, url string")
    srcs = [r["src"] for r in extract.script_srcs(pages).orderBy("pos").collect()]
    assert srcs == ["/assets/app-1.js", "https://cdn.example/lib.js", "/assets/b"]
    calls = {r["url"]: r["is_endpoint"] for r in extract.call_urls(pages).collect()}
    assert calls == {"/api/v1/events?limit=10&cursor=x": True, "/internal/stats": True, "/other": False}
    paths = sorted(r["path"] for r in extract.path_literals(pages).collect())
    assert paths == ["/api/v1/users", "/api/v2/ids"]
    params = sorted(r["param"] for r in extract.query_params(pages, text="url").collect())
    assert params == ["page", "ref"]
    headers = sorted(r["header"] for r in extract.header_names(pages).collect())
    assert headers == ["Api-Key", "Content-Type"]  # "X-API-Key" needs two letters before "-"


def test_link_rel(spark):
    df = spark.createDataFrame([('<https://a/s>; rel="stream"',), ('<https://a/n>; rel="next"',)], "link string")
    assert [r["url"] for r in extract.link_rel_url(df).collect()] == ["https://a/s", None]
