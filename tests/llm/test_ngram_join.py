"""The n-gram join against all pairs on small tables."""

import random
import re

from conftest import SF
from feedspark.llm import ngram_join, queries
from feedspark.llm.components import connected_components

from .conftest import TEXTS, texts_of


def brute(texts, k, num, den):
    """(set size, component's smallest id) by id; ids unique and not null."""
    sets = []
    for i, t in texts:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = min(k, len(w))
        sets.append((i, {tuple(w[a:a + n]) for a in range(len(w) - n + 1)} if w else set()))
    comp = {i: i for i, _ in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i
    by = {}
    for i, s in sets:
        for g in s:
            by.setdefault(g, []).append(i)
    d = dict(sets)
    seen = set()
    for ids in by.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    x, y = len(d[a] & d[b]), len(d[a] | d[b])
                    if den * x >= num * y:
                        r, s = sorted((find(a), find(b)))
                        comp[s] = r
    return {i: (len(s), find(i)) for i, s in sets}


def family(rng, words, copies, edits):
    """Copies of a text, each with up to `edits` words replaced; some edits are
    made twice, so that chains of links occur."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        w = list(rng.choice(out) if out and rng.random() < 0.5 else base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


def test_random_families(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        texts += family(rng, rng.choice((6, 12, 30, 80, 200)), rng.randrange(2, 40), 3)
    passage = " ".join(f"p{k}" for k in range(60))            # shared by many that do not link
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(40)) for _ in range(60)]
    texts += ["", None, "  ", "one", "ONE", "two words", "Two  words"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for k, num, den in ((3, 90, 100), (5, 8, 10), (1, 8, 10)):
        want = brute(rows, k, num, den)
        for block in (1024, 7):                              # 7: families are cut into blocks
            p = ngram_join.JoinParams(words=k, num=num, den=den, block=block)
            got = ngram_join.ngram_components(df, p).collect()
            assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
            assert len({c for _, c in want.values()}) == sum(r["first"] for r in got) < len(rows)


def test_query(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        got = queries.QUERIES["op8_ngram_jaccard"](spark, sf).collect()
        want = brute(texts_of(sf), 3, 90, 100)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
        assert len(got) == len(want)


def test_wild_and_empty(spark, wild, nothing):
    got = ngram_join.ngram_components(wild).collect()
    assert len(got) == len(TEXTS)
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by[7] == 6 and by[2] == 2 and by[3] == 3 and by[None] is None and by[9] == 9
    assert sum(r["first"] for r in got if r["doc_id"] == 9) == 1
    assert ngram_join.ngram_components(nothing).count() == 0


def test_components_of_paths_and_stars(spark):
    e = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    got = connected_components(spark.createDataFrame(e, "a long, b long")).collect()
    want = {k: 0 for k in range(61)} | {100 + k: 100 for k in range(50)} | {200: 200, 201: 200}
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)


def test_a_round_leaves_nothing_behind_on_the_driver(spark, monkeypatch):
    """Plans, minima and shuffles of a round are let go before the next: the driver's heap
    does not grow with the rounds."""
    from feedspark.llm import components
    rounds, free = [], components.release
    monkeypatch.setattr(components, "release", lambda s: (rounds.append(1), free(s)))
    e = [(k, k + 1) for k in range(60)]
    got = connected_components(spark.createDataFrame(e, "a long, b long")).collect()
    assert len(rounds) >= 2 and {r["root"] for r in got} == {0} and len(got) == 61


def test_similarities_whose_prefix_could_lose_links_are_refused(spark):
    """{a, c, b} and {a, b} in order of rarity share no pair of neighbours at 2/3."""
    import pytest

    from feedspark.llm import line_dedup
    df = spark.createDataFrame([(1, "a b c"), (2, "a b")], "doc_id long, text string")
    for num, den in ((1, 2), (6, 10), (2, 3)):
        with pytest.raises(ValueError, match="2/3"):
            ngram_join.ngram_components(df, ngram_join.JoinParams(words=1, num=num, den=den))
        with pytest.raises(ValueError, match="2/3"):
            line_dedup.line_decisions(df, line_dedup.LineParams(num=num, den=den))


def test_chance_keys_join_no_families(spark, monkeypatch):
    """Texts in a row of which each shares a passage with the next: they have keys in common
    but do not link, so none of them is read again; the copies among them are."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**9)}"
    passages = [[word() for _ in range(40)] for _ in range(121)]
    texts = [" ".join([*passages[i], *(word() for _ in range(60)), *passages[i + 1]]) for i in range(120)]
    for i in (7, 50):                                  # near copies
        texts.append(texts[i] + " end")
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    met, link = [], ngram_join._link_families

    def linked(members, p):
        met.append(members.count())
        return link(members, p)
    monkeypatch.setattr(ngram_join, "_link_families", linked)
    for short in (32, 1):                              # 1: every run is a long one
        p = ngram_join.JoinParams(buckets=1024, short=short)   # as full as the counters of a large corpus
        got = ngram_join.ngram_components(df, p).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 5, 8, 10)
    assert met[0] == 4 < 100 < met[1]


def test_sizes_out_of_reach_join_no_families(spark):
    """The rows of a list, by size: 10, 11 | 20, 21, 22 | 40."""
    sizes = [21, 10, 40, 11, 22, 20]
    rows = [(i, n, [7, 100 + i], b"\0" * 256) for i, n in enumerate(sizes)]
    sets = spark.createDataFrame(rows, "uid long, n long, keys array<long>, sk binary")
    pairs = lambda short: {(sizes[r["a"]], sizes[r["b"]], r["near"])
                           for r in ngram_join._list_pairs(sets, ngram_join.JoinParams(short=short)).collect()}
    assert pairs(32) == {(10, 11, True), (20, 21, True), (20, 22, True), (21, 22, True)}
    assert pairs(2) == {(10, 11, True), (20, 21, False), (20, 22, False)}


def test_the_last_plan_is_short(spark):
    """What is left for the caller to run is one join of rows and answers: the driver plans
    a hundred exchanges at once no more."""
    df = spark.createDataFrame([(k, f"a b c d e f {k // 2}") for k in range(8)], "doc_id long, text string")
    plan = ngram_join.ngram_components(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 8, plan.count("Exchange")
