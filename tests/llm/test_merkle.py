"""The Merkle manifest against a tree built by plain Python."""

import zlib
from hashlib import sha256

import pytest

from conftest import SF
from feedspark.llm import merkle, queries

COLS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute(rows, arity=8):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows (COLS)."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    subs, paths = [], {}
    for g in langs:
        mine = sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        level = [(leaf(r), [i]) for i, r in enumerate(mine)]
        path = [[] for _ in mine]
        while len(level) > 1:
            up = []
            for lo in range(0, len(level), arity):
                run = level[lo:lo + arity]
                for k, (_, below) in enumerate(run):
                    for i in below:
                        path[i].append(([d for d, _ in run[:k]], [d for d, _ in run[k + 1:]]))
                up.append((H(*[d for d, _ in run]), [i for _, b in run for i in b]))
            level = up
        subs.append(level[0][0])
        paths[g] = (mine, path)
    out = []
    for j, g in enumerate(langs):
        for r, path in zip(*paths[g]):
            path = path + [(subs[:j], subs[j + 1:])]
            low = r[4]
            if low is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in low)
            cur = leaf((*r[:4], low))
            for before, after in path:
                cur = H(*before, cur, *after)
            root = H(*subs)
            out.append((r[0], leaf(r), subs[j], root, H(*[x for b, a in path for x in b + a]), cur, cur == root))
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9, None: 1}, {"en": 65, "": 8, None: 2, "é": 1, "z": 64}, {"a": 600}])
def test_manifest_equals_a_plain_tree(spark, sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7 % 1009, f"s{i % 3}", lang, i, f"Text No {i} É"))
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(merkle.verify_rows(df)) == brute(rows)


def test_edges(spark, wild, nothing):
    """Nulls in every column, repeated rows and ids, long texts, more columns."""
    rows = [tuple(r[c] for c in COLS) for r in wild.collect()]
    assert got(merkle.verify_rows(wild)) == brute(rows)
    assert merkle.verify_rows(nothing).collect() == []
    some = [(1, None, "en", None, None), (1, None, "en", None, None), (None, "s", "en", 3, "A"), (1, "x", "en", 0, ""),
            (None, None, None, None, None)] + [(5, "s", "fr", 9, "Same")] * 20
    assert got(merkle.verify_rows(spark.createDataFrame(some, SCHEMA))) == brute(some)


def test_descent_of_some_requests(spark):
    """Requests for some leaves, repeated and impossible ones, on a binary tree."""
    from pyspark.sql import functions as F
    rows = [(i, "s", "en" if i < 37 else "fr", i, f"t{i}") for i in range(60)]
    m = merkle.build_manifest(spark.createDataFrame(rows, SCHEMA), arity=2)
    assert [r["depth"] for r in m.groups.orderBy("g").collect()] == [6, 5]
    asked = spark.createDataFrame([(0, 0, "a"), (0, 36, "b"), (0, 36, "b"), (1, 22, "c"), (1, 23, "d"), (7, 0, "e"), (0, -1, "f")],
                                  "g long, pos long, tag string")
    out = merkle.prove(m, asked).withColumn("up", merkle.folded(F.col("path"), F.col("found"))).collect()
    assert sorted((r["g"], r["pos"], r["tag"]) for r in out) == [(0, 0, "a"), (0, 36, "b"), (0, 36, "b"), (1, 22, "c")]
    want = {(0, 0): leaf(rows[0]), (0, 36): leaf(rows[36]), (1, 22): leaf(rows[59])}
    for r in out:
        assert r["found"] == want[r["g"], r["pos"]] and r["up"] == r["root"]
        assert len(r["path"]) == (7 if r["g"] == 0 else 6)


def test_query(spark):
    import duckdb
    rows = duckdb.sql(f"select {', '.join(COLS)} from '{SF}/documents.parquet'").fetchall()
    assert got(queries.QUERIES["op13_merkle_manifest"](spark, SF)) == brute(rows)
