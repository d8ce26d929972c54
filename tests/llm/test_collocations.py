"""Phrase mining against a plain count of every phrase."""

import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF
from feedspark.llm import collocations as C
from feedspark.llm import queries


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield re.findall(r"[^\x20\x09]+", piece)


def counts_of(rows, longest):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for w in words_of(text):
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i:i + k])] += 1
    return f, n


def brute(rows, p):
    f, n = counts_of(rows, p.longest)
    f = {q: a for q, a in f.items() if a >= p.least}
    out = {}
    for (lang, w), a in f.items():
        inside = any(g == lang and len(v) > len(w) and 100 * b >= 100 * a
                     and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1)) for (g, v), b in f.items())
        if len(w) < 2 or inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, q.decode(), -a, le, r, n[lang], -s) for lang, got in out.items()
                  for i, (s, a, q, le, r) in enumerate(sorted(got)[:p.top]))


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    base = ["new york city hall", "the cat", "of the", "A b\tc  d e f", "x,y z", "é ü ß"]
    out = []
    for i in range(n):
        parts = [base[j] for j in rng.integers(0, len(base), 5)] + [f"w{j}" for j in rng.integers(0, 30, 6)]
        rng.shuffle(parts)
        out.append((i, ["en", "de", None, "und"][i % 4], (" " if i % 3 else ". ").join(parts)))
    return out


SMALL = C.PhraseParams(least=6, share=0.3, slack=1.0, top=40, bins=4)


@pytest.mark.parametrize("params", [
    SMALL,
    C.PhraseParams(least=6, share=0.02, slack=0.0, top=40, bins=4),            # the sample proposes next to nothing
    C.PhraseParams(least=4, share=1.0, top=10 ** 6, bins=3, longest=3),
    C.PhraseParams(least=6, share=0.3, slack=1.0, max_bits=1 << 13, bits_each=1, chunk=16),   # full filters, tiny parts
])
def test_equal_to_counting_every_phrase(spark, params):
    rows = corpus(5, 160)
    got = rows_of(C.collocations(spark.createDataFrame(rows, "doc_id long, lang string, text string"), params))
    assert got == brute([r[1:] for r in rows], params) and got


def test_border_failures_are_expanded(spark):
    """A phrase of five words in documents that the sample lacks is found by the second pass."""
    p = C.PhraseParams(least=6, share=0.3, slack=1.0, top=40)
    n = 400
    docs = spark.createDataFrame([(i, "en", "") for i in range(n)], "doc_id long, lang string, text string")
    from pyspark.sql import functions as F
    inside = {r[0] for r in docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(p.share * (1 << 20)))
              .select("doc_id").collect()}
    rows = [(i, "en", "red green blue" if i in inside else "one two three four five six") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found, totals, passes = C.frequent_phrases(df, p)
    f, t = counts_of([r[1:] for r in rows], 5)
    assert passes == 2
    assert {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in found.collect()} == {q: a for q, a in f.items() if a >= 6}
    assert {r["lang"]: r["n"] for r in totals.collect()} == dict(t)
    assert C.frequent_phrases(df.where(F.col("doc_id") < 0), p)[2] == 1


def test_long_texts_in_parts_equal_whole_ones(spark):
    text = ("alpha beta gamma delta. " * 9 + "alpha beta " * 7 + "  \n , gamma\t\tdelta ") * 11
    rows = [(1, "en", text), (2, "en", None), (3, None, ""), (4, "de", " \t.,;"), (5, "en", "q" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    for chunk in (7, 64, 1 << 21):
        p = C.PhraseParams(least=5, share=1.0, top=1000, chunk=chunk)
        assert rows_of(C.collocations(df, p)) == brute([r[1:] for r in rows], p)


def test_scores_beyond_64_bits(spark):
    """1000 a n passes 2**63 before it is divided."""
    from pyspark.sql import functions as F
    a, n, left, right = 3_000_000_019, 4_000_000_000_000_037, 3_000_000_021, 7_000_000_003
    dec = [F.lit(x).cast("decimal(19,0)") for x in (a, n, left, right)]
    got = spark.range(1).select(F.call_function("div", F.lit(1000).cast("decimal(4,0)") * dec[0] * dec[1],
                                                dec[2] * dec[3]).alias("s")).first()["s"]
    assert got == 1000 * a * n // (left * right)


def test_edges(spark, wild, nothing):
    p = C.PhraseParams(least=2, share=1.0, top=100)
    got = rows_of(C.collocations(wild, p))
    assert got == brute([(None, r["text"]) for r in wild.collect()], p)
    assert C.collocations(nothing).collect() == []
    assert C.collocations(nothing).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_on_the_given_table(spark):
    import duckdb
    rows = duckdb.sql(f"select lang, text from '{SF}/documents.parquet'").fetchall()
    assert rows_of(queries.QUERIES["op11_phrase_collocations"](spark, SF)) == brute(rows, C.PhraseParams())
