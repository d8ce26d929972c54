"""Multiple-instance learning: its gradient, its blockwise score and what it learns."""

import zlib

import numpy as np

from conftest import SF_ORACLE
from feedspark.llm import passages as Q
from feedspark.llm import queries

P = Q.MILParams(words=4, term_bits=4, shape_bits=3, hidden=5, gate=3)


def bag_of(text, p):
    codes = np.concatenate([c for c, _, _ in Q.passages([text], p, Q._Words())])
    return codes, np.arange(0, max(len(codes), 1), p.words)


def naive_score(m, text):
    """One document, passage by passage, word by word."""
    p, q, words = m.params, m.weights, text.split()
    hs, es = [], []
    for lo in range(0, max(len(words), 1), p.words):
        mine = words[lo:lo + p.words]
        x = np.zeros((1 << p.term_bits) + (1 << p.shape_bits) + Q.N_FIGURES)
        codes = [Q._code(w, {}) for w in mine]
        for c in codes:
            x[c & ((1 << p.term_bits) - 1)] += (1 - 2 * (c >> 40 & 1)) / np.sqrt(len(mine))
            x[(1 << p.term_bits) + (c >> 16 & ((1 << p.shape_bits) - 1))] += 1 / len(mine)
        a, b = 1 << p.term_bits, (1 << p.term_bits) + (1 << p.shape_bits)
        x[a:b] = np.sqrt(x[a:b])
        if mine:
            x[b:] = [sum(u == v for u, v in zip(mine, mine[1:])) / len(mine), len(set(mine)) / len(mine),
                     np.mean([min(len(w), 63) for w in mine]) / 10, np.mean([c >> 32 & 1 for c in codes]),
                     np.mean([c >> 33 & 1 for c in codes]), len(mine) / p.words]
        h = np.tanh(x @ q["W"] + q["b"])
        hs.append(h)
        es.append((np.tanh(h @ q["V"]) / (1 + np.exp(-(h @ q["U"])))) @ q["w"])
    a = np.exp(np.array(es) - max(es))
    z = (a / a.sum()) @ np.array(hs)
    return 1 / (1 + np.exp(-(z @ q["c"] + q["d"])))


def some_model(seed=1):
    m = Q.initial(P, 0.6)
    rng = np.random.default_rng(seed)
    for k, v in m.weights.items():
        m.weights[k] = v + rng.normal(0, 0.7, v.shape)
    return m


TEXTS = ["", "one", "One TWO three 44 five! six?? SEVEN seven seven", "a b c d", "a b c d e", "| x | y | 漢字 É é z",
         " \t\n", "word " * 50 + "BAD!! BAD!! " * 9 + "*** 12 3-4 don't"]


def test_score_equals_the_naive_one(monkeypatch):
    m = some_model()
    want = [naive_score(m, t) for t in TEXTS]
    assert np.allclose(m.score(TEXTS, Q._Words()), want, atol=1e-5)
    monkeypatch.setattr(Q, "CHUNK_CHARS", 9)                 # texts in many blocks
    monkeypatch.setattr(Q.blocks, "__defaults__", (9,))
    assert np.allclose(m.score(TEXTS, Q._Words()), want, atol=1e-5)


def test_gradient():
    m = some_model(2)
    bags = [bag_of(t, P) for t in TEXTS]
    starts = np.concatenate([s + o for (_, s), o in zip(bags, np.cumsum([0] + [len(c) for c, _ in bags]))])
    first = np.cumsum([0] + [len(s) for _, s in bags])[:-1]
    x = Q.features(np.concatenate([c for c, _ in bags]), starts, P).astype(np.float64)
    y = np.arange(len(bags)) % 2.0
    _, g = Q.gradient(m, x, first, y)
    rng = np.random.default_rng(3)
    for k, v in m.weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in v.shape)
            keep, losses = m.weights[k], []
            for e in (1e-5, -1e-5):
                w = np.array(keep)
                w[at] += e
                m.weights[k] = w
                losses.append(Q.gradient(m, x, first, y)[0])
            m.weights[k] = keep
            assert abs((losses[0] - losses[1]) / 2e-5 - g[k][at]) < 1e-6, k


def test_attention_finds_the_bad_passage():
    """One bad stretch among many plain passages decides; the label is of the document."""
    rng = np.random.default_rng(4)
    p = Q.MILParams(words=8, hidden=8, gate=4, epochs=25)

    def text(bad):
        parts = [" ".join(f"w{j}" for j in rng.integers(0, 200, 8)) for _ in range(20)]
        if bad:
            parts[rng.integers(0, 20)] = "BUY!! NOW!! " * 4
        return " ".join(parts)

    y = np.arange(300) % 2.0
    texts = [text(v == 0) for v in y]
    m = Q._fit([bag_of(t, p) for t in texts[:200]], y[:200], p)
    s = m.score(texts[200:], Q._Words())
    assert ((s >= 0.5) == y[200:]).mean() > 0.97
    bad = texts[200]
    codes, starts = bag_of(bad, p)
    _, e = m.encode(Q.features(codes, starts, p))
    assert "BUY!!" in " ".join(bad.split()[starts[e.argmax()]:starts[e.argmax()] + 8])


def test_held_out_accuracy(spark):
    import duckdb
    got = queries.QUERIES["op12_quality_mil"](spark, SF_ORACLE).toPandas()
    assert list(got.columns[:4]) == ["doc_id", "held_out", "score", "predicted"]
    truth = dict(duckdb.sql(f"select doc_id, quality from '{SF_ORACLE}/labels.parquet'").fetchall())
    n = duckdb.sql(f"select count(*) from '{SF_ORACLE}/documents.parquet'").fetchall()[0][0]
    assert len(got) == n and got.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got.doc_id, got.held_out))
    held = got[got.held_out & got.doc_id.isin(truth)]
    y = held.doc_id.map(truth)
    assert (held.predicted == y).mean() >= 0.95 and (held.predicted == (held.score >= 0.7)).all()
    assert held[y == 1].predicted.mean() >= 0.98


def test_edges(spark, wild, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (6, None), (None, 1), (99, 1)], "doc_id long, quality int")
    m = Q.fit_quality(wild, labels)
    rows = Q.score_quality(wild, m).collect()
    assert len(rows) == wild.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)}
    assert len(empty) == 1
    assert Q.score_quality(nothing, m).collect() == []
    one = Q.fit_quality(wild, labels.where("quality = 1"))
    assert len({r["score"] for r in Q.score_quality(wild, one).collect()}) == 1
    none = Q.fit_quality(nothing, labels.where("false"))
    assert [r["score"] for r in Q.score_quality(wild.limit(1), none).collect()] == [0.5]
