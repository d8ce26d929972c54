"""Line dedup against all pairs of lines on small tables."""

import random

from conftest import SF
from feedspark.llm import line_dedup, queries

from .conftest import TEXTS, texts_of


def brute(texts, num=8, den=10):
    """Removed line numbers by id: lines with an earlier line that is similar."""
    out, seen, by = {}, [], {}
    for i, t in sorted(texts):
        out[i] = []
        for no, line in enumerate((t or "").split("\n")):
            w = frozenset(x for x in line.lower().split(" ") if x)
            if not w:
                continue
            near = {k for x in w for k in by.get(x, ())}
            if any(den * len(w & seen[k]) >= num * len(w | seen[k]) for k in near):
                out[i].append(no)
            for x in w:
                by.setdefault(x, []).append(len(seen))
            seen.append(w)
    return out


def made(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(300)}" for _ in range(rng.choice((1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 20, 45)))] for _ in range(40)]
    hot = " ".join(f"h{k}" for k in range(30))
    docs = []
    for i in range(150):
        lines = []
        for _ in range(rng.randrange(6)):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            lines.append(rng.choice((" ", "  ")).join(w))
        lines += [hot] * (i % 3 == 0) + [hot + f" tail{i} and{i} more{i}"] * (i % 5 == 0) + [""]
        lines += [rng.choice(("Solo", "solo", "SOLO "))] * (i % 7 == 0)
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    return docs


def test_random_lines(spark):
    for seed in (1, 2):
        rows = made(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        want = brute(rows)
        got = line_dedup.line_decisions(df).collect()
        assert {r["doc_id"]: r["removed"] for r in got} == want and len(got) == len(rows)
    small = line_dedup.LineParams(buckets=16, filter_bits=64)    # filters that pass nearly all
    got = line_dedup.line_decisions(df, small).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == want
    lists = line_dedup.LineParams(pivots=1, short=2, block=4)    # long lists, dealt into blocks
    got = line_dedup.line_decisions(df, lists).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == want
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert kept == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]) for i, t in rows}


def test_key_sizes():
    assert line_dedup.key_sizes(line_dedup.LineParams()) == (6, 6)
    small, large = line_dedup.key_sizes(line_dedup.LineParams(num=9))
    assert all(3 * n // 10 < n - 2 for n in range(large, 500)) and large * 10 > 9 * small >= 9 * (large - 1)


def test_sketches_never_exceed_the_difference(spark):
    """Each word that only one line has flips one bit, whatever its place."""
    from pyspark.sql import functions as F
    rng = random.Random(9)
    pairs = []
    for _ in range(300):
        x = [f"w{rng.randrange(400)}" for _ in range(rng.choice((1, 3, 8, 30, 120)))]
        y = [w for w in x if rng.random() < 0.9] + [f"v{rng.randrange(50)}" for _ in range(rng.randrange(3))]
        rng.shuffle(y)
        pairs.append((" ".join(x), " ".join(y)))
    df = spark.createDataFrame(pairs, "x string, y string")
    cols = []
    for c in ("x", "y"):
        cols += [k.alias(f"{c}{n}") for n, k in enumerate(line_dedup._wide_sketch(line_dedup.words_of(F.col(c))))]
        cols.append(line_dedup._sketch(line_dedup.token_hashes(F.col(c))).alias(f"{c}t"))
    for r in df.select("x", "y", *cols).collect():
        apart = len(set(r["x"].split()) ^ set(r["y"].split()))
        wide = sum(bin((r[f"x{n}"] ^ r[f"y{n}"]) & (2**64 - 1)).count("1") for n in (0, 1))
        assert wide <= apart and (wide - apart) % 2 == 0
        assert bin(r["xt"] ^ r["yt"]).count("1") <= apart


def test_query(spark):
    got = queries.QUERIES["op7_line_dedup"](spark, SF).collect()
    want = brute(texts_of(SF))
    assert {r["doc_id"]: r["removed"] for r in got} == {i: ",".join(map(str, x)) for i, x in want.items()}
    assert all(r["n_removed"] == len(want[r["doc_id"]]) for r in got)


def test_wild_and_empty(spark, wild, nothing):
    got = line_dedup.line_decisions(wild).collect()
    by = {r["doc_id"]: r["removed"] for r in got}
    assert len(got) == len(TEXTS)
    assert by[1] == [1] and by[5] == [1] and by[6] == [] and by[7] == [0] and by[9] == [] and by[2] == []
    out = line_dedup.dedup_lines(wild)
    assert out.columns == wild.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[2] is None and texts[7] == "" and texts[1] == "The cat sat on the mat."
    assert line_dedup.line_decisions(nothing).count() == 0 and line_dedup.dedup_lines(nothing).count() == 0


def test_rare_tokens_make_pairs(spark):
    """A line whose rare tokens come first has floor(2 (1 - t) n) + 1 keys, not
    floor(3 (1 - t) n) + 1. Whatever is rare, two similar lines share a key."""
    from pyspark.sql import functions as F
    rng, p = random.Random(4), line_dedup.LineParams(buckets=16)
    rows = []
    for k in range(400):
        x = [f"w{rng.randrange(500)}" for _ in range(rng.choice((1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 20, 47)))]
        y = list(x)
        for _ in range(rng.randrange(1 + len(x) // 5)):
            if rng.random() < 0.5:
                y.remove(rng.choice(y))
            else:
                y.append(f"v{rng.randrange(500)}")
        rows += [(2 * k, " ".join(x)), (2 * k + 1, " ".join(y))]
    words = [set(line.split()) for _, line in rows]
    alike = [k for k in range(400) if 10 * len(words[2 * k] & words[2 * k + 1]) >= 8 * len(words[2 * k] | words[2 * k + 1])]
    assert len(alike) > 200
    rank = F.array(*[F.lit(1 + k).cast("long") for k in range(16)])
    lines = spark.createDataFrame(rows, "id long, line string")
    for rare in (0, 3, 8, 16):                       # none, some, half, all of the buckets
        keys = {}
        for r in line_dedup._posts(lines, rank, rare, p).collect():
            keys.setdefault(r["id"], []).append(r["key"])
        assert all(set(keys[2 * k]) & set(keys[2 * k + 1]) for k in alike)
        most = 2 if rare == 16 else 3
        assert all(len(keys[i]) <= max(1, most * 2 * len(w) // 10 + 1) for i, w in enumerate(words) if len(w) > 6)


def test_a_pair_of_long_lists_is_made_once(spark, monkeypatch):
    """Lines that share many long lists meet in one of them only."""
    made, later = [], line_dedup._later

    def seen(pairs, found, texts, p):
        made.append([(r["x"], r["y"]) for r in pairs.select("x", "y").collect()])
        return later(pairs, found, texts, p)

    monkeypatch.setattr(line_dedup, "_later", seen)
    own = lambda i: [f"own{i}x{k}" for k in range(7)]  # noqa: E731  too many to be similar, few enough for the filters
    rows = [(i, " ".join([f"h{k}" for k in range(45)] + own(i))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_decisions(df, line_dedup.LineParams(pivots=1, short=2)).collect()
    assert {r["doc_id"]: r["removed"] for r in got} == brute(rows)
    assert len(made) == 2 and len(made[1]) == len(set(made[1]))
