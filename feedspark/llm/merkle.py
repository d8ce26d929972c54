"""Merkle manifest of a dataset, with proofs by descent of a content-addressed DAG.

Every row is a leaf, the digest of its columns. Within a group (a language) the
leaves ascend by id, runs of `arity` consecutive nodes become their parent, and the
groups' last nodes make the root. What is stored are records from a digest to the
digests of its children (`Manifest.levels`), each written to the shared checkpoint
folder, and the place of every leaf (`Manifest.leaves`).

A proof is asked for a leaf by its group and its rank there. The base-`arity` digits
of the rank, the highest first, say which child to take at every node from the root
down; the children not taken are the siblings of that step. Requests that share
digits share nodes, so they descend together: the frontier holds each wanted node
once (joined to the records on its digest, no key is hot), with the segments found
so far, and only the last step goes to single leaves. Reversed, the segments run
from the leaf to the root, as a check needs them.

The ranks come from a range partition of all leaves, whatever the groups' sizes, and
a level is `arity` times smaller than the one below it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.num import idiv
from ..operators.rowindex import with_row_index
from .common import attach_by_key, cut_lineage, fold, prepare

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of a row: per field `-` for null, else UTF-8 byte count, `:`, value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(*map(part, fields))


@dataclass
class Manifest:
    """`groups`: g (order number), name, n (leaves), depth, subroot. `leaves`: g, pos
    (rank in the group), doc_id, leaf, extra columns. `levels[k]`: digest, children,
    the records of nodes k + 1 steps above the leaves; `top`: the root's record."""
    arity: int
    leaves: DataFrame
    groups: DataFrame
    levels: list[DataFrame]
    top: DataFrame


def _depth(n: Column, arity: int, most: int) -> Column:
    """Levels above the leaves of a group of `n`; `most` bounds `n`."""
    depth, width = F.lit(0), 1
    while width < most:
        depth = depth + (n > F.lit(width)).cast("int")
        width *= arity
    return depth


def build_manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id",
                   fields: tuple[str, ...] = FIELDS, arity: int = ARITY,
                   extra: dict[str, Column] | None = None) -> Manifest:
    """Leaves, records and root of `docs`. Nulls of `group` are a group of their own,
    the first; null ids come first in their group, and rows of one id in the order of
    their digests, so repeated rows give the same tree in any order. `extra` are more
    columns over `docs` to keep with the leaves. An empty table has no groups and no
    root record."""
    prepare(docs.sparkSession)
    name = F.col(group).cast("string")
    key = F.coalesce(F.concat(F.lit("+"), name), F.lit(""))          # null first, then bytewise
    rows = docs.select(key.alias("_key"), F.col(order).alias("doc_id"),
                       leaf_digest([F.col(f) for f in fields]).alias("leaf"),
                       *[c.alias(k) for k, c in (extra or {}).items()])
    rows = cut_lineage(rows)                     # the range partition reads it twice, the texts once
    indexed = with_row_index(rows, [F.col(c).asc_nulls_first() for c in ("_key", "doc_id", "leaf")], "_idx")
    sizes = cut_lineage(indexed.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.min("_idx").alias("_first")))
    n_rows, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    sizes = with_row_index(sizes.withColumn("depth", _depth(F.col("n"), arity, most)), [F.col("_key")], "g")
    sizes = cut_lineage(sizes)
    depths = {r["depth"] for r in sizes.select("depth").distinct().collect()}     # at most log(n) of them
    leaves = cut_lineage(attach_by_key(indexed, sizes, "_key", "n", n_rows)
                         .withColumn("pos", F.col("_idx") - F.col("_first")).drop("_key", "_idx", "_first", "n"))
    level, levels, subroots = leaves.select("g", "depth", "pos", F.col("leaf").alias("digest")), [], []
    for d in range(max(depths, default=-1) + 1):
        if d:
            run = F.array_sort(F.collect_list(F.struct("pos", "digest")))
            made = cut_lineage(level.groupBy("g", "depth", idiv("pos", arity).alias("pos"))
                               .agg(run.alias("_run")).select("g", "depth", "pos", F.col("_run.digest").alias("children"))
                               .withColumn("digest", F.sha2(F.array_join("children", ""), 256)))
            levels.append(made.select("digest", "children").dropDuplicates(["digest"]))
            level = made.select("g", "depth", "pos", "digest")
        if d in depths:
            subroots.append(level.where(F.col("depth") == d).select("g", F.col("digest").alias("subroot")))
            level = level.where(F.col("depth") > d)
    found = reduce(DataFrame.unionByName, subroots) if subroots else docs.sparkSession.createDataFrame(
        [], "g long, subroot string")
    groups = cut_lineage(sizes.join(found, "g").select("g", F.expr("if(_key = '', null, substring(_key, 2))")
                                                       .alias("name"), "n", "depth", "subroot"))
    top = (groups.agg(F.array_sort(F.collect_list(F.struct("g", "subroot"))).alias("_run"))
           .select(F.col("_run.subroot").alias("children")).where(F.size("children") > 0)
           .select(F.sha2(F.array_join("children", ""), 256).alias("digest"), "children"))
    return Manifest(arity, leaves.drop("depth"), groups, levels, cut_lineage(top))


def _step(run: Column, at: Column) -> Column:
    """One path segment: the children before and after the one that is taken."""
    return F.struct(F.array_join(F.slice(run, F.lit(1), at), "").alias("before"),
                    F.array_join(F.slice(run, at + 2, F.greatest(F.size(run) - at - 1, F.lit(0))), "").alias("after"))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """`requests` (g, pos and any more columns) with `subroot`, `root`, `found` (the
    digest the descent ends at) and `path`: the segments (`before`, `after`) from the
    leaf's run up to the root's. Requests for places that the manifest has not are left
    out; repeated requests are each answered."""
    a = manifest.arity
    more = [c for c in requests.columns if c not in ("g", "pos")]
    # requests of one run of leaves travel as one row, in lists of bounded length however often
    # a place is asked for
    asked = requests.select("g", "pos", F.struct(*more).alias("_rest"), idiv("pos", a).alias("_at"),
                            F.shiftright(F.monotonically_increasing_id(), 10).alias("_bin"))
    waiting = asked.groupBy("g", "_at", "_bin").agg(F.collect_list(F.struct("pos", "_rest")).alias("_asked"))
    waiting = cut_lineage(waiting.drop("_bin"))
    wanted = waiting.select("g", "_at").distinct()
    top = manifest.top                          # one row, or none where there is no group either
    start = (manifest.groups.select("g", "n", "depth", top.select("digest").scalar().alias("root"), "subroot",
                                    F.lit(0).cast("long").alias("_at"), F.col("subroot").alias("digest"),
                                    top.select("children").scalar().alias("_run"))
             .withColumn("_path", F.array(_step(F.col("_run"), F.col("g").cast("int")))).drop("_run"))
    start = cut_lineage(start)
    front = start.where(F.lit(False)).drop("depth")
    for d in range(len(manifest.levels), 0, -1):
        front = front.unionByName(start.where(F.col("depth") == d).drop("depth"))
        front = front.join(manifest.levels[d - 1], "digest")
        if d > 1:
            width = a ** (d - 2)                 # leaves' runs below a child
            need = wanted.select("g", idiv("_at", width).alias("_at")).distinct()
            child = front.select("*", F.posexplode("children").alias("_k", "_child"))
            front = cut_lineage(
                child.select("g", "n", "root", "subroot", (F.col("_at") * a + F.col("_k")).alias("_at"),
                             F.col("_child").alias("digest"),
                             F.concat("_path", F.array(_step(F.col("children"), F.col("_k")))).alias("_path"))
                .join(need, ["g", "_at"], "left_semi"))
    lone = start.where(F.col("depth") == 0).drop("depth").withColumn("children", F.array("digest"))
    front = front.unionByName(lone) if manifest.levels else lone
    got = front.join(waiting, ["g", "_at"]).withColumn("_q", F.explode("_asked"))
    got = got.where((F.col("_q.pos") >= 0) & (F.col("_q.pos") < F.col("n")))
    k = (F.col("_q.pos") % a).cast("int")
    # a lone leaf is its own subroot: it has no run besides the root's
    path = F.when(F.col("n") > 1, F.concat("_path", F.array(_step(F.col("children"), k)))).otherwise(F.col("_path"))
    return got.select("g", F.col("_q.pos").alias("pos"), "root", "subroot",
                      F.element_at("children", k + 1).alias("found"), F.reverse(path).alias("path"), "_q._rest.*")


def proof_digest(path: Column) -> Column:
    """The digest of a proof: its siblings, level by level to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that `leaf` and the siblings of `path` lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def verify_rows(docs: DataFrame) -> DataFrame:
    """One row per document: `doc_id`, `leaf`, `subroot`, `root`, `proof_sha256` of the
    manifest, and what a check finds after some rows were tampered with (those whose
    crc32 of the id is divisible by 3 have the text's A-Z in lower case):
    `folded_root`, from the row as it is then and the original siblings, and `verified`.

    Null texts stay null; a text without A-Z stays as it was and is verified. Every
    proof holds all other groups' subroots, so it grows with their number."""
    tampered = [F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
                if f == "text" else F.col(f) for f in FIELDS]
    now = F.when(fold("doc_id", 3) == 0, leaf_digest(tampered))
    m = build_manifest(docs, extra={"_now": now})
    proofs = prove(m, m.leaves.select("g", "pos", "doc_id", "_now"))
    out = proofs.select("doc_id", F.col("found").alias("leaf"), "subroot", "root",
                        proof_digest(F.col("path")).alias("proof_sha256"),
                        folded(F.col("path"), F.coalesce("_now", "found")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
