"""A target of ids that a stream can be loaded into without reading all of it
(S23, T01, K01).

The ids lie in buckets by a hash of the id, each a folder of its own. A micro-batch
reads only the buckets that its ids fall into, and the folders of those are all that is
listed. Buckets are kept small: `tend` rewrites those with many files into one version
of sorted files, and doubles the number of buckets when they have outgrown their size,
so what a batch of a given size reads does not grow with the target.

Both rewrites are staged: new folders are written beside the old ones, checked, and
take effect by one rename of a small manifest; a job that fails in between leaves the
old state. One writer at a time, as the loader of a stream is.

    path/_manifest/00000003.json    {"data": "data-0", "n_buckets": 64, "version": {"7": 1}}
    path/data-0/bucket=7/version=1/part-...
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A bucket is rewritten from this many files on.
MAX_FILES = 8
#: Mean bytes of a bucket beyond which the number of buckets is doubled.
BUCKET_BYTES = 64 << 20
MAX_BUCKETS = 1 << 16


class KeyedTarget:
    """The id table at `path`; `key` is its only column."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id"):
        self.spark, self.path, self.key = spark, path, key
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ files

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _publish(self, state: dict) -> None:
        """The next manifest, whole or not at all."""
        names = [n for n in self._names(f"{self.path}/_manifest") if n.endswith(".json")]
        number = int(names[-1][:-5]) + 1 if names else 0
        temp = self._path(f"{self.path}/_manifest/.{number:08d}.tmp")
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not self._fs.rename(temp, self._path(f"{self.path}/_manifest/{number:08d}.json")):
            raise RuntimeError(f"another writer has published manifest {number} of {self.path}")
        for old in names[:-4]:
            self._fs.delete(self._path(f"{self.path}/_manifest/{old}"), False)

    @property
    def state(self) -> dict:
        names = [n for n in self._names(f"{self.path}/_manifest") if n.endswith(".json")]
        if not names:
            raise FileNotFoundError(f"{self.path} is no keyed target")
        return json.loads(self._text(f"{self.path}/_manifest/{names[-1]}"))

    def exists(self) -> bool:
        return any(n.endswith(".json") for n in self._names(f"{self.path}/_manifest"))

    # ------------------------------------------------------------ reading

    def _bucket(self, n: int):
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def _folders(self, state: dict, buckets: list[int] | None = None) -> list[str]:
        """The live folders of the buckets (of all), those that exist."""
        data = f"{self.path}/{state['data']}"
        there = [int(n[7:]) for n in self._names(data) if n.startswith("bucket=")]
        mine = there if buckets is None else sorted(set(there) & set(buckets))
        return [f"{data}/bucket={b}/version={state['version'].get(str(b), 0)}" for b in mine]

    def read(self, buckets: list[int] | None = None, state: dict | None = None) -> DataFrame:
        """The ids (with `bucket`) of these buckets, or of all; no other folder is listed or read."""
        state = state or self.state
        folders = self._folders(state, buckets)
        schema = f"{self.key} string, bucket int, version int"
        if not folders:
            return self.spark.createDataFrame([], schema).drop("version")
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/{state['data']}")
                .parquet(*folders).drop("version"))

    # ------------------------------------------------------------ writing

    def create(self, seed: DataFrame | None = None, n_buckets: int = 64) -> KeyedTarget:
        """The target with the distinct ids of `seed`; an error if there is one already."""
        if self.exists():
            raise FileExistsError(f"{self.path} is a keyed target already")
        state = {"data": "data-0", "n_buckets": n_buckets, "version": {}}
        if seed is not None:
            ids = seed.select(F.col(self.key).cast("string").alias(self.key)).where(F.col(self.key).isNotNull())
            self._write(ids.dropDuplicates([self.key]).withColumn("bucket", self._bucket(n_buckets)), state)
        self._publish(state)
        return self

    def _write(self, rows: DataFrame, state: dict) -> None:
        """Append (id, bucket) rows to the live versions, a file a bucket and task."""
        pairs = [F.lit(x) for b, v in state["version"].items() for x in (int(b), v)]
        version = F.coalesce(F.create_map(*pairs)[F.col("bucket")], F.lit(0)) if pairs else F.lit(0)
        (rows.select(self.key, "bucket", version.cast("int").alias("version")).repartition("bucket")
         .sortWithinPartitions("bucket", self.key).write.mode("append").partitionBy("bucket", "version")
         .parquet(f"{self.path}/{state['data']}"))

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The distinct ids of `batch` (with `bucket`) that the target has not; reads the
        buckets of the batch only. The batch is checkpointed: it is asked for its buckets
        first, at most `n_buckets` numbers."""
        state = self.state
        keys = batch.select(F.col(self.key).cast("string").alias(self.key)).where(F.col(self.key).isNotNull())
        keys = cut_lineage(keys.dropDuplicates([self.key]).withColumn("bucket", self._bucket(state["n_buckets"])))
        mine = [r["bucket"] for r in keys.select("bucket").distinct().collect()]
        return keys.join(self.read(mine, state), [self.key, "bucket"], "left_anti")

    def append(self, batch: DataFrame) -> None:
        """Load the unseen ids. A replayed batch adds nothing."""
        self._write(self.unseen(batch), self.state)

    def tend(self, max_files: int = MAX_FILES, bucket_bytes: int = BUCKET_BYTES) -> dict:
        """Rewrite buckets with many files, or all into twice as many when they are too
        large. Returns what was done: `rewritten` buckets, `n_buckets`."""
        state = self.state
        folders = self._folders(state)
        files = {f: [s for s in self._fs.listStatus(self._path(f)) if s.getPath().getName().startswith("part-")]
                 for f in folders if self._fs.exists(self._path(f))}
        size, n = sum(s.getLen() for x in files.values() for s in x), state["n_buckets"]
        if size > bucket_bytes * n and n < MAX_BUCKETS:
            while size > bucket_bytes * n and n < MAX_BUCKETS:
                n *= 2
            fresh = {"data": f"data-{int(state['data'].split('-')[1]) + 1}", "n_buckets": n, "version": {}}
            self._fs.delete(self._path(f"{self.path}/{fresh['data']}"), True)      # of a rewrite that failed
            self._write(self.read(state=state).select(self.key).withColumn("bucket", self._bucket(n)), fresh)
            self._check(self.read(state=state), self.read(state=fresh))
            self._publish(fresh)
            self._fs.delete(self._path(f"{self.path}/{state['data']}"), True)
            return {"rewritten": n, "n_buckets": n}
        many = [int(f.split("/bucket=")[1].split("/")[0]) for f, x in files.items() if len(x) >= max_files]
        if many:
            fresh = {**state, "version": dict(state["version"])}
            for b in many:
                taken = [int(v[8:]) for v in self._names(f"{self.path}/{state['data']}/bucket={b}") if v.startswith("version=")]
                fresh["version"][str(b)] = max(taken) + 1
            self._write(self.read(many, state), fresh)
            self._check(self.read(many, state), self.read(many, fresh))
            self._publish(fresh)
            for old in self._folders(state, many):
                self._fs.delete(self._path(old), True)
        return {"rewritten": len(many), "n_buckets": n}

    def _check(self, old: DataFrame, new: DataFrame) -> None:
        def sums(df):
            return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64(self.key)), F.lit(0))).first())
        if sums(old) != sums(new):
            raise RuntimeError(f"the rewrite of {self.path} lost or doubled ids; the old state stays")


def load_keyed_batch(path: str, key: str = "id", tend_every: int = 16, max_files: int = MAX_FILES,
                     bucket_bytes: int = BUCKET_BYTES):
    """foreachBatch body: append the batch's unseen ids to the keyed target; after every
    `tend_every`-th batch the target is tended."""
    def run(batch: DataFrame, batch_id: int) -> None:
        target = KeyedTarget(batch.sparkSession, path, key)
        target.append(batch)
        if tend_every and batch_id % tend_every == tend_every - 1:
            target.tend(max_files, bucket_bytes)
    return run


def stream_keyed_load(spark: SparkSession, landing: str, schema, target_path: str, checkpoint: str, key: str = "id",
                      files_per_trigger: int | None = None, fmt: str = "parquet", tend_every: int = 16,
                      max_files: int = MAX_FILES, bucket_bytes: int = BUCKET_BYTES):
    """T01 / T03 / T08 into a keyed target: drains what has landed and stops."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    q = (reader.load(landing).select(key).writeStream
         .foreachBatch(load_keyed_batch(target_path, key, tend_every, max_files, bucket_bytes))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
