"""Tables that streams keep: keyed tables of which a batch rewrites only the buckets it touches, and dimensions that batches read anew.

Both name what they write by its batch, so a batch that runs again writes the same, and both take old files away.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.operators import state

#: Batches whose files stay besides the newest one's, for readers that have begun and for a batch that runs again.
KEPT = 2


def _files(spark: SparkSession, path: str):
    """The file system of a path and the path, as Hadoop has them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """N of the folders `name=N` that are written to their end, ascending."""
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return []
    done = [x.getPath() for x in fs.listStatus(where) if x.isDirectory() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done if p.getName().startswith(f"{name}="))


def _remove(spark: SparkSession, path: str) -> None:
    fs, where = _files(spark, path)
    fs.delete(where, True)


class Keyed:
    """A table of one row for each key in `buckets` buckets by the hash of the key.

    how gives each other column's aggregate over old and new rows; it must be associative. A batch reads and writes the buckets of
    its keys only: data/batch=N/bucket=B. A manifest of a row for each bucket, manifest/batch=N, says which batch wrote it last,
    and makes the batch's version the current one when it is complete. An empty table has no manifest.
    """

    def __init__(self, path: str, keys: list[str], how: dict[str, Column], buckets: int = 64):
        self.path, self.keys, self.how, self.buckets = path, keys, how, buckets

    def _manifest(self, spark: SparkSession, before: int | None = None) -> tuple[int, dict[int, int]]:
        """The newest batch, or the newest before one, and the batch that wrote each bucket."""
        known = [n for n in _numbers(spark, f"{self.path}/manifest", "batch") if before is None or n < before]
        if not known:
            return -1, {}
        rows = spark.read.schema("bucket int, written long").parquet(f"{self.path}/manifest/batch={known[-1]}").collect()  # a row a bucket
        return known[-1], {r["bucket"]: r["written"] for r in rows}

    def _of(self, spark: SparkSession, schema, written: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/batch={n}/bucket={b}" for b, n in sorted(written.items())]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def put(self, batch: DataFrame, batch_id: int) -> None:
        """Merge a batch; a foreachBatch function. Rows with a null key are a key like any other."""
        spark = batch.sparkSession
        new = batch.groupBy(*self.keys).agg(*[c.alias(n) for n, c in self.how.items()])
        schema, bucket = new.schema, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = new.persist()
        try:
            touched = [r[0] for r in new.select(bucket).distinct().collect()]  # at most a row a bucket
            _, written = self._manifest(spark, batch_id)
            old = self._of(spark, schema, {b: n for b, n in written.items() if b in touched})
            both = state.merged(old, new, self.keys, self.how).withColumn("bucket", bucket)
            both.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/data/batch={batch_id}")
        finally:
            new.unpersist()
        written |= dict.fromkeys(touched, batch_id)
        spark.createDataFrame(sorted(written.items()), "bucket int, written long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}")
        self._tidy(spark)

    def _tidy(self, spark: SparkSession) -> None:
        """Take away all manifests but the newest ones, and buckets that only those named."""
        known = _numbers(spark, f"{self.path}/manifest", "batch")
        named = {n: set(self._manifest(spark, n + 1)[1].items()) for n in known[-2 - KEPT :]}
        kept = set().union(*[named[n] for n in known[-1 - KEPT :]])
        for n in known[: -1 - KEPT]:
            for b, written in named.get(n, set()) - kept:
                _remove(spark, f"{self.path}/data/batch={written}/bucket={b}")
                if written not in {w for _, w in kept}:
                    _remove(spark, f"{self.path}/data/batch={written}")
            _remove(spark, f"{self.path}/manifest/batch={n}")

    def current(self, spark: SparkSession, schema) -> DataFrame:
        """The table as the newest complete batch left it."""
        return self._of(spark, schema, self._manifest(spark)[1])


class Refreshing:
    """A dimension that a stream's batches read, loaded again when it is older than `ttl_ms`.

    load(spark, now) gives the dimension as of a time. What is loaded is written as version=N, N being the batch that loaded it,
    with its time in loaded=N; each batch reads the newest version that a batch up to itself has loaded. So a batch that runs
    again reads the same rows, whatever load gives by then. now is the batch's own clock: wall-clock time, or the time of its rows.
    """

    def __init__(self, path: str, load: Callable[[SparkSession, int], DataFrame], ttl_ms: int = 3_600_000):
        self.path, self.load, self.ttl_ms = path, load, ttl_ms

    def at(self, spark: SparkSession, batch_id: int, now: int) -> DataFrame:
        """The dimension for a batch."""
        known = [n for n in _numbers(spark, f"{self.path}/loaded", "version") if n <= batch_id]
        if known and known[-1] < batch_id and now - self._time(spark, known[-1]) < self.ttl_ms or known and known[-1] == batch_id:
            return self._read(spark, known[-1])
        self.load(spark, now).write.mode("overwrite").parquet(f"{self.path}/rows/version={batch_id}")
        spark.createDataFrame([(now,)], "loaded long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/loaded/version={batch_id}")
        for n in known[:-KEPT]:
            _remove(spark, f"{self.path}/loaded/version={n}")
            _remove(spark, f"{self.path}/rows/version={n}")
        return self._read(spark, batch_id)

    def _time(self, spark: SparkSession, version: int) -> int:
        return spark.read.schema("loaded long").parquet(f"{self.path}/loaded/version={version}").first()[0]

    def _read(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows/version={version}").withColumn("version", F.lit(version).cast("long"))
