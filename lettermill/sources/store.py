"""A keyed store in a folder: batches that are committed whole, laid out by buckets of the key.

``data/batch=<name>/bucket=<n>`` holds rows, ``commits/batch=<name>`` says of a batch that it counts, and which earlier
ones it takes the place of. A commit is one small file, written with its marker after all rows are there: a batch that
broke off before has no commit, is read by no one, and is written anew when it is sent again. A batch sent again after its
commit changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMMIT = "replaces array<string>, buckets array<int>, n bigint"


class KeyedStore:
    """The store under ``path``; rows have the columns of ``schema``, of which ``key`` names one row.

    ``buckets`` is a property of the store: choose it so that a bucket of all batches fits a task. Batch names sort in the
    order of commits. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, list(key), buckets
        self.columns = spark.createDataFrame([], schema).columns

    def _names(self, part: str) -> list[str]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def _commits(self) -> dict[str, dict]:
        """Commits by batch name: as many rows as batches since the last compaction of their folder."""
        done = [n for n in self._names("commits") if "_SUCCESS" in self._names(f"commits/{n}")]
        if not done:
            return {}
        rows = self.spark.read.schema(COMMIT + ", batch string").json([f"{self.path}/commits/{n}" for n in done], pathGlobFilter="*.json")
        named = rows.select(F.regexp_extract(F.col("_metadata.file_path"), "batch=([^/]+)/", 1).alias("name"), "replaces", "buckets", "n")
        return {r["name"]: r.asDict() for r in named.collect()}

    def batches(self) -> list[str]:
        """Names of the batches that count, in their order."""
        commits = self._commits()
        gone = {name for c in commits.values() for name in c["replaces"] or ()}
        return sorted(commits.keys() - gone)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.key]), F.lit(self.buckets)).cast("int")

    def _read(self, batches: list[str], buckets: Sequence[int] | None = None) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], f"{self.schema}, bucket int, batch string")
        rows = (self.spark.read.option("basePath", f"{self.path}/data").schema(f"{self.schema}, bucket int, batch string")
                .parquet(*[f"{self.path}/data/batch={b}" for b in batches]))
        return rows if buckets is None else rows.filter(F.col("bucket").isin(list(buckets)))

    def current(self) -> DataFrame:
        """All rows that count."""
        return self._read(self.batches()).select(*self.columns)

    def _commit(self, name: str, rows: DataFrame, replaces: Sequence[str]) -> None:
        place = f"{self.path}/data/batch={name}"
        spread = rows.select(*self.columns, self._bucket().alias("bucket")).repartition("bucket")
        spread.write.mode("overwrite").partitionBy("bucket").parquet(place)
        filled = [int(n.removeprefix("bucket=")) for n in self._names(f"data/batch={name}") if n.startswith("bucket=")]
        written = self._read([name]).count() if filled else 0
        told = self.spark.createDataFrame([(list(replaces), filled, written)], COMMIT)
        told.coalesce(1).write.mode("overwrite").json(f"{self.path}/commits/batch={name}")

    def append(self, name: str, rows: DataFrame, counts: Callable[[DataFrame], DataFrame] = lambda stored: stored) -> bool:
        """Take in the rows whose key is not in the store, of rows with one key the first in the order of all columns.

        ``counts`` picks the stored rows whose keys are taken; a key of others can be stored again. Null is a key like any
        other. Of what is stored only the buckets that the new rows fall in are read. Returns False, and does nothing, if
        the batch is committed.
        """
        commits = self._commits()
        if name in commits:
            return False
        if commits and name < max(commits):
            raise ValueError(f"batch {name!r} comes after {max(commits)!r}")
        first = Window.partitionBy(*self.key).orderBy(*self.columns)
        own = rows.select(*self.columns).withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth").withColumn("bucket", self._bucket())
        stored = self.batches()
        if stored:
            fallen = [r[0] for r in own.select("bucket").distinct().collect()]  # at most as many as there are buckets
            known = counts(self._read(stored, fallen)).select("bucket", *[F.col(c).alias(f"_{c}") for c in self.key])
            same = known["bucket"] == own["bucket"]
            for c in self.key:
                same = same & own[c].eqNullSafe(known[f"_{c}"])
            own = own.join(known, same, "left_anti")
        self._commit(name, own, [])
        return True

    def compact(self, name: str) -> bool:
        """Write all rows that count as one batch, a file per bucket, in place of the batches they came in."""
        commits, stored = self._commits(), self.batches()
        if name in commits or len(stored) < 2:
            return False
        if name < max(commits):
            raise ValueError(f"batch {name!r} comes after {max(commits)!r}")
        self._commit(name, self._read(stored), stored)
        return True
