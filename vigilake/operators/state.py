"""What one run leaves to the next: seen keys, snapshots with a log of changes, append-only logs and a cache of calls, as tables in a given folder.

Each table is a folder of parquet parts, one per run, so a run only adds files; a part that was written halfway has no ``_SUCCESS`` mark and is overwritten by the next run. Folders are given by the caller and lie where
all executors reach them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Log:
    """An append-only table."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        home = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self.fs, self.home = home.getFileSystem(spark._jsc.hadoopConfiguration()), home

    def parts(self) -> list[int]:
        """Numbers of the runs that were completed; one folder per run."""
        if not self.fs.exists(self.home):
            return []
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        numbers = [int(s.getPath().getName()[4:]) for s in self.fs.listStatus(self.home) if s.getPath().getName().startswith("run=")]
        return sorted(n for n in numbers if self.fs.exists(path(f"{self.folder}/run={n}/_SUCCESS")))

    def read(self, since: int = 0) -> DataFrame:
        """All rows of runs from ``since`` on."""
        names = [f"{self.folder}/run={n}" for n in self.parts() if n >= since]
        return self.spark.read.schema(self.schema).parquet(*names) if names else self.spark.createDataFrame([], self.schema)

    def append(self, rows: DataFrame) -> DataFrame:
        """Adds ``rows`` as the next run and returns them as written."""
        n = max(self.parts(), default=-1) + 1
        rows.write.mode("overwrite").parquet(f"{self.folder}/run={n}")
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/run={n}")

    def reset(self) -> None:
        self.fs.delete(self.home, True)


def new_rows(rows: DataFrame, log: Log, key: str, order: Column) -> DataFrame:
    """The rows whose ``key`` no earlier run has seen, the first in ``order`` of each; they are seen from now on.

    ``log`` has the one column ``key``. Rows without a key are never new. Reads of what came before only the keys.
    """
    first = rows.where(F.col(key).isNotNull() & (F.col(key) != "")).withColumn("__o", order).groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in rows.columns]), "__o").alias("__r"))
    fresh = first.join(log.read(), key, "left_anti").select("__r.*")
    seen = log.append(fresh.select(key))
    return first.select("__r.*").join(seen, key, "left_semi")


def changes(rows: DataFrame, snapshots: Log, log: Log, key: str, fields: list[str]) -> DataFrame:
    """``(key, change, field)`` against the last snapshot (``added``, ``removed`` with a null field; ``changed`` per field), appended to ``log``; ``rows`` become the next snapshot.

    ``key`` is unique in ``rows``. The first run only takes the snapshot.
    """
    last = max(snapshots.parts(), default=None)
    old = snapshots.read(last) if last is not None else None
    now = snapshots.append(rows.select(key, *fields))
    if old is None:
        return log.append(now.limit(0).select(key, F.lit("").alias("change"), F.lit("").alias("field")))
    a, b = old.select(F.col(key).alias("__a"), *[F.col(f).alias(f"__{f}") for f in fields]), now
    both = b.join(a, b[key] == a["__a"], "full")
    differ = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"__{f}")), F.lit(f)) for f in fields]))
    kind = F.when(F.col("__a").isNull(), "added").when(F.col(key).isNull(), "removed").otherwise("changed")
    told = both.select(F.coalesce(key, "__a").alias(key), kind.alias("change"), F.when(kind == "changed", differ).otherwise(F.array(F.lit(None).cast("string"))).alias("fs"))
    return log.append(told.select(key, "change", F.explode("fs").alias("field")))


def remembered(rows: DataFrame, cache: Log, key: list[str], call: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with ``result``: ``call`` (``hash`` and the key columns -> ``hash, result``) runs for contents that no earlier run has met, once each; its results are kept.

    ``cache`` has ``hash string, result string``.
    """
    named = rows.withColumn("hash", F.sha2(F.to_json(F.struct(*sorted(key))), 256))
    missing = named.select("hash", *key).dropDuplicates(["hash"]).join(cache.read(), "hash", "left_anti")
    cache.append(call(missing).select("hash", "result"))
    return named.join(cache.read(), "hash", "left").drop("hash")
