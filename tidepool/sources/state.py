"""Last accesses per user, kept as a dated table that new days merge into.

A store is a folder with two parts: ``state/as_of=DAY`` holds (by_who,
last_time, named) over all accesses up to that day, ``commits`` one small row a
version. A version counts once its commit row is there, which is written after
its data and, being one file, appears as a whole. A reader therefore sees the
version before or the one after, never a part, and a job that died leaves
data no commit names; the next run of that day overwrites them.

Each version is a folder of its own and is never written again. A day that is
already committed, or earlier than the latest one, changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "as_of STRING"


class LastAccessStore:
    """The store in folder ``root``, which all executors and the driver share.

    Defined results: rows without a user stay one row, as their times count
    for the latest access of the log; a user whose times are all missing has a
    null ``last_time``; an empty day commits an unchanged state.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def versions(self) -> list[str]:
        """The committed days, in order (one small row each)."""
        try:
            rows = self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits").distinct().collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(r.as_of for r in rows)

    def state(self, as_of: dt.date | None = None) -> DataFrame | None:
        """(by_who, last_time, named) as of a committed day (default: the
        latest); None for a store without one."""
        found = self.versions()
        wanted = found[-1] if as_of is None and found else as_of and as_of.isoformat()
        if wanted is None:
            return None
        if wanted not in found:
            raise ValueError(f"no committed state as of {wanted}")
        return self.spark.read.parquet(self._path(wanted))

    def merge(self, accesses: DataFrame, as_of: dt.date) -> bool:
        """Commit the state as of ``as_of``: the latest one and the accesses
        (by_who, access_time) since. False, and nothing done, if that day or a
        later one is committed already.

        One row a user from either side is shuffled: the new rows are combined
        map-side, and a hot user is one row a task.
        """
        day, found = as_of.isoformat(), self.versions()
        if found and day <= found[-1]:
            return False
        new = accesses.select("by_who", F.col("access_time").alias("last_time"), F.col("by_who").isNotNull().alias("named"))
        if found:
            new = self.spark.read.parquet(self._path(found[-1])).unionByName(new)
        merged = new.groupBy("by_who").agg(F.max("last_time").alias("last_time"), F.max("named").alias("named"))
        merged.write.mode("overwrite").parquet(self._path(day))
        self.spark.createDataFrame([(day,)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return True

    def _path(self, day: str) -> str:
        return f"{self.root}/state/as_of={day}"
