"""Visits that are kept over loads: a load rolls up only the patients whose encounters it has."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.operators.visits import _CELL, _VISIT, chain_cells, reduce_to_cells, visits_of_cells
from clinspark.staging import Staging


class VisitStore:
    """Cells of all loads below ``path``, and the visits that they make.

    Cells of several loads merge exactly (smallest start, largest end, sum), so loads give the same visits in any order, and
    no earlier encounter is read again. A load first stores which keys it touches, then its cells, then the
    visits of those keys as a new version; of each key the latest version counts. A repeated load replaces its own cells,
    and touches also what it held before. Keys of a load that broke off are rolled up by the next one. Loads follow each
    other. Null keys are keys, and the length of the gap belongs to the path.

    A patient's visits are as many rows as versions touch it, so a store of very many loads should be built anew from its
    cells at times: ``add`` them to another path.
    """

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], *, gap_days: int = 1) -> None:
        self.spark, self.by, self.gap_days = spark, list(by), gap_days
        self.path = f"{path.rstrip('/')}/gap-{gap_days}"

    def _complete(self, kind: str) -> list[str]:
        """Folders of one kind whose write is complete: one or two for each load."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/*/_SUCCESS")
        found = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(folder) or []
        return sorted(f.getPath().getParent().getName() for f in found)

    def _versions(self, kind: str) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in self._complete(kind))

    def _read(self, kind: str, names: Sequence[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{kind}/{n}" for n in names])

    def _of(self, df: DataFrame, keys: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
        others = keys.select(*[F.col(c).alias(f"_of_{c}") for c in columns])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
        return df.join(others, same, how)

    def add(
        self, load: str, encounters: DataFrame, staging: Staging, *, start: str = "start", stop: str = "stop"
    ) -> DataFrame:
        """Store the encounters of a ``load`` and return the visits of the keys it touches."""
        fresh = staging.table(reduce_to_cells(encounters, self.by, start=start, stop=stop, gap_days=self.gap_days))
        touched, rolled = self._versions("touched"), self._versions("rolled")
        own = f"load={quote(load, safe='')}"
        keys = [fresh.select(*self.by)]
        if own in self._complete("cells"):
            keys.append(self._read("cells", [own]).select(*self.by))
        if broken := [v for v in touched if v not in rolled and v > max(rolled, default=-1)]:
            keys.append(self._read("touched", [f"version={v}" for v in broken]).select(*self.by))
        version = f"version={max([*touched, *rolled], default=-1) + 1}"
        reduce(DataFrame.union, keys).distinct().write.mode("overwrite").parquet(f"{self.path}/touched/{version}")
        fresh.write.mode("overwrite").parquet(f"{self.path}/cells/{own}")

        cells = self._read("cells", self._complete("cells"))
        cells = self._of(cells, self._read("touched", [version]), self.by, "left_semi").groupBy(*self.by, _CELL).agg(
            F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("_n").alias("_n"))
        chain_cells(cells, self.by, gap_days=self.gap_days).write.mode("overwrite").parquet(f"{self.path}/rolled/{version}")
        return visits_of_cells(self._read("rolled", [version]), self.by).drop(_VISIT)

    def cells(self) -> DataFrame:
        """The cells of all loads with their visit, as ``visit_cells`` gives them for all encounters at once."""
        versions = [f"version={v}" for v in self._versions("rolled")]
        if not versions:
            raise ValueError(f"no load is stored in {self.path}")
        # A key whose encounters are all gone is touched, but has no cells in that version.
        latest = self._read("touched", versions).groupBy(*self.by).agg(F.max("version").alias("version"))
        return self._of(self._read("rolled", versions), latest, [*self.by, "version"], "left_semi").drop("version")

    def visits(self) -> DataFrame:
        """One row per visit, as ``roll_up_visits`` gives them for all encounters at once."""
        return visits_of_cells(self.cells(), self.by).drop(_VISIT)
