"""A ledger of runs: what each step of each run counted, and which days it changed."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot.sources.tables import read_or_empty

ROWS = "counts map<string,bigint>, days array<date>, used array<string>, step string, run string"


class Counter:
    """Row counts of frames, observed while they are written, at no further pass."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        self._seen[name] = Observation()
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """To be asked after the frames were written."""
        return {name: seen.get["rows"] for name, seen in self._seen.items()}


class Ledger:
    """One row per step and run, in a folder of its own, which a repeated run replaces or leaves."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(
        self, step: str, run: str, counts: dict[str, int], days: Iterable[date] = (), used: Iterable[str] = ()
    ) -> None:
        """Store the counts of a step; the same step and run again replaces them."""
        row = [(counts, sorted(days), sorted(used))]
        frame = self.spark.createDataFrame(row, "counts map<string,bigint>, days array<date>, used array<string>")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/step={step}/run={run}")

    def rows(self, step: str | None = None) -> DataFrame:
        found = read_or_empty(self.spark, self.path, ROWS)
        return found if step is None else found.where(F.col("step") == step)

    def counted(self) -> DataFrame:
        """(step, run, name, rows) of every count."""
        return self.rows().select("step", "run", F.explode("counts").alias("name", "rows"))

    def once(self, step: str, run: str, job: Callable[[], dict[str, int]]) -> dict[str, int]:
        """The counts of a step, which is not run again for a run that has them."""
        found = self.rows(step).where(F.col("run") == run).select("counts").first()
        if found is not None:
            return found.counts
        counts = job()
        self.record(step, run, counts)
        return counts

    def pending(self, steps: Iterable[str], by: str) -> tuple[set[str], set[date]]:
        """Runs of ``steps`` that no run of ``by`` has used, and the days they changed."""
        taken = {u for r in self.rows(by).select(F.explode("used").alias("u")).collect() for u in [r.u]}
        names = F.concat_ws("/", "step", "run").alias("name")
        rows = self.rows().where(F.col("step").isin([*steps])).select(names, "days").collect()
        fresh = [r for r in rows if r.name not in taken]
        return {r.name for r in fresh}, {day for r in fresh for day in r.days}
