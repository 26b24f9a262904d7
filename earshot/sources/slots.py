"""Tables laid out in folders by a slot of time, of which a job replaces some slots as a whole."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.sources.history import exists, hadoop_path, remove


def read_slots(
    spark: SparkSession, path: str, schema: str, slot: str, slots: Iterable | None = None
) -> DataFrame:
    """A table by slot, or no rows if there is none yet; ``slots`` is a filter on its folders.

    ``schema`` includes the slot column, ``slot`` names it.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(schema).parquet(path)
    return table if slots is None else table.where(F.col(slot).isin([*slots]))


class SlotChange:
    """New versions of some slots of the tables below ``base``: staged, then moved into place.

    The staged folder is complete once it has its mark. A job that broke off before that starts
    anew and finds the tables as they were; after that, ``install`` moves what is still staged, so
    running the job again completes it. Moving a slot is a rename, whatever its size.
    """

    MARK = "_COMPLETE"

    def __init__(self, spark: SparkSession, base: str, token: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.root = f"{self.base}/_change-{token}"

    def complete(self) -> bool:
        return exists(self.spark, f"{self.root}/{self.MARK}")

    def begin(self) -> None:
        """Drop what an attempt that broke off has left."""
        remove(self.spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write an intermediate table beside the staged ones and read it back."""
        path = f"{self.root}/_kept/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put(self, name: str, df: DataFrame, slot: str) -> DataFrame:
        """Write the new slots of a table and read them back; the mark is still to come."""
        path = f"{self.root}/{name}"
        df.hint("rebalance", slot).write.partitionBy(slot).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stage(self, tables: dict[str, DataFrame], slot: str) -> None:
        """Write the new slots of all tables by name, then the mark."""
        for name, df in tables.items():
            self.put(name, df, slot)
        self.seal()

    def seal(self) -> None:
        """Mark what was put as complete."""
        fs, mark = hadoop_path(self.spark, f"{self.root}/{self.MARK}")
        fs.create(mark).close()

    def install(self) -> None:
        """Move every staged slot to its table; one folder a slot is handled by the driver."""
        fs, root = hadoop_path(self.spark, self.root)
        for table in fs.listStatus(root):
            name = table.getPath().getName()
            if name.startswith("_"):
                continue
            for folder in fs.listStatus(table.getPath()):
                part = folder.getPath().getName()
                if not folder.isDirectory() or part.startswith("_"):
                    continue
                _, target = hadoop_path(self.spark, f"{self.base}/{name}/{part}")
                if fs.exists(target):
                    fs.delete(target, True)
                fs.mkdirs(target.getParent())
                if not fs.rename(folder.getPath(), target):
                    raise OSError(f"could not move {folder.getPath()} to {target}")
        fs.delete(root, True)
