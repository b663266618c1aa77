"""Tables that a stream writes batch by batch: versions of keyed rows
(STR-4, update mode) and the manifest of committed batches (STR-9).

Every batch writes its own folder with overwrite, so a replayed batch
replaces its rows; the tables say which of the folders count.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.session import folder_exists, folder_names, remove_folder


@dataclass
class VersionedTable:
    """Rows of which a later batch replaces those with the same ``keys``.

    In update mode a stream emits a window again whenever it changes.
    ``write`` keeps each batch's rows as they are; ``read`` gives the newest
    version of each key, by one aggregate that combines before its shuffle;
    ``compact`` folds the batches so far into one base folder, so that reads
    list and scan only it and the batches behind it.
    """
    root: str
    keys: tuple[str, ...]

    @property
    def _deltas(self) -> str:
        return os.path.join(self.root, "deltas")

    @property
    def _base(self) -> str:
        return os.path.join(self.root, "base")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(os.path.join(self._deltas, f"batch_id={batch_id}"))

    def _compacted(self, spark: SparkSession) -> int | None:
        """Last batch that a base folder holds. A base counts once its job
        has committed (``_SUCCESS``)."""
        if not folder_exists(spark, self._base):
            return None
        done = [int(n.split("=")[1]) for n in folder_names(spark, self._base)
                if n.startswith("upto=") and folder_exists(spark, os.path.join(self._base, n, "_SUCCESS"))]
        return max(done, default=None)

    def _versions(self, spark: SparkSession) -> DataFrame:
        upto = self._compacted(spark)
        parts = []
        new = [n for n in folder_names(spark, self._deltas) if n.startswith("batch_id=")
               and (upto is None or int(n.split("=")[1]) > upto)] if folder_exists(spark, self._deltas) else []
        if new:
            parts.append(spark.read.option("basePath", self._deltas).parquet(
                *(os.path.join(self._deltas, n) for n in new)))
        if upto is not None:
            base = spark.read.parquet(os.path.join(self._base, f"upto={upto}"))
            parts.append(base.withColumn("batch_id", F.lit(upto)))
        if not parts:
            raise ValueError(f"nothing was written to {self.root}")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest version of each row."""
        rows = self._versions(spark)
        rest = [c for c in rows.columns if c not in (*self.keys, "batch_id")]
        newest = F.max_by(F.struct(*rest), F.col("batch_id")).alias("_newest")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_newest.*")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold all batches up to ``upto`` into one base folder. Call it
        between batches; a reader sees the old or the new state."""
        old = self._compacted(spark)
        if old is not None and old >= upto:
            return
        versions = self._versions(spark).where(F.col("batch_id") <= upto)
        rest = [c for c in versions.columns if c not in (*self.keys, "batch_id")]
        newest = F.max_by(F.struct(*rest), F.col("batch_id")).alias("_newest")
        (versions.groupBy(*self.keys).agg(newest).select(*self.keys, "_newest.*")
         .write.mode("overwrite").parquet(os.path.join(self._base, f"upto={upto}")))
        for name in folder_names(spark, self._deltas):
            if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
                remove_folder(spark, os.path.join(self._deltas, name))
        if old is not None:
            remove_folder(spark, os.path.join(self._base, f"upto={old}"))


@dataclass
class BatchManifest:
    """Which batches are complete: a batch that wrote only some of its outputs
    before it failed is not read until its replay has written all of them."""
    root: str

    @property
    def _path(self) -> str:
        return os.path.join(self.root, "_manifest")

    def commit(self, spark: SparkSession, batch_id: int, rows: dict[str, int]) -> None:
        """Mark a batch complete, with the rows of each of its outputs."""
        (spark.createDataFrame([(name, n) for name, n in rows.items()], "output string, rows long")
         .coalesce(1).write.mode("overwrite").json(os.path.join(self._path, f"batch_id={batch_id}")))

    def committed(self, spark: SparkSession) -> DataFrame:
        """``batch_id, output, rows`` of the complete batches."""
        return spark.read.schema("output string, rows long, batch_id long").option(
            "basePath", self._path).json(self._path)

    def read(self, spark: SparkSession, output: str) -> DataFrame:
        """The rows of ``output`` (Parquet, a folder a batch) of complete batches."""
        path = os.path.join(self.root, output)
        done = self.committed(spark).select("batch_id").distinct()
        # A few batches hold all rows, so these stay where they are read.
        return spark.read.option("basePath", path).parquet(path).join(F.broadcast(done), "batch_id", "left_semi")

