"""Tables kept as immutable, numbered snapshots on parquet.

Layout below the table folder: ``data/snapshot_version=N/`` holds version N, ``log/`` one tiny row
per committed version. A version counts only once its log row exists, so a failed write is never
visible and is replaced by the next one. Reading a version touches only its folder. One job at a
time writes a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from galewright.operators.joins import merge_upsert, require_unique
from galewright.sources.sinks import require_schema

VERSION = "snapshot_version"
_LOG_SCHEMA = (
    f"{VERSION} INT, operation STRING, source_batch STRING, folder STRING, committed_at TIMESTAMP, "
    "primary_keys ARRAY<STRING>, description STRING, row_count BIGINT"
)


@dataclass(frozen=True)
class SnapshotTable:
    """A versioned table below ``path``."""

    spark: SparkSession
    path: str

    def log(self) -> DataFrame:
        """Committed versions; no rows before the first commit."""
        try:
            return self.spark.read.schema(_LOG_SCHEMA).json(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG_SCHEMA)

    def latest(self) -> int | None:
        last = self._last()
        return None if last is None else last[VERSION]

    def exists(self) -> bool:
        return self.latest() is not None

    def as_of(self, version: int | None = None) -> DataFrame:
        """The rows of one version, the newest by default, with the schema of that version."""
        log = self.log()
        wanted = log if version is None else log.filter(F.col(VERSION) == version)
        folder = wanted.agg(F.max_by("folder", VERSION)).first()[0]
        if folder is None:
            raise ValueError(f"no version {version} at {self.path}")
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def all_versions(self) -> DataFrame:
        """Every committed version with its number as the partition column."""
        folders = [r[0] for r in self.log().select("folder").collect()]
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.option("basePath", f"{self.path}/data").option("mergeSchema", True).parquet(*paths)

    def create(self, df: DataFrame, keys: Sequence[str], description: str = "", batch: str = "") -> int:
        """Version 0 of a keyed table: its rows, primary keys and description."""
        if self.exists():
            raise ValueError(f"{self.path} exists already")
        return self._commit(require_unique(df, keys, self.path), 0, "create", batch, list(keys), description)

    def overwrite(self, df: DataFrame, operation: str = "overwrite", keep_schema: bool = False, batch: str = "") -> int:
        """Commit ``df`` as the next version. ``keep_schema`` refuses a changed schema."""
        last = self._last()
        if last is None:
            return self._commit(df, 0, operation, batch, [], "")
        if keep_schema:
            require_schema(self.as_of(last[VERSION]).schema, df)
        return self._commit(df, last[VERSION] + 1, operation, batch, last["primary_keys"] or [], last["description"] or "")

    def _commit(self, df: DataFrame, version: int, operation: str, batch: str, keys: list[str], description: str) -> int:
        folder = f"data/{VERSION}={version}"
        df.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        entry = self.spark.range(1).select(
            F.lit(version).alias(VERSION),
            F.lit(operation).alias("operation"),
            F.lit(batch).alias("source_batch"),
            F.lit(folder).alias("folder"),
            F.current_timestamp().alias("committed_at"),
            F.array(*[F.lit(k) for k in keys]).cast("array<string>").alias("primary_keys"),
            F.lit(description).alias("description"),
            F.lit(self.spark.read.parquet(f"{self.path}/{folder}").count()).cast("bigint").alias("row_count"),  # from the footers
        )
        entry.write.mode("append").json(f"{self.path}/log")
        return version

    def _last(self) -> Row | None:
        newest = F.max_by(F.struct(VERSION, "folder", "primary_keys", "description"), VERSION)
        return self.log().agg(newest.alias("v")).first()["v"]

    def has_batch(self, batch: str) -> bool:
        """Whether a streaming micro-batch was committed already (batches may be delivered twice)."""
        return not self.log().filter(F.col("source_batch") == batch).isEmpty()

    def upsert(self, source: DataFrame, keys: Sequence[str], batch: str = "", operation: str = "merge") -> int:
        """Keyed merge-write. Creates the table from ``source`` when it does not exist yet.

        A table that was created with primary keys is merged on exactly these. The new version has
        the table's schema; a source with some of its columns updates only those.
        """
        last = self._last()
        if last is None:
            return self.create(source, keys, batch=batch)
        if last["primary_keys"] and sorted(last["primary_keys"]) != sorted(keys):
            raise ValueError(f"{self.path} is keyed by {last['primary_keys']}, not by {list(keys)}")
        merged = merge_upsert(self.as_of(last[VERSION]), source, keys)
        return self.overwrite(merged, operation, keep_schema=True, batch=batch)

    def detail(self) -> DataFrame:
        """One row: newest version, its time, primary keys and description."""
        newest = F.max_by(F.struct(VERSION, "committed_at", "primary_keys", "description"), VERSION)
        return self.log().agg(newest.alias("v")).select("v.*")

    def history(self) -> DataFrame:
        """(snapshot_version, operation, row_count) of every committed version, from the log alone."""
        return self.log().select(VERSION, "operation", "row_count")
