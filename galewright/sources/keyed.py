"""Keyed tables in buckets: a merge rewrites the buckets that its source's keys fall into, and no others.

Layout below the table folder: ``rows/_bucket=K/`` holds the rows whose key hash falls into bucket K;
``changes/commit=NAME/`` holds what a merge read and wrote, by kind. A merge is one pass over the touched
buckets, which emits unchanged rows, pre-images, post-images and inserts together. Spark's dynamic
partition overwrite then replaces just those buckets from that folder. One job at a time writes a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galewright.operators.joins import require_keyed, require_unique
from galewright.session import materialize, path_exists
from galewright.sources.sinks import SchemaMismatch, schema_differences

BUCKET = "_bucket"
KIND = "change_type"
KEPT, BEFORE, AFTER, NEW = "kept", "update_preimage", "update_postimage", "insert"


@dataclass(frozen=True)
class BucketedTable:
    """A table below ``path`` with unique, non-NULL ``keys``, in ``buckets`` folders of about equal size.

    Choose as many buckets as give files of a few hundred megabytes: a bucket is the least that a merge
    rewrites. Keys and number of buckets belong to the table and must be the same each time.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def create(self, df: DataFrame) -> None:
        """The first rows. A repeated or NULL key fails the job."""
        rows = require_unique(require_keyed(df, self.keys), self.keys, self.path).withColumn(BUCKET, self._bucket())
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def merge(self, source: DataFrame, commit: str) -> list[int]:
        """Update matched rows, insert the others; the buckets that were rewritten.

        A source with some of the columns updates only those; columns it lacks are NULL in inserted rows.
        The source is computed once. ``commit`` names the merge: given again, it writes the buckets from
        the first run's rows, so a merge that failed half-way is simply repeated.
        """
        folder = f"{self.path}/changes/commit={commit}"
        if not path_exists(self.spark, f"{folder}/_SUCCESS"):
            passed = self._passed(self._incoming(source))
            passed.repartition(BUCKET).write.mode("overwrite").partitionBy(KIND).parquet(folder)
        passed = self._written(commit)
        after = passed.filter(F.col(KIND) != BEFORE).drop(KIND)
        touched = sorted(r[0] for r in passed.select(BUCKET).distinct().collect())  # at most one number a bucket
        if touched:
            writer = after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(BUCKET).parquet(f"{self.path}/rows")
        return touched

    def changes(self, commit: str) -> DataFrame:
        """The rows that a merge inserted or changed, before and after, with ``change_type``; no comparison of versions."""
        return self._written(commit).filter(F.col(KIND) != KEPT).drop(BUCKET)

    def _written(self, commit: str) -> DataFrame:
        schema = self._stored().schema.add(KIND, "string")  # an empty merge wrote no file to tell it
        return self.spark.read.schema(schema).parquet(f"{self.path}/changes/commit={commit}")

    def _incoming(self, source: DataFrame) -> DataFrame:
        stored = self.rows().schema
        extra = [c for c in source.columns if c not in stored.names]
        if extra:
            raise ValueError(f"source columns {extra} are not in the target")
        missing = [k for k in self.keys if k not in source.columns]
        if missing:
            raise ValueError(f"source lacks the key {missing}")
        expected = [stored[c] for c in source.columns]
        if problems := schema_differences(type(stored)(expected), source.schema):
            raise SchemaMismatch("; ".join(problems))
        written = materialize(source.withColumn(BUCKET, self._bucket()), "merge-source")
        return require_unique(require_keyed(written, self.keys), self.keys)

    def _passed(self, incoming: DataFrame) -> DataFrame:
        """Every row of the touched buckets with its kind: what stays, and both images of what changes."""
        touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
        stored = self._stored().filter(F.col(BUCKET).isin(touched))
        columns = [c for c in stored.columns if c != BUCKET]
        values = [c for c in columns if c not in self.keys]
        updated = [c for c in incoming.columns if c in values]
        held = stored.select(BUCKET, *self.keys, F.struct(F.lit(True).alias("_there"), *values).alias("_old"))
        given = incoming.select(BUCKET, *self.keys, F.struct(F.lit(True).alias("_there"), *updated).alias("_given"))
        both = held.join(given, [BUCKET, *self.keys], "full_outer")
        is_held, is_given = F.col("_old._there").isNotNull(), F.col("_given._there").isNotNull()
        old = F.struct(*[F.col("_old").getField(c).alias(c) for c in values])
        new = F.struct(*[
            (F.when(is_given, F.col("_given").getField(c)).otherwise(F.col("_old").getField(c)) if c in updated else F.col("_old").getField(c)).alias(c)
            for c in values
        ])

        def row(kind: str, image: Column) -> Column:
            return F.struct(F.lit(kind).alias(KIND), image.alias("_row"))

        same = ~is_given | (is_held & old.eqNullSafe(new))
        rows = F.when(same, F.array(row(KEPT, old))).when(~is_held, F.array(row(NEW, new))).otherwise(F.array(row(BEFORE, old), row(AFTER, new)))
        found = both.select(BUCKET, *self.keys, F.inline(rows))
        return found.select(BUCKET, KIND, *[F.col(c) if c in self.keys else F.col("_row").getField(c).alias(c) for c in columns])
