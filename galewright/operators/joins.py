"""Keyed joins and merges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galewright.session import materialize


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> DataFrame:
    """The same rows, failing at run time when a key occurs twice.

    Only the keys are shuffled for the check, and copies of a hot key collapse before that. The
    outcome, the smallest repeated key or NULL, is a scalar subquery that runs before the main pass.
    """
    key = F.to_json(F.struct(*keys))
    copies = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = copies.filter(F.col("_copies") > 1).agg(F.min(key).alias("k")).scalar()
    message = F.concat(F.lit(f"duplicate key in {what}: "), repeated)
    return df.filter(F.when(repeated.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE: update matched rows, insert the others.

    A source with all columns replaces whole rows: target rows without a source row, plus the source.
    The source is written once: its key check, the anti join and the inserted rows all read that. The anti
    join ships only source keys, so a small source never shuffles the target. A source with a subset of the columns updates just those, by one full outer join; columns it lacks are NULL in
    inserted rows.
    """
    keys = list(keys)
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns {extra} are not in the target")
    source = materialize(source, "merge-source")
    checked = require_unique(source, keys)
    if set(source.columns) == set(target.columns):
        kept = target.join(source.select(*keys), keys, "left_anti")
        return kept.unionByName(checked.select(*target.columns))
    updates = [c for c in source.columns if c not in keys]
    incoming = checked.select(
        *keys, F.struct(*updates).alias("_incoming") if updates else F.lit(None).alias("_incoming"), F.lit(True).alias("_hit")
    )
    return target.join(incoming, keys, "full_outer").select(
        *[
            F.when(F.col("_hit"), F.col("_incoming").getField(c)).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
            for c in target.columns
        ]
    )


def anti_unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows without a target row.

    The target is first cut to the keys the source has, which needs no target shuffle while the
    source is small enough for Spark to broadcast.
    """
    keys = list(keys)
    present = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    return source.join(present, keys, "left_anti")


def backfill(target: DataFrame, late: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """MERGE, matched only: a late non-NULL value replaces the stored one. Never adds or drops rows."""
    keys = list(keys)
    arrived = require_unique(late.select(*keys, *columns), keys, "late values").select(
        *keys, *[F.col(c).alias(f"_late_{c}") for c in columns]
    )
    joined = target.join(arrived, keys, "left")
    return joined.select(
        *[F.coalesce(F.col(f"_late_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    )


def feature_lookup(
    labels: DataFrame,
    features: DataFrame,
    key: str,
    names: Sequence[str],
    exclude: Sequence[str] = (),
    hot_share: float | None = None,
) -> DataFrame:
    """Training rows: every label row with the features of its key, NULL where the key has none.

    The feature frame must be unique on ``key``; a repeated key fails the job. ``hot_share`` names the share of label rows from which a
    key counts as hot: label rows of hot keys, and those without a key, are then never shuffled but
    meet a broadcast of at most ``1 / hot_share`` feature rows. Without it, Spark broadcasts the
    features when they are small and else splits skewed partitions at run time.
    """
    wanted = require_unique(features.select(key, *names), [key], "features")
    joined = labels.join(wanted, key, "left") if hot_share is None else _lookup_hot_apart(labels, wanted, key, hot_share)
    return joined.drop(*exclude)


@dataclass(frozen=True)
class Lookup:
    """Features to add to a training set: a frame unique on ``key`` and the names to take from it."""

    features: DataFrame
    key: str
    names: Sequence[str]


def training_set(
    labels: DataFrame, lookups: Sequence[Lookup], exclude: Sequence[str] = (), hot_share: float | None = None
) -> DataFrame:
    """The label frame with the features of every lookup, without the excluded columns.

    Keys that are excluded from the result still serve all lookups.
    """
    rows = labels
    for lookup in lookups:
        rows = feature_lookup(rows, lookup.features, lookup.key, lookup.names, hot_share=hot_share)
    return rows.drop(*exclude)


def hot_values(df: DataFrame, key: str, share: float) -> list:
    """Every value that fills at least ``share`` of the rows, and maybe a few smaller ones.

    One pass with a fixed-size sketch per task, no shuffle; at most ``1 / share`` values come back.
    Callers stay exact whichever values are listed, the list only decides where work is split.
    """
    found = df.select(key).freqItems([key], share).first()[0]
    return [v for v in (found or []) if v is not None]


def _lookup_hot_apart(labels: DataFrame, features: DataFrame, key: str, share: float) -> DataFrame:
    hot = hot_values(labels, key, share)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    unknown = F.col(key).isNull()
    hot_features = features.filter(is_hot)  # at most 1 / share rows
    apart = labels.filter(unknown | is_hot).join(F.broadcast(hot_features), key, "left")
    rest = labels.filter(~unknown & ~is_hot).join(features, key, "left")
    return apart.unionByName(rest)


def require_keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing at run time when a key column is NULL."""
    missing = F.lit(False)
    for k in keys:
        missing |= F.col(k).isNull()
    message = F.lit(f"NULL in the key {', '.join(keys)}")
    return df.filter(F.when(~missing, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level changes between two versions of a keyed table that kept no changes of its own.

    Emits ``insert``, ``delete``, ``update_preimage`` and ``update_postimage`` rows. Both versions meet as keys
    and a digest of the row, so unchanged rows are never shuffled whole; the rows of changed keys are then
    fetched from either side. A NULL in the key fails the job, as such rows can't be told apart.
    """
    keys = list(keys)
    before, after = (require_keyed(df, keys) for df in (before, after))
    columns = before.columns
    if set(columns) != set(after.columns):
        raise ValueError("both versions need the same columns")
    values = [c for c in columns if c not in keys]
    old, new = (
        df.select(*keys, F.md5(F.to_json(F.struct(F.lit(0), *values), {"ignoreNullFields": "false"})).alias(name))
        for df, name in ((before, "_old"), (after, "_new"))
    )
    changed = old.join(new, keys, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    changed = materialize(changed, "changed-keys")
    was, now = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    gone = before.join(changed.filter(was), keys).withColumn("change_type", F.when(now, "update_preimage").otherwise("delete"))
    come = after.join(changed.filter(now), keys).withColumn("change_type", F.when(was, "update_postimage").otherwise("insert"))
    wanted = [*columns, "change_type"]
    return gone.select(*wanted).unionByName(come.select(*wanted))
