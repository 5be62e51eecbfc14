"""Keyed tables: volatile-aware upsert, replace with change counts, first and last by a declared order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns that do not make a row different.
VOLATILE = ("retrieved_at", "last_seen")


def keep_last(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """One row per key, the last by ``order``; rows without a key are dropped."""
    return _keep(df, key, [F.col(o).desc_nulls_last() if isinstance(o, str) else o.desc_nulls_last() for o in order])


def keep_first(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """One row per key, the first by ``order``; rows without a key are dropped."""
    return _keep(df, key, [F.col(o) if isinstance(o, str) else o for o in order])


def _keep(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def semantic_hash(columns: list[str], volatile: tuple[str, ...] = VOLATILE) -> Column:
    """Digest of the columns that count, by name."""
    own = sorted(c for c in columns if c not in volatile)
    return F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256)


def _both(old: DataFrame, new: DataFrame, key: str, volatile: tuple[str, ...]) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias("__key"), semantic_hash(df.columns, volatile).alias(f"{name}_hash"), F.struct(*df.columns).alias(name))

    usable = lambda df: df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    joined = side(usable(old), "old").join(side(usable(new), "new"), "__key", "full_outer")
    change = (
        F.when(F.col("old").isNull(), "inserted")
        .when(F.col("new").isNull(), "absent")
        .when(F.col("old_hash") != F.col("new_hash"), "updated")
        .otherwise("unchanged")
    )
    return joined.withColumn("change", change)


def upsert(old: DataFrame, new: DataFrame, key: str, volatile: tuple[str, ...] = VOLATILE, advance_last_seen: bool = False) -> DataFrame:
    """The merged table with ``change`` (inserted, updated, unchanged, absent): a full outer join on the key.

    A new row that differs in volatile columns only leaves the old row as it is, unless ``advance_last_seen``; nothing
    is deleted. ``new`` has one row per key (:func:`keep_last`). Writing the result twice changes nothing.
    """
    both = _both(old, new, key, volatile)
    if advance_last_seen and "last_seen" in old.columns:
        kept = F.col("old").withField("last_seen", F.greatest(F.col("old.last_seen"), F.col("new.last_seen")))
    else:
        kept = F.col("old")
    row = F.when(F.col("change").isin("inserted", "updated"), F.col("new")).otherwise(kept)
    return both.select("change", row.alias("row")).select("change", "row.*")


def replace(old: DataFrame, new: DataFrame, key: str, volatile: tuple[str, ...] = VOLATILE) -> DataFrame:
    """``(key, change)`` with change in inserted, updated, unchanged, deleted: what writing ``new`` over ``old`` does."""
    both = _both(old, new, key, volatile)
    return both.select(F.col("__key").alias(key), F.when(F.col("change") == "absent", "deleted").otherwise(F.col("change")).alias("change"))


def change_counts(changes: DataFrame) -> DataFrame:
    kinds = ("inserted", "updated", "deleted")
    return changes.agg(*[F.count_if(F.col("change") == k).alias(k) for k in kinds])
