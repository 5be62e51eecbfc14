"""Joins by token overlap: a set-similarity join by prefix filter, in place of a nested loop over pairs.

The score of a pair is its common tokens by the size of its smaller set. A smaller set of n tokens needs a least number c
of them in common, so one of any n - c + 1 of them is among the tokens of the other set. Tokens are ordered by the number
of sets that hold them, over both sides; the n - c + 1 rarest are the prefix, and only these look for partners. A token
that a third of all sets hold is in a prefix only if the set has hardly any other, so it seldom makes pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalis.sources.scratch import written


def least_common(n: Column, min_common: int, threshold: float) -> Column:
    """Tokens that a set of ``n`` needs in common with a set that is not smaller; at most one too few by rounding."""
    return F.greatest(F.lit(min_common), F.ceil(n * F.lit(threshold) - F.lit(1e-9)), F.lit(1)).cast("int")


def _ordered(sets: DataFrame, counts: DataFrame) -> DataFrame:
    """``(id, n, tokens)`` with the tokens of each set from the rarest to the most frequent."""
    each = sets.select("id", F.explode("tokens").alias("token"))
    rows = each.join(counts, "token").groupBy("id").agg(F.array_sort(F.collect_set(F.struct("sets", "token"))).alias("o"))
    return rows.select("id", F.size("o").alias("n"), F.transform("o", lambda x: x["token"]).alias("tokens"))


def ordered_sets(left: DataFrame, right: DataFrame, left_key: str, right_key: str, tokens: str) -> tuple[DataFrame, DataFrame]:
    """Both sides by :func:`_ordered`, over the frequencies of both together.

    The sets are written before, as making tokens of texts costs more than reading them, and after, as several steps
    read them.
    """
    sides = []
    for df, key, name in ((left, left_key, "left"), (right, right_key, "right")):
        own = df.select(F.col(key).alias("id"), F.array_distinct(tokens).alias("tokens")).filter("id is not null")
        sides.append(written(own, f"{name}-tokens"))
    every = [x.select(F.explode("tokens").alias("token")) for x in sides]
    counts = written(every[0].unionByName(every[1]).groupBy("token").agg(F.count("*").alias("sets")), "token-counts")
    return written(_ordered(sides[0], counts), "left-sets"), written(_ordered(sides[1], counts), "right-sets")


def candidate_pairs(left: DataFrame, right: DataFrame, min_common: int, threshold: float) -> DataFrame:
    """Distinct ``(left_id, right_id)`` of ordered sets that may have enough in common; no pair that has is left out.

    The smaller set of a pair sends its prefix, the other one all of its tokens. A meeting counts only if the tokens
    from there on, on either side, are enough for the least number in common (positional filter): the first common
    token of a true pair always passes.
    """
    need = least_common(F.col("n"), min_common, threshold)
    meetings = []
    for small, large, names in ((left, right, ("left_id", "right_id")), (right, left, ("right_id", "left_id"))):
        own = small.withColumn("c", need).filter("c <= n").select("id", "n", "c", F.posexplode(F.slice("tokens", F.lit(1), F.col("n") - F.col("c") + 1)).alias("pos", "token"))
        other = large.select(F.col("id").alias("id_"), F.col("n").alias("n_"), F.posexplode("tokens").alias("pos_", "token"))
        larger = F.col("n_") >= F.col("n") if small is left else F.col("n_") > F.col("n")
        enough = F.least(F.col("n") - F.col("pos"), F.col("n_") - F.col("pos_")) >= F.col("c")
        met = own.join(other, "token").filter(larger & enough)
        meetings.append(met.select(F.col("id").alias(names[0]), F.col("id_").alias(names[1])).select("left_id", "right_id"))
    return meetings[0].unionByName(meetings[1]).distinct()


def token_overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str, tokens: str, min_common: int, threshold: float) -> DataFrame:
    """``(left_id, right_id, common, score)`` of pairs with enough common tokens and a score at the threshold or above.

    Keys are unique on their side; a null key takes no part. ``threshold`` is positive, so pairs without a common token
    are no pairs. Candidates by prefix and position are verified on the whole sets.
    """
    a, b = ordered_sets(left, right, left_key, right_key, tokens)
    pairs = candidate_pairs(a, b, min_common, threshold)
    pairs = pairs.join(a.select(F.col("id").alias("left_id"), F.col("tokens").alias("left_tokens")), "left_id")
    pairs = pairs.join(b.select(F.col("id").alias("right_id"), F.col("tokens").alias("right_tokens")), "right_id")
    common = F.size(F.array_intersect("left_tokens", "right_tokens")).cast("bigint")
    small = F.least(F.size("left_tokens"), F.size("right_tokens"))
    found = pairs.select("left_id", "right_id", common.alias("common"), small.alias("small")).withColumn("score", F.col("common") / F.col("small"))
    return found.filter((F.col("common") >= min_common) & (F.col("score") >= threshold)).drop("small")


def best_match(pairs: DataFrame) -> DataFrame:
    """One row per left id: the highest score, the least right id among equals."""
    w = Window.partitionBy("left_id").orderBy(F.desc("score"), "right_id")
    return pairs.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def all_matches(pairs: DataFrame) -> DataFrame:
    """One row per left id with all right ids, ascending, and the highest score."""
    return pairs.groupBy("left_id").agg(F.array_sort(F.collect_set("right_id")).alias("right_ids"), F.max("score").alias("score"))


def filter_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str, residual: Column) -> DataFrame:
    """Pairs for which a condition over the columns of both rows holds."""
    out = pairs.join(left.withColumnRenamed(left_key, "left_id"), "left_id").join(right.withColumnRenamed(right_key, "right_id"), "right_id")
    return out.filter(residual).select(*pairs.columns)
