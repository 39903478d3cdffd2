"""Exact random samples and splits that do not depend on partitioning.

Rows are ordered by ``md5(seed:id), id``. Every operator here takes the first rows of that order,
overall or per group. The cut is found as one threshold per group: count the hash prefixes, find
the prefix the quota falls into, refine it until few rows have it, and rank only these. So no group is sorted as a
whole, whatever share of the rows it holds, and no text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.operators.joins import bounded, lookup_join, null_safe_join
from reviewlens.session import stored

PREFIX_DIGITS = 3
#: A bucket of at most this many rows is ranked by one task.
BUCKET_ROWS = 10_000
HASH_DIGITS = 32


def order_hash(seed: int | str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def mark_first(
    df: DataFrame,
    id_col: str,
    groups: Sequence[str],
    quota: DataFrame | int,
    seed: int | str,
    flag: str,
    digits: int = PREFIX_DIGITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add a boolean column: is the row among the first ``quota`` rows of its group.

    ``quota`` is a number or a table of ``groups`` and ``take``. Prefixes grow by ``digits`` until the bucket of
    every group that holds the cut has at most ``bucket_rows`` rows. Where rows repeat the id at the cut, as many of them as
    the quota leaves are taken, in the order of their content; only these are looked at again.
    """
    groups = list(groups)
    ranked = df.select(id_col, *groups, order_hash(seed, F.col(id_col)).alias("_h"))
    near, cut, length = ranked, None, 0
    while True:
        length = min(length + digits, HASH_DIGITS)
        prefix = F.substring("_h", 1, length)
        histogram = near.groupBy(*groups, prefix.alias("_p")).agg(F.count("*").alias("_n"))
        within = Window.partitionBy(*(groups or [F.lit(0)]))
        histogram = histogram.withColumn("_upto", F.sum("_n").over(within.orderBy("_p")))
        if cut is not None:
            histogram = null_safe_join(histogram, _small(cut.select(*groups, F.col("_need").alias("take"))), groups, "inner")
        elif isinstance(quota, int):
            total = F.sum("_n").over(within)
            histogram = histogram.withColumn("take", F.least(F.lit(quota).cast("long"), total))
        else:
            histogram = null_safe_join(histogram, _small(quota), groups, "inner")
        holds = (F.col("_upto") >= F.col("take")) & (F.col("_upto") - F.col("_n") < F.col("take"))
        need = (F.col("take") - F.col("_upto") + F.col("_n")).alias("_need")
        cut = stored(histogram.where(holds).select(*groups, "_p", need, "_n"), "cut")
        near = null_safe_join(near.withColumn("_p", prefix), _small(cut.drop("_need", "_n")), [*groups, "_p"], "inner").drop("_p")
        if length == HASH_DIGITS or not (cut.agg(F.max("_n")).first()[0] or 0) > bucket_rows:
            break

    # One row per id, however often it occurs.
    in_bucket = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_h", id_col)
    ids = near.groupBy(*groups, "_h", id_col).agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(in_bucket))
    at_cut = (F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need"))
    limits = (
        null_safe_join(ids, _small(cut.select(*groups, "_need")), groups, "inner")
        .where(at_cut)
        .select(
            *groups,
            F.struct(F.col("_h"), F.col(id_col).alias("_id")).alias("_limit"),
            (F.col("_need") - F.col("_upto") + F.col("_n")).alias("take"),
            (F.col("_upto") - F.col("_need")).alias("_over"),
        )
    )
    limits = stored(limits, "limits")
    torn = limits.where("_over > 0").limit(1).count() > 0
    own = F.struct(order_hash(seed, F.col(id_col)).alias("_h"), F.col(id_col).alias("_id"))
    if groups:
        df, limit = lookup_join(df, limits.drop("take", "_over"), groups, [id_col]), F.col("_limit")
    else:
        found = limits.first()
        limit = F.lit(None)
        if found:
            last = F.lit(found["_limit"]["_id"]).cast(df.schema[id_col].dataType)
            limit = F.struct(F.lit(found["_limit"]["_h"]).alias("_h"), last.alias("_id"))
    if not torn:
        return df.withColumn(flag, F.coalesce(own <= limit, F.lit(False))).drop("_limit")
    here = F.coalesce(own == limit, F.lit(False))
    others = df.where(~here).withColumn(flag, F.coalesce(own < limit, F.lit(False))).drop("_limit")
    return others.unionByName(_mark_copies(df.where(here).drop("_limit"), groups, limits, seed, flag))


def _mark_copies(rows: DataFrame, groups: list[str], limits: DataFrame, seed: int | str, flag: str) -> DataFrame:
    """Mark the first ``take`` rows of each group, whose rows share an id, by their content.

    Rows of equal content can only be told apart by their place in a stored copy, which is then as good as any.
    """
    if "_content" in rows.columns:
        key, added = "_place", F.monotonically_increasing_id()
    else:
        key, added = "_content", F.md5(F.to_json(F.struct(*rows.columns)))
    held = stored(stored(rows, "copies").withColumn(key, added), "copies")
    take = limits.select(*groups, "take") if groups else int(limits.first()["take"])
    return mark_first(held, key, groups, take, seed, flag).drop(key)


def _small(table: DataFrame) -> DataFrame:
    """One row per group: broadcast if its size allows, else left to the optimizer."""
    small = bounded(table)
    return table if small is None else small


def cap_per_group(df: DataFrame, groups: Sequence[str], n: int, id_col: str, seed: int | str) -> DataFrame:
    """At most ``n`` random rows per group; smaller groups stay whole."""
    return mark_first(df, id_col, groups, n, seed, "_kept").where("_kept").drop("_kept")


def group_availability(df: DataFrame, groups: Sequence[str], n: int) -> DataFrame:
    """Rows there are and rows ``cap_per_group`` takes, per group."""
    counts = df.groupBy(*groups).agg(F.count("*").alias("available"))
    return counts.withColumn("taken", F.least(F.lit(n).cast("long"), F.col("available")))


def sample_exact(df: DataFrame, n: int, id_col: str, seed: int | str) -> DataFrame:
    """Exactly ``min(n, rows)`` random rows."""
    return cap_per_group(df, [], n, id_col, seed)


def stratified_quota(counts: DataFrame, label: str, fraction: float) -> DataFrame:
    """Test rows per class for ``counts`` of ``(label, n)``; they add up to ``ceil(fraction * rows)``.

    Each class gets the floor of its share of the train rows and the largest remainders get one
    more, ties by label; the rest of the class is test. One row per class, so one window task.
    """
    every_class = Window.partitionBy(F.lit(0))
    sized = counts.withColumn("_all", F.sum("n").over(every_class)).withColumn(
        "_train", F.col("_all") - F.ceil(F.col("_all") * F.lit(fraction))
    )
    share = F.col("n") * F.col("_train")
    floors = sized.withColumn("_floor", F.floor(share / F.col("_all"))).withColumn(
        "_left", share - F.col("_floor") * F.col("_all")
    )
    placed = floors.withColumn(
        "_place", F.row_number().over(every_class.orderBy(F.desc("_left"), label))
    ).withColumn("_open", F.col("_train") - F.sum("_floor").over(every_class))
    train = F.col("_floor") + (F.col("_place") <= F.col("_open")).cast("long")
    return placed.select(label, (F.col("n") - train).alias("take"))


def stratified_split(
    df: DataFrame, label: str, fraction: float, id_col: str, seed: int | str, flag: str = "is_test"
) -> DataFrame:
    """Mark the test rows; every class gives its exact share."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return mark_first(df, id_col, [label], stratified_quota(counts, label, fraction), seed, flag)


def random_split(df: DataFrame, fraction: float, id_col: str, seed: int | str, flag: str = "is_test") -> DataFrame:
    """Mark exactly ``ceil(fraction * rows)`` test rows."""
    return mark_first(df, id_col, [], math.ceil(df.count() * fraction), seed, flag)


def shuffle_rows(df: DataFrame, id_col: str, seed: int | str) -> DataFrame:
    """Random but repeatable output order."""
    return df.orderBy(order_hash(seed, F.col(id_col)), id_col)


def shuffled_positions(
    df: DataFrame, id_col: str, seed: int | str, out: str = "position", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``df`` with the place of each row, from 1, in the order of ``shuffle_rows``; ids must be unique.

    Rows are placed inside a bucket of the hash, about ``bucket_rows`` in each whatever their number, and the counts of the
    buckets before it are added. One window task sees a row per bucket, none sees all rows.
    """
    digits = max(math.ceil(math.log(max(df.count() / bucket_rows, 1), 16)), 1)
    hashed = df.withColumn("_h", order_hash(seed, F.col(id_col))).withColumn("_bucket", F.substring("_h", 1, digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    offsets = stored(counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "offsets")
    own = F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", id_col))
    placed = null_safe_join(hashed.withColumn("_own", own), _small(offsets), ["_bucket"], "inner")
    return placed.withColumn(out, F.col("_own") + F.col("_before")).drop("_h", "_bucket", "_own", "_before")


def pick_index(seed: int | str, key: Column, n: int | Column) -> Column:
    """Repeatable independent choice of ``0 .. n-1`` per row."""
    number = F.conv(F.substring(order_hash(seed, key), 1, 8), 16, 10).cast("long")
    return F.pmod(number, n if isinstance(n, Column) else F.lit(n).cast("long"))


def random_choice(seed: int | str, key: Column, values: Sequence[str]) -> Column:
    """Repeatable independent choice from a list per row."""
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, pick_index(seed, key, len(values)).cast("int"))
