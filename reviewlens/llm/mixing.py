"""Mixing sources to target weights by entropy balancing.

Document rates stay as close to 1 in relative entropy as the token targets of their sources allow, with
no rate above a cap. The solution tilts exponentially: ``rate = min(cap, exp(lambda * size))`` with one
multiplier per source, found by Newton steps on the convex dual over counts per source and size. Rates
are then rounded into copies so that each source meets its target. Everything is SQL functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.llm.common import WORD, text_or_empty
from reviewlens.operators.joins import salted_lookup
from reviewlens.session import stored

WEIGHTS, SHARE, CAP = (3.0, 1.0, 2.0), 1.5, 2.0
TOLERANCE, MAX_STEPS = 1e-7, 200
BUCKET_ROWS = 10_000
MICRO = 1_000_000


def source_key(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Add ``target`` to ``(_key, source, source_size)``: shares by weight, none above ``cap`` times its size.

    Sources take the weights in turn, by code point, null last. What a capped source cannot take goes to
    the others by weight: with sources ordered by size per weight, the capped ones come first. One row
    per source passes one window task.
    """
    all_sources = Window.partitionBy(F.lit(0))
    place = F.row_number().over(all_sources.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    rows = sources.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    budget = F.sum("source_size").over(all_sources) * F.lit(float(share))
    before = all_sources.orderBy(F.col("_cap") / F.col("_w"), "_key").rowsBetween(Window.unboundedPreceding, -1)
    onward = all_sources.orderBy(F.col("_cap") / F.col("_w"), "_key").rowsBetween(0, Window.unboundedFollowing)
    level = (budget - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward)
    rows = rows.withColumn("_full", F.col("_cap") <= level * F.col("_w")).withColumn("_budget", budget)
    taken = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(all_sources), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(all_sources)
    target = F.when(F.col("_full"), F.col("_cap")).otherwise((F.col("_budget") - taken) * F.col("_w") / open_weight)
    return rows.withColumn("target", target).drop("_w", "_cap", "_full", "_budget")


def tilt(size: Column, multiplier: Column, scale: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(multiplier * size / scale))


def solve(sizes: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """``sources`` with the ``multiplier`` of each, from ``sizes`` ``(_key, size, n)`` and their ``target``.

    Newton steps for all sources at once; a step that leaves the interval known to hold the root halves
    it instead. Each step is one aggregation over the counts and is written to the shared folder. A
    source at its cap has no finite multiplier and gets null: all its rates are the cap.
    """
    spans = sizes.where("size > 0").groupBy("_key").agg(F.min("size").alias("_small"), F.max("size").alias("scale"))
    open_source = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * cap * (1 - 1e-12))
    state = sources.join(spans, "_key", "left").select(
        "_key", "source_size", "target", "scale", F.when(open_source, F.lit(0.0)).alias("multiplier"),
        F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))).alias("_low"), F.lit(float(cap)).alias("_high"), "_small",
    )
    unit = F.col("scale") / F.col("_small")
    state = stored(state.withColumn("_low", F.col("_low") * unit).withColumn("_high", F.log(F.col("_high")) * unit), "dual")
    for _ in range(MAX_STEPS):
        rate = tilt(F.col("size"), F.col("multiplier"), F.col("scale"), cap)
        tokens = F.col("n") * F.col("size") * rate
        slope = F.when(rate < cap, tokens * F.col("size") / F.col("scale")).otherwise(F.lit(0.0))
        sums = (
            sizes.join(state, "_key")
            .where("multiplier is not null")
            .groupBy("_key")
            .agg(F.sum(tokens).alias("_tokens"), F.sum(slope).alias("_slope"))
        )
        off = F.col("_tokens") - F.col("target")
        low = F.when(off < 0, F.col("multiplier")).otherwise(F.col("_low"))
        high = F.when(off > 0, F.col("multiplier")).otherwise(F.col("_high"))
        newton = F.col("multiplier") - off / F.nullif(F.col("_slope"), F.lit(0.0))
        inside = newton.isNotNull() & (newton > F.col("_low")) & (newton < F.col("_high"))
        step = F.when(inside, newton).otherwise((F.col("_low") + F.col("_high")) / 2)
        done = F.abs(off) <= F.col("target") * TOLERANCE
        moved = (
            state.join(sums, "_key", "left")
            .withColumns({"_low": low, "_high": high, "_done": F.coalesce(done, F.lit(True))})
            .withColumn("multiplier", F.when(F.col("_done"), F.col("multiplier")).otherwise(step))
        )
        moved = stored(moved.drop("_tokens", "_slope"), "dual")
        state = moved.drop("_done")
        if moved.where("not _done").isEmpty():
            break
    return state.select("_key", "source_size", "target", "multiplier", "scale")


def _settle(rows: DataFrame, many: bool, wide: bool, cap: float) -> DataFrame:
    """Round documents of a bucket the other way to bring it nearer to its tokens.

    With ``many``, the largest that fit into what is off, as long as their sum fits; else the one whose size
    comes nearest to what is off, if that helps. Copies stay next to their rates; ``wide`` lets this one document
    go anywhere from 0 to ``cap``, for sources of a few documents.
    """
    bucket = Window.partitionBy("_key", "_bucket")
    off = F.sum(F.col("_copies") * F.col("size") * MICRO - F.col("_micro") * F.col("size")).over(bucket) / MICRO
    rows = rows.withColumn("_off", off)
    floor = F.floor(F.col("_micro") / MICRO)
    free = F.when(F.col("_off") > 0, F.col("_copies") > floor).otherwise(
        (F.col("_copies") == floor) & (F.col("_micro") % MICRO > 0)
    )
    if wide:
        free = F.when(F.col("_off") > 0, F.col("_copies") > 0).otherwise(F.col("_copies") + 1 <= cap)
    miss = F.abs("_off")
    free = free & (F.col("size") > 0) & (F.col("size") <= miss if many else F.col("size") < 2 * miss)
    if many:
        rows = rows.withColumn("_step", F.when(free, F.col("size")).otherwise(F.lit(0)))
        place = bucket.orderBy(F.desc("_step"), "_order", "doc_id")
        chosen = (F.col("_step") > 0) & (F.sum("_step").over(place.rowsBetween(Window.unboundedPreceding, 0)) <= miss)
    else:
        rows = rows.withColumn("_step", F.when(free, F.abs(F.col("size") - miss)))
        place = bucket.orderBy(F.asc_nulls_last("_step"), "_order", "doc_id")
        chosen = F.col("_step").isNotNull() & (F.row_number().over(place) == 1)
    change = F.when(chosen, -F.signum("_off")).otherwise(F.lit(0.0)).cast("long")
    return rows.withColumn("_copies", F.col("_copies") + change).drop("_off", "_step")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(doc_id, size, source_size, target, rate, copies, taken)`` for every row.

    ``size`` counts words between ASCII whitespace, 0 for null text; ``taken`` is ``copies * size``. A
    source of any size is dealt by the hash of its ids into buckets of about ``bucket_rows`` documents.
    A bucket is rounded in order of size: each document gets the whole copies that the running sum of
    rates passes, so partial sums are off by half a copy at most, and small documents then settle the
    rest. Rates are whole millionths, so sums do not depend on their order and reruns agree. Rows
    without words get rate 1. Null sources are one source; repeated rows are rows of their own; an
    empty table gives an empty result.
    """
    size = F.regexp_count(text_or_empty(F.col(text_col)), F.lit(WORD)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    rows = stored(rows.withColumn("_key", source_key(F.col("source"))), "sizes")
    sizes = stored(rows.groupBy("_key", "source", "size").agg(F.count("*").alias("n")), "size-counts")
    sources = sizes.groupBy("_key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("_docs"))
    sources = stored(targets(sources, weights, share, cap), "targets")
    solved = solve(sizes.select("_key", "size", "n"), sources.select("_key", "source_size", "target"), cap)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.coalesce(tilt(F.col("size"), F.col("multiplier"), F.col("scale"), cap), F.lit(float(cap)))
    )
    table = solved.join(sources.select("_key", "_docs"), "_key")
    known = salted_lookup(rows.drop("source"), table, "_key", "_docs")
    order = F.xxhash64("doc_id", F.lit("mix"))
    known = known.withColumns(
        {
            "_micro": F.round(rate * MICRO).cast("long"),
            "_order": order,
            "_bucket": F.pmod(F.xxhash64("doc_id", F.lit("bucket")), F.ceil(F.col("_docs") / bucket_rows)),
        }
    )
    by_size = Window.partitionBy("_key", "_bucket").orderBy(F.desc("size"), "_order", "doc_id")
    upto = F.sum("_micro").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    whole = lambda total: F.floor((total + MICRO // 2) / MICRO)
    known = known.withColumn("_copies", whole(upto) - whole(upto - F.col("_micro")))
    for many, wide in ((True, False), (True, False), (False, False), (False, True), (False, True)):
        known = _settle(known, many, wide, cap)
    return known.select(
        "doc_id", "size", "source_size", "target", (F.col("_micro") / MICRO).alias("rate"),
        F.col("_copies").alias("copies"), (F.col("_copies") * F.col("size")).alias("taken"),
    )


def mix_rows(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs`` with the ``copies`` the mix takes of each row.

    Ids say which rows are meant: rows that share an id get the largest number found for it, and rows
    without an id, which cannot be looked up, are taken once. A column ``copies`` of ``docs`` is replaced.
    """
    found = mix(docs, id_col, **settings).where("doc_id is not null")
    found = found.groupBy(F.col("doc_id").alias("_mix_id")).agg(F.max("copies").alias("_copies"))
    own = [docs[f"`{c}`"] for c in docs.columns if c != "copies"]
    joined = docs.join(found, docs[id_col] == found["_mix_id"], "left")
    return joined.select(*own, F.coalesce(found["_copies"], F.lit(1)).alias("copies"))
