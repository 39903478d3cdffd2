"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions.arrays import let
from reviewlens.session import discard, stored

# The function on Arrow batches travels to the workers by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_ROWS, BROADCAST_BYTES = 10_000, 8 << 20
#: Keys with more than this share of the rows are split; there are at most as many such keys.
HOT_KEYS = 1000


def bounded(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``table`` marked for broadcast if it has at most ``max_rows`` rows and ``max_bytes`` as JSON text, else None."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns])))
    found = table.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    return F.broadcast(table) if found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes else None


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys``, null keys equal; the columns of ``left`` keep their names."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[f"`{key}`"].eqNullSafe(renamed[f"`_r_{key}`"])
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Join ``rows`` to ``table``; null keys match null keys.

    A table of checked size is broadcast. A larger one is shuffled: the keys of ``rows`` are counted, and one
    with over ``1 / hot_keys`` of the rows is dealt to as many tasks as it has such shares, by the
    hash of ``spread_by``. Only the table rows of these keys are repeated, once per share.
    """
    keys = list(keys)
    small = bounded(table, max_rows, max_bytes)
    if small is not None:
        return null_safe_join(rows, small, keys, how)
    # Rows can be costly to make, so they are counted once.
    counts = stored(rows.groupBy(*keys).agg(F.count("*").alias("_n")), "counts")
    share = F.lit(max((counts.agg(F.sum("_n")).first()[0] or 0) // hot_keys, 1))
    # At most hot_keys rows, whatever the data; written, since both sides must see the same.
    hot = stored(counts.where(F.col("_n") > share).select(*keys, F.ceil(F.col("_n") / share).alias("_parts")), "hot-keys")
    discard(counts)
    parts = F.coalesce("_parts", F.lit(1))
    left = null_safe_join(rows, F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), parts)).drop("_parts")
    right = null_safe_join(table, F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    ).drop("_parts")
    return null_safe_join(left, right, [*keys, "_salt"], how).drop("_salt")


def salted_lookup(rows: DataFrame, table: DataFrame, key: str, size: str, salts: int = 1000) -> DataFrame:
    """Left join of ``rows`` to a ``table`` with a unique, non-null ``key``.

    ``size`` says how many of ``rows`` have the key. A key with over ``1/salts`` of the rows is split into
    parts of that share; there are at most ``salts`` such keys, so their list is broadcast whatever the data.
    """
    total = table.agg(F.sum(size)).first()[0] or 0
    share = F.lit(max(total // salts, 1))
    parts = F.ceil(F.col(size) / share)
    hot = table.where(F.col(size) > share).select(F.col(key).alias("_hot"), parts.alias("_parts"))
    spread = F.xxhash64(*[F.col(c) for c in rows.columns if c != key], F.col(key))
    left = (
        rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", F.pmod(spread, F.coalesce("_parts", F.lit(1))))
        .drop("_hot", "_parts")
    )
    copies = F.sequence(F.lit(0).cast("long"), F.greatest(parts, F.lit(1)) - 1)
    right = table.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def map_values(column: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a small dictionary, null for unknown keys."""
    entries = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.when(column.isin(*mapping), F.element_at(entries, column))


def _replacer(known: pa.Array, new: pa.Array) -> Callable[[pa.Array], pa.Array]:
    """Function on lists of words that puts ``new`` for each of the ``known`` ones; a null word is known if it is listed."""

    def replace(lists: pa.Array) -> pa.Array:
        words = lists.flatten()
        at = pc.index_in(words, value_set=known)
        changed = pc.if_else(at.is_valid(), new.take(at), words) if len(known) else words
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), changed, mask=lists.is_null())

    return replace


def replace_words(
    texts: DataFrame, id_col: str, words_col: str, dictionary: DataFrame, out: str
) -> DataFrame:
    """Replace the words of an array column by a dictionary table ``(word, replacement)``.

    A dictionary of checked size goes to the tasks, and no text is moved. Else the words meet the table with their positions,
    and only hits come back. In the row they are merged by position, in ``n log n`` for any number of hits. Of several
    replacements the least counts; rows without id stay as they are.
    """
    small = bounded(dictionary.select("word", "replacement"))
    if small is not None:
        table = dictionary.groupBy("word").agg(F.min(F.struct("replacement")).alias("_r")).select("word", "_r.replacement").toArrow()
        known, new = (table.column(c).cast(pa.string()).combine_chunks() for c in ("word", "replacement"))
        replaced = F.arrow_udf(_replacer(known, new), "array<string>")(F.col(words_col))
        return texts.withColumn(out, F.when(F.col(id_col).isNull(), F.col(words_col)).otherwise(replaced))
    words = texts.select(id_col, F.posexplode(words_col).alias("_pos", "word"))
    found = lookup_join(words, dictionary.select("word", "replacement"), ["word"], [id_col, "_pos"], how="inner")
    hit = F.struct(F.col("_pos").alias("pos"), F.lit(0).alias("kept"), F.col("replacement").alias("word"))
    per_text = found.groupBy(id_col).agg(F.collect_list(hit).alias("_hits"))

    def merge(ordered: Column) -> Column:
        first = F.filter(ordered, lambda x, i: ~x["pos"].eqNullSafe(F.get(ordered, i - 1)["pos"]))
        return F.transform(first, lambda x: x["word"])

    own = F.transform(F.col(words_col), lambda w, i: F.struct(i.alias("pos"), F.lit(1).alias("kept"), w.alias("word")))
    replaced = F.when(F.col("_hits").isNull(), F.col(words_col)).otherwise(let(F.array_sort(F.concat("_hits", own)), merge))
    return texts.join(per_text, id_col, "left").withColumn(out, replaced).drop("_hits")
