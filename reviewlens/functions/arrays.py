"""Array helpers in linear or n log n time, all inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

ColumnFn = Callable[[Column], Column]


def let(value: Column, body: ColumnFn) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A column used inside a lambda is otherwise evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def positions_where(items: Column, test: Callable[[Column, Column], Column]) -> Column:
    """Ascending 0-based positions of the elements that pass ``test(element, position)``."""
    return F.array_compact(F.transform(items, lambda x, i: F.when(test(x, i), i)))


def runs(starts: Column, size: Column, emit: Callable[[Column, Column], Column]) -> Column:
    """``emit(start, length)`` for the consecutive runs that begin at ``starts``."""
    return F.transform(starts, lambda s, k: emit(s, F.coalesce(F.get(starts, k + 1), size) - s))


def term_counts(tokens: Column) -> Column:
    """Bag of words as ``array<struct<term,tf>>`` sorted by term, by sorting the row's own tokens."""

    def count(ordered: Column) -> Column:
        firsts = positions_where(ordered, lambda x, i: ~x.eqNullSafe(F.get(ordered, i - 1)))
        return let(
            firsts,
            lambda starts: runs(
                starts,
                F.size(ordered),
                lambda s, n: F.struct(F.get(ordered, s).alias("term"), n.alias("tf")),
            ),
        )

    return let(F.sort_array(tokens), count)


def term_count_map(tokens: Column) -> Column:
    """Bag of words as ``map<string,int>``."""
    return F.map_from_entries(term_counts(tokens))


def norm(counts: Column) -> Column:
    squares = F.transform(counts, lambda e: e["tf"].cast("double") * e["tf"].cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def cosine_similarity(counts_a: Column, counts_b: Column) -> Column:
    """Cosine of two ``term_counts`` arrays, 0 when one of them is empty.

    The dot product pairs equal neighbours in the sorted union, so it needs no lookup per term.
    """

    def dot(union: Column) -> Column:
        products = F.transform(
            union,
            lambda e, i: F.when(
                e["term"].eqNullSafe(F.get(union, i - 1)["term"]),
                e["tf"].cast("double") * F.get(union, i - 1)["tf"].cast("double"),
            ).otherwise(F.lit(0.0)),
        )
        return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)

    def compare(a: Column, b: Column) -> Column:
        return let(
            norm(a) * norm(b),
            lambda norms: F.when(norms == 0, F.lit(0.0)).otherwise(let(F.sort_array(F.concat(a, b)), dot) / norms),
        )

    return let(counts_a, lambda a: let(counts_b, lambda b: compare(a, b)))
