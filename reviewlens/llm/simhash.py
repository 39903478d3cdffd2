"""SimHash near-duplicates by meeting in the middle of the Hamming ball."""

from __future__ import annotations

import math
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.llm.common import small_batches
from reviewlens.llm.components import components
from reviewlens.operators.joins import bounded, lookup_join, salted_lookup
from reviewlens.session import discard, stored

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: For whole near copies: shared shingles, words of such a shingle.
SIMILARITY, SIMILAR_WORDS = 0.8, 5
#: Shingles counted at a time, and those known as frequent at most. Both only order the shingles of a text: any order
#: finds the same pairs, one by rarity tries fewer.
COUNTED, FREQUENT = 1 << 20, 500_000
#: Level from which a shingle is frequent enough to be dealt to parts: one more than the logarithm of its count.
HOT_LEVEL = 16
#: Longs of parities of a text.
MARKS = 16
#: Members of a key are tried against one of them again if the last time left at most this share of the pairs to try.
LEAVES = 0.5
_CHUNK = 1 << 15


def fingerprint_of(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of one text in UTF-8: a bit is set if over half of the shingle hashes set it.

    ``bytes.lower`` and ``bytes.split`` know ASCII letters and whitespace only, as wanted. No word: 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle_words)]))
        n = len(words) - shingle_words + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """``fingerprint_of`` for a column, as a signed long; null text counts as empty."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = (fingerprint_of(t.as_buffer().to_pybytes(), shingle_words, seed) for t in texts.cast(pa.large_binary()))
        return pa.array(np.fromiter(found, np.uint64, len(texts)).view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def near_fingerprints(prints: DataFrame, radius: int = RADIUS, bits: int = 64) -> DataFrame:
    """Links ``(a, b)`` that join all distinct ``fingerprint`` values within ``radius`` of ``bits`` bits, transitively.

    Every fingerprint is sent to all values within half the radius. Two fingerprints in ``radius`` meet at
    one of them, and all that meet at a value are within the radius of each other, so linking each to the
    smallest there loses nothing and makes no pairs within a group, which holds at most as many
    fingerprints as the ball has values (65 for radius 2).
    """
    if radius < 0 or radius % 2:
        raise ValueError("radius must be even")
    masks = [sum(1 << b for b in places) for n in range(radius // 2 + 1) for places in combinations(range(bits), n)]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    variants = prints.select("fingerprint", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("_mask"))
    variants = variants.select("fingerprint", F.col("fingerprint").bitwiseXOR(F.col("_mask")).alias("_variant"))
    met = variants.select(
        F.col("fingerprint").alias("a"), F.min("fingerprint").over(Window.partitionBy("_variant")).alias("b")
    )
    return met.where("a <> b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row; ``fingerprint`` is a signed long.

    ``component_id`` is the smallest id reachable over fingerprints at ``radius`` or fewer differing
    bits. Rows without words, null text included, have fingerprint 0 and are linked like any other. Null
    ids count in no minimum; a component of such rows only has a null id. Repeated rows give repeated
    rows, an empty table none, and other columns are not read.
    """
    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle_words, seed).alias("fingerprint"))
    rows = stored(rows, "fingerprints")
    groups = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n")), "groups")
    roots = components(near_fingerprints(groups.select("fingerprint"), radius)).withColumnRenamed("node", "fingerprint")
    linked = roots.join(groups.select("fingerprint", "_first"), "fingerprint")
    least = linked.groupBy("root").agg(F.min("_first").alias("_least"), F.count("*").alias("_prints"))
    ids = salted_lookup(linked.select("fingerprint", "root"), least, "root", "_prints").select("fingerprint", "_least")
    named = groups.join(ids, "fingerprint", "left").select(
        "fingerprint", "_n", F.coalesce("_least", "_first").alias("component_id")
    )
    return salted_lookup(rows, named, "fingerprint", "_n").select("doc_id", "fingerprint", "component_id")


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def shingles_of(text: bytes, words: int = SIMILAR_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct word shingles of a text; a text with fewer words is one shingle."""
    found = text.lower().split()
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found))], np.uint64)
    plain = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = len(found) - words + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(words):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + plain[i : i + n]
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return np.unique(mixed ^ mixed >> np.uint64(32))


def shingle_hashes(text: Column, words: int) -> Column:
    """``shingles_of`` for a column, as signed longs; null text counts as empty."""

    @F.arrow_udf("array<long>")
    def of(texts: pa.Array) -> pa.Array:
        rows = [shingles_of(t.as_buffer().to_pybytes(), words).view(np.int64) for t in texts.cast(pa.large_binary())]
        return pa.array(rows, pa.list_(pa.int64()))

    return of(F.coalesce(text, F.lit("")))


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that are frequent, and the binary logarithm of their counts.

    Counted are those that occur again among ``COUNTED`` shingles of a task, so rare ones are never shuffled.
    """

    def repeated(batches):
        def of(kept):
            found, n = np.unique(np.concatenate(kept), return_counts=True)
            found, n = found[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["shingle", "n"])

        kept, size = [], 0
        for batch in batches:
            for t in batch.column(0).cast(pa.large_binary()):
                kept.append(shingles_of(t.as_buffer().to_pybytes(), words))
                size += len(kept[-1])
                if size >= COUNTED:
                    yield of(kept)
                    kept, size = [], 0
        if kept:
            yield of(kept)

    counts = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(repeated, "shingle long, n long")
    counts = counts.groupBy("shingle").agg(F.sum("n").alias("n"))
    table = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    shingles, n = table["shingle"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], np.log2(n[order]).astype(np.uint8) if len(n) else np.zeros(0, np.uint8)


def rarest_first(shingles: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``shingles`` of a text, frequent ones last, and their levels: 0, or one more than the logarithm of the count."""
    known, level = frequent
    if not len(known):
        return shingles, np.zeros(len(shingles), np.uint8)
    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
    found = np.where(known[at] == shingles, level[at] + 1, 0).astype(np.uint8)
    order = np.lexsort((shingles, found))
    return shingles[order], found[order]


def prefix_length(size: int, similarity: float) -> int:
    """So many of its first shingles hold one of any text of ``similarity``.

    Such texts share at least ``similarity`` of the shingles of either, so in one order for all texts the
    first shared one comes before as many as are left.
    """
    return size - max(math.ceil(similarity * size - 1e-9), 1) + 1


def _keys(text: Column, similarity: float, words: int, frequent) -> Column:
    """``struct<size, keys>``: the number of shingles of a text, and the rarest of them in order, with their levels."""
    pair = pa.struct([("key", pa.int64()), ("level", pa.int32())])
    kind = [pa.field("size", pa.int32()), pa.field("keys", pa.list_(pair))]

    @F.arrow_udf("struct<size: int, keys: array<struct<key: long, level: int>>>")
    def of(texts: pa.Array) -> pa.Array:
        sizes, ends, keys, levels = [], [0], [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for t in texts.cast(pa.large_binary()):
            found, level = rarest_first(shingles_of(t.as_buffer().to_pybytes(), words), frequent)
            n = prefix_length(len(found), similarity)
            keys.append(found[:n])
            levels.append(level[:n].astype(np.int32))
            sizes.append(len(found))
            ends.append(ends[-1] + n)
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(levels))], fields=list(pair))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), lists], fields=kind)

    return of(F.coalesce(text, F.lit("")))


def marks_of(shingles: np.ndarray) -> np.ndarray:
    """Parities of the numbers of ``shingles`` in each of ``64 * MARKS`` classes.

    Two sets that differ in ``n`` shingles differ in at most ``n`` parities.
    """
    odd = np.bincount(((shingles >> np.uint64(7)) % np.uint64(64 * MARKS)).astype(np.int64), minlength=64 * MARKS).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def _all_prints(text: Column, shingle_words: int, seed: int, words: int) -> Column:
    """``struct<fingerprint, size, marks>``: the SimHash, the number of shingles, and their parities."""
    kind = pa.struct([("fingerprint", pa.int64()), ("size", pa.int32()), ("marks", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<fingerprint: long, size: int, marks: array<long>>")
    def of(texts: pa.Array) -> pa.Array:
        data = [t.as_buffer().to_pybytes() for t in texts.cast(pa.large_binary())]
        prints = np.fromiter((fingerprint_of(t, shingle_words, seed) for t in data), np.uint64, len(data)).view(np.int64)
        found = [shingles_of(t, words) for t in data]
        marks = pa.array([marks_of(x) for x in found], pa.list_(pa.int64()))
        return pa.StructArray.from_arrays([pa.array(prints), pa.array([len(x) for x in found], pa.int32()), marks], fields=list(kind))

    return of(F.coalesce(text, F.lit("")))


def _links(prints: DataFrame, radius: int) -> DataFrame:
    """Links ``(a, b)`` of ids over ``(doc_id, fingerprint)``: to the first id of the own and of near fingerprints."""
    groups = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("_n")), "groups")
    own = salted_lookup(prints, groups, "fingerprint", "_n").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    near = near_fingerprints(groups.select("fingerprint"), radius)
    for side in ("a", "b"):
        firsts = groups.select(F.col("fingerprint").alias(side), F.col("first").alias(f"_{side}"))
        near = near.join(firsts, side)
    return own.where("a <> b").unionByName(near.select(F.col("_a").alias("a"), F.col("_b").alias("b")))


def _overlap(size_a: str, size_b: str, similarity: float) -> Column:
    """So many shingles two texts of ``similarity`` share at least."""
    return F.ceil(similarity / (1 + similarity) * (F.col(size_a) + F.col(size_b)) - 1e-9)


def _sizes_fit(similarity: float) -> Column:
    """Whether two texts, ``a`` and ``b``, have numbers of shingles that allow them to be similar."""
    return F.least("a.size", "b.size") >= similarity * F.greatest("a.size", "b.size") - 1e-9


def _may_be_alike(similarity: float, first: bool = True) -> Column:
    """Whether two texts, ``a`` and ``b``, that share the shingle at ``pos`` of either order can be similar.

    Their sizes must fit, and no more parities may differ than shingles can. With ``first``, what is left of the shorter rest
    must be enough to share, as at the first shingle that two similar texts share; who tries all keys of a pair meets it there.
    """
    enough = _overlap("a.size", "b.size", similarity)
    rest = F.least(F.col("a.size") - F.col("a.pos"), F.col("b.size") - F.col("b.pos")) >= enough if first else F.lit(True)
    apart = F.aggregate(F.zip_with("a.marks", "b.marks", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    return _sizes_fit(similarity) & rest & (apart <= F.col("a.size") + F.col("b.size") - 2 * enough)


def _alike(words: int, similarity: float, a: str, b: str) -> Column:
    """Whether two texts share ``similarity`` of their distinct shingles."""

    @F.arrow_udf("boolean")
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left.cast(pa.large_binary()).to_pylist(), right.cast(pa.large_binary()).to_pylist()):
            x, y = shingles_of(x, words), shingles_of(y, words)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            out.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
        return pa.array(out, pa.bool_())

    return of(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def _verified(pairs: DataFrame, docs: DataFrame, similarity: float, words: int) -> DataFrame:
    """The stored pairs of similar texts, each once."""
    pairs = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    texts = stored(_semi_or_anti(docs, pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct(), "left_semi"), "texts")
    joined = pairs
    for side in ("a", "b"):
        table = texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"_{side}"))
        joined = lookup_join(joined, table, [side], ["a", "b"], how="inner", max_rows=0)  # texts: no need to measure them
    alike = stored(joined.where(_alike(words, similarity, "_a", "_b")).select("a", "b"), "alike")
    discard(texts, pairs)
    return alike


def _members(docs: DataFrame, similarity: float, words: int) -> DataFrame:
    """Stored ``(key, doc_id, size, pos)`` for the keys at which two texts can meet: rare shingles that occur twice.

    One shuffle drops the shingles of a single text, that is nearly all. Keys known to be frequent are dealt to parts of
    bounded size and kept as they are.
    """
    found = docs.select("doc_id", _keys(F.col("text"), similarity, words, _frequent(docs, words)).alias("_found"))
    keys = found.select("doc_id", F.col("_found.size").alias("size"), F.posexplode("_found.keys").alias("pos", "_key"))
    parts = F.expr(f"shiftleft(1L, _key.level - {HOT_LEVEL})")
    part = F.when(F.col("_key.level") > HOT_LEVEL, F.pmod(F.xxhash64("doc_id"), parts) + 1).otherwise(F.lit(0))
    keys = keys.select("doc_id", "size", "pos", "_key.key", part.alias("part"))
    same = Window.partitionBy("key", "part")
    first = F.col("size") - F.col("pos") >= F.ceil(2 * similarity / (1 + similarity) * F.col("size") - 1e-9)
    kept = keys.select("*", F.count("*").over(same).alias("_n"), F.max(first).over(same).alias("_first"))
    return stored(kept.where("part > 0 or (_n > 1 and _first)").select("key", "doc_id", "size", "pos"), "members")


def _open(members: DataFrame, links: DataFrame, salt: int) -> tuple[DataFrame, float]:
    """Stored ``members`` of the keys that hold more than one component of ``links``, with ``root`` and the ``centre`` of the key.

    And the number of pairs of different components that meet at these keys.
    """
    members = members.select("key", "doc_id", "size", "pos")
    members = members.join(components(links).withColumnRenamed("node", "doc_id"), "doc_id", "left")
    members = stored(members.withColumn("root", F.coalesce("root", "doc_id")), "rooted")
    order = lambda at: F.struct(F.xxhash64(f"{at}doc_id", F.lit(salt)), F.col(f"{at}doc_id"))
    one = F.min_by(F.struct("doc_id", "size", "pos", "root"), order(""))
    groups = members.groupBy("key", "root").agg(one.alias("centre"), F.count("*").alias("_m"))
    square = F.sum(F.col("_m").cast("double") * F.col("_m"))
    groups = groups.groupBy("key").agg(
        F.min_by("centre", order("centre.")).alias("centre"), F.sum("_m").alias("_n"), square.alias("_same"), F.count("*").alias("_roots")
    )
    groups = stored(groups.where("_roots > 1").drop("_roots"), "groups")
    apart = groups.agg(F.sum((F.col("_n").cast("double") * F.col("_n") - F.col("_same")) / 2)).first()[0] or 0.0
    found = stored(salted_lookup(members, groups.drop("_same"), "key", "_n").where("centre is not null").drop("_n"), "open")
    discard(members, groups)
    return found, apart


def _similar_links(docs: DataFrame, prints: DataFrame, links: DataFrame, similarity: float, words: int) -> DataFrame:
    """``links`` with those between texts that share a shingle of their prefixes and ``similarity`` of all.

    As long as that leaves far fewer pairs, the members of a key are tried against one of them, so a large group of near copies
    costs a few pairs a member, and the rounds grow with the logarithm of the pairs. What is still apart then is tried pair
    by pair: a pair that can be similar is left out only if it is linked already.
    """
    members, before, rounds = _members(docs, similarity, words), math.inf, 0
    marks = prints.select("doc_id", "marks")
    while True:
        found, apart = _open(members, links, rounds)
        discard(members)
        members = found
        if not apart:
            return links
        if apart > LEAVES * before:
            break
        star = members.where("root <> centre.root").select("doc_id", "size", "pos", "centre")
        star = star.select(F.struct("doc_id", "size", "pos").alias("a"), F.col("centre").alias("b")).where(_sizes_fit(similarity))
        pairs = _with_marks(star, marks).where(_may_be_alike(similarity, first=False))
        alike = _verified(pairs.select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")), docs, similarity, words)
        links, before, rounds = stored(links.unionByName(alike), "links"), apart, rounds + 1
        discard(alike)
    rows = stored(members.join(marks, "doc_id"), "marked")
    side = lambda x: rows.select("key", F.struct("doc_id", "size", "pos", "root", "marks").alias(x))
    pairs = lookup_join(side("a"), side("b"), ["key"], ["a"], how="inner").where("a.doc_id > b.doc_id and a.root <> b.root")
    pairs = pairs.where(_may_be_alike(similarity)).select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b"))
    alike = _verified(pairs, docs, similarity, words)
    discard(rows, members)
    return links.unionByName(alike)


def _with_marks(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of structs with a ``doc_id``, each once, with the ``marks`` of both."""
    pairs = pairs.groupBy("a.doc_id", F.col("b.doc_id").alias("_other")).agg(F.min("a").alias("a"), F.min("b").alias("b"))
    for side, key in (("a", "doc_id"), ("b", "_other")):
        pairs = lookup_join(pairs, marks.select(F.col("doc_id").alias(key), F.col("marks").alias("_marks")), [key], ["doc_id", "_other"], "inner")
        pairs = pairs.withColumn(side, F.struct(f"{side}.size", f"{side}.pos", f"{side}.doc_id", F.col("_marks").alias("marks"))).drop("_marks")
    return pairs


def _semi_or_anti(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` by ``ids`` (``_id``), without moving the texts where the ids are few."""
    ids = stored(ids, "ids")
    small = bounded(ids, 200_000)
    ids = ids if small is None else small
    return docs.join(ids, docs["doc_id"] == ids["_id"], how)


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    seed: int = SEED,
    similarity: float = SIMILARITY,
    similar_words: int = SIMILAR_WORDS,
) -> DataFrame:
    """``(node, root)`` for the ids that have a near copy; ``root`` is the smallest id of the group.

    Linked are fingerprints in ``radius``, as in ``near_duplicates``, and texts that share ``similarity`` of
    their ``similar_words`` shingles. Texts that similar often differ in more bits, so they are searched by the
    rarest of these shingles, of which they share at least one, and what meets there is verified on the texts.
    Rows without id are left out; rows with the same id count as one document. Null and empty texts are alike, texts of any
    length are read whole, other columns are not read, and an empty table has no groups.
    """
    docs = small_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("doc_id is not null")
    prints = docs.select("doc_id", _all_prints(F.col("text"), shingle_words, seed, similar_words).alias("prints"))
    prints = stored(prints.select("doc_id", "prints.*"), "fingerprints")
    links = stored(_links(prints.select("doc_id", "fingerprint"), radius), "links")
    return components(_similar_links(docs, prints, links, similarity, similar_words))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without those that have a near copy with a smaller id, see ``near_groups``; rows without id stay."""
    dropped = near_groups(docs, id_col, text_col, **settings).where("node <> root")
    ids = stored(dropped.select(F.col("node").alias("_id")), "dropped")
    small = bounded(ids, 200_000)
    ids = ids if small is None else small
    return docs.join(ids, docs[f"`{id_col}`"] == ids["_id"], "left_anti")
