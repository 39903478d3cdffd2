"""Hard negatives by inner product, searched in cover trees over norm-augmented vectors.

With one more component, ``sqrt(M^2 - |x|^2)``, all vectors have the norm ``M``, and an inner product with an anchor is a
function of the distance to it. So the covering radius of a node bounds the inner products of everything below it from both
sides. Rows are dealt to forests of bounded size, a tree per label in each; anchors meet every forest in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.session import stored

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
ANCHOR_EVERY, NOISE_EVERY, LABELS, SCALE = 100, 7, 10, 256
#: Rows of a forest and of a node that is not divided, anchors of a block, and the bytes of vectors in either.
FOREST_ROWS, LEAF_ROWS, BLOCK_ANCHORS, GROUP_BYTES = 8192, 16, 4096, 16 << 20
#: The radius of a node over that of its children.
BASE = 1.6
#: Rows that choose the centres of regions, regions at most, and forests for one more region.
SAMPLE, REGIONS, FORESTS_PER_REGION = 2048, 64, 4


def distances(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Of augmented vectors to one of them."""
    apart = vectors - centre
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def augmented(vectors: np.ndarray, square: float) -> np.ndarray:
    """``vectors`` with the component that gives all of them the squared norm ``square``."""
    own = np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(square - own, 0.0))])


def grow(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, nodes)`` of a cover tree over augmented ``vectors``.

    A node covers the slice ``start`` to ``end`` of ``order``, its children are centred on points of it that are further
    apart than its radius over ``BASE`` and cover the rest within that; the first has its own centre. Points that are
    children by themselves come first, up to ``own``. Nodes are rows ``(level, start, own, end, centre, radius)``, parents
    first, with the measured radius.
    """
    order: list[int] = []
    nodes: list[tuple] = []
    members = np.arange(len(vectors))
    stack = [(0, members, distances(vectors, vectors[0]))] if len(vectors) else []
    while stack:
        level, members, far = stack.pop()
        start, radius, single, children = len(order), float(far.max()), [], []
        if len(members) <= LEAF_ROWS or radius == 0.0:
            single.append(members)
        else:
            left, away = members, far
            while len(left):
                near = away <= radius / BASE
                if near.sum() == 1:
                    single.append(left[near])
                else:
                    children.append((level + 1, left[near], away[near]))
                left = left[~near]
                away = distances(vectors[left], vectors[left[0]]) if len(left) else left
        for part in single:
            order.extend(part.tolist())
        nodes.append((level, start, len(order), start + len(members), members[0], radius))
        stack.extend(reversed(children))
    order = np.array(order, np.int64)
    found = np.array(nodes, np.float64).reshape(-1, 6)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    found[:, 4] = place[found[:, 4].astype(np.int64)]
    return order, found


class Forest:
    """Cover trees of the labels of one part of the rows, ready to be searched."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, nodes: np.ndarray, square: float):
        self.ids, self.labels, self.vectors, self.square = ids, labels, vectors, square
        self.level, self.start, self.own, self.end, self.centre = (nodes[:, n].astype(np.int64) for n in range(5))
        self.radius = nodes[:, 5]
        self.children: list[np.ndarray] = []
        path: list[int] = []
        lists: list[list[int]] = [[] for _ in self.level]
        for n, level in enumerate(self.level.tolist()):
            del path[level:]
            if path:
                lists[path[-1]].append(n)
            path.append(n)
        self.children = [np.array(x, np.int64) for x in lists]
        self.roots = np.flatnonzero(self.level == 0)
        self.root_labels = self.labels[self.start[self.roots]]

    def search(self, anchor: np.ndarray, roots: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int, but: int | None) -> list:
        """Per window ``lows`` to ``highs`` of inner products ``(scores, rows)`` of its ``k`` first, without the id ``but``.

        Best first: the node that may hold the highest product inside a window comes next. A node is skipped if its
        bounds lie outside all windows, whose lower ends rise to the ``k``-th product found.
        """
        least, highest = lows.astype(np.float64), float(highs.max())
        best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in lows]
        base = float(anchor @ anchor) + self.square
        slack = 1e-9 * base + 1e-6
        heap: list[tuple] = []

        def push(nodes: np.ndarray) -> None:
            apart = np.sqrt(np.maximum(base - 2 * (self.vectors[self.centre[nodes]] @ anchor), 0.0))
            radius = self.radius[nodes]
            most = (base - np.maximum(apart - radius, 0.0) ** 2) / 2 + slack
            fewest = (base - (apart + radius) ** 2) / 2 - slack
            open_ = ((most[:, None] >= least) & (fewest[:, None] <= highs)).any(1)
            for n, a, b in zip(nodes[open_].tolist(), most[open_].tolist(), fewest[open_].tolist()):
                heapq.heappush(heap, (-min(a, highest), n, a, b))

        def offer(low: int, high: int) -> None:
            scores = self.vectors[low:high] @ anchor
            for w in range(len(lows)):
                rows = np.flatnonzero((scores >= least[w]) & (scores <= highs[w]))
                if but is not None:
                    rows = rows[self.ids[low + rows] != but]
                if not len(rows):
                    continue
                found = np.concatenate([best[w][0], scores[rows]])
                rows = np.concatenate([best[w][1], low + rows])
                keep = np.lexsort((self.ids[rows], -found))[:k]
                best[w] = found[keep], rows[keep]
                if len(keep) == k:
                    least[w] = max(least[w], best[w][0][-1])

        if len(roots):
            push(roots)
        while heap:
            _, n, most, fewest = heapq.heappop(heap)
            if not ((most >= least) & (fewest <= highs)).any():
                continue
            if self.own[n] > self.start[n]:
                offer(self.start[n], self.own[n])
            if len(self.children[n]):
                push(self.children[n])
        return best


def prepared(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, label, x)``: one row per id, labels with noise and components in whole steps.

    Left out are rows without id, label or vector, or with a null or non-finite component. Of rows with one id the one with the
    least label and then vector stays.
    """
    vector = F.col(f"`{vector_col}`")
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), vector.cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = rows.where("vec_id is not null and label is not null and x is not null").where(finite)
    label = F.when(F.col("vec_id") % NOISE_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    whole = F.transform("x", lambda v: F.floor(v * SCALE).cast("long"))
    rows = rows.select("vec_id", label.alias("label"), whole.alias("x"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("_one")).select("vec_id", "_one.*")


def _vectors(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """A column of vectors as a matrix; shorter ones end in zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), size))
    out[np.arange(size) < lengths[:, None]] = rows.flatten().to_numpy(zero_copy_only=False)
    return out


def _with_region(rows: DataFrame, size: int, square: float, wanted: int) -> DataFrame:
    """``rows`` with the number of the nearest of ``wanted`` centres, far from each other, of a sample of fixed size."""
    if wanted <= 1:
        return rows.withColumn("region", F.lit(0))
    some = rows.orderBy(F.xxhash64("vec_id", F.lit("centre")), "vec_id").limit(SAMPLE).select("x").toArrow()
    points = augmented(_vectors(some["x"], size), square)
    chosen, away = [0], distances(points, points[0])
    while len(chosen) < wanted and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(points, points[chosen[-1]]))
    centres = points[chosen]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = augmented(_vectors(batch.column("x"), size), square)
            region = (own @ centres.T).argmax(1).astype(np.int32)  # all norms are equal
            yield batch.append_column("region", pa.array(region))

    return rows.mapInArrow(nearest, "vec_id long, label long, x array<long>, region int")


def cover_forests(rows: DataFrame, size: int, square: float, n_rows: int) -> DataFrame:
    """The stored trees over ``prepared`` rows: ``(forest, vec_id, label, x, position, nodes)``.

    A forest holds about ``FOREST_ROWS`` rows of one region, fewer if vectors are long; a region with more rows, one vector
    that occurs often for example, is dealt to several by the hash of the id. ``nodes`` are those that start at a row.
    """
    limit = max(min(FOREST_ROWS, GROUP_BYTES // (8 * max(size, 1))), LEAF_ROWS)
    regions = min(REGIONS, -(-n_rows // (limit * FORESTS_PER_REGION)))
    rows = _with_region(rows, size, square, regions)
    parts = rows.groupBy("region").agg(F.ceil(F.count("*") / limit).alias("parts"))  # a row per region
    rows = rows.join(F.broadcast(parts), "region")
    rows = rows.withColumn("forest", F.concat_ws("-", "region", F.pmod(F.xxhash64("vec_id"), F.col("parts"))))

    def trees(table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")])
        vectors, labels = augmented(_vectors(table["x"], size), square), table["label"].to_numpy()
        starts = [*np.flatnonzero(np.diff(labels, prepend=labels[:1] - 1)), len(labels)]
        order, nodes = [], [[] for _ in labels]
        for low, high in zip(starts, starts[1:]):
            own, found = grow(vectors[low:high])
            order.append(own + low)
            for level, start, single, end, centre, radius in found.tolist():
                nodes[int(start) + low].append((int(level), int(single) + low, int(end) + low, int(centre) + low, radius))
        table = table.take(pa.array(np.concatenate(order)))
        columns = [table[c] for c in ("forest", "vec_id", "label", "x")]
        kind = pa.struct([("level", pa.int32()), ("own", pa.int32()), ("end", pa.int32()), ("centre", pa.int32()), ("radius", pa.float64())])
        records = [[dict(zip(("level", "own", "end", "centre", "radius"), n)) for n in at] for at in nodes]
        return pa.table([*columns, pa.array(np.arange(len(labels)), pa.int32()), pa.array(records, pa.list_(kind))],
                        ["forest", "vec_id", "label", "x", "position", "nodes"])

    kind = "array<struct<level: int, own: int, end: int, centre: int, radius: double>>"
    schema = f"forest string, vec_id long, label long, x array<long>, position int, nodes {kind}"
    rows = rows.select("forest", "vec_id", "label", "x")
    return stored(rows.groupBy("forest").applyInArrow(trees, schema), "cover-trees")


def _read_forest(table: pa.Table, size: int, square: float) -> Forest:
    table = table.sort_by("position")
    nodes = [
        (n["level"], at, n["own"], n["end"], n["centre"], n["radius"])
        for at, here in enumerate(table["nodes"].to_pylist()) for n in here
    ]
    columns = (table["vec_id"].to_numpy(), table["label"].to_numpy(), _vectors(table["x"], size))
    return Forest(*columns, np.array(nodes, np.float64).reshape(-1, 6), square)


def _searched(trees: DataFrame, anchors: DataFrame, blocks: int, size: int, square: float, windows, schema: str) -> DataFrame:
    """What ``windows`` finds for each anchor in each forest; a task has one forest and one block of anchors."""
    forests = trees.select(F.col("forest").alias("forest")).distinct()
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    # The anchors are a stated query set that meets all rows: forests by blocks, and nothing is paired row by row.
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int"))
    asked = forests.select("forest", block).join(asked, "block")
    names = [part.split()[0] for part in schema.split(", ")]

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(rows) and len(queries):
            forest = _read_forest(rows, size, square)
            for anchor, vector in zip(queries.drop(["x"]).to_pylist(), _vectors(queries["x"], size)):
                found.extend(windows(forest, anchor, vector))
        columns = list(zip(*found)) or [[] for _ in names]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names)

    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # the two sides share columns
    left = trees.select("*", block)
    return left.groupBy("forest", "block").cogroup(asked.groupBy("forest", "block")).applyInArrow(search, schema)


def _first(rows: DataFrame, keys: list[str], score: str, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), by)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    is_anchor: Column | None = None,
    **columns: str,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``, exact.

    For each anchor (``is_anchor``, a condition on ``vec_id``) its ``positives`` first other rows of the same label, and for
    each of these the ``negatives`` first rows of other labels whose score is ``low`` to ``high`` hundredths of the
    positive's. Scores are inner products, higher ones first, ties by smaller id. See ``prepared`` for the rows that take
    part; vectors of unequal length are compared as if the shorter ended in zeros. An anchor without another row of its
    label, or without a row in a window, has no rows; nor has an empty table. Other columns are not read.
    """
    rows = stored(prepared(embeddings, **columns), "vectors")
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    sums = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("size"), F.max(square).alias("square")).first()
    size, top = sums["size"] or 0, sums["square"] or 0.0
    trees = cover_forests(rows, size, top, sums["n"])

    is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0 if is_anchor is None else is_anchor
    anchors = stored(rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "x"), "anchors")
    per_block = max(min(BLOCK_ANCHORS, GROUP_BYTES // (8 * max(size, 1))), 1)
    blocks = -(-anchors.count() // per_block) or 1

    def nearest(forest: Forest, anchor: dict, vector: np.ndarray) -> Iterator[tuple]:
        roots = forest.roots[forest.root_labels == anchor["label"]]
        every = np.array([-np.inf]), np.array([np.inf])
        ((scores, at),) = forest.search(vector, roots, *every, positives, anchor["anchor_id"])
        for score, n in zip(scores.tolist(), at.tolist()):
            yield anchor["anchor_id"], int(forest.ids[n]), int(score)

    schema = "anchor_id long, positive_id long, positive_score long"
    near = _searched(trees, anchors, blocks, size, top, nearest, schema)
    near = _first(near, ["anchor_id"], "positive_score", "positive_id", positives)
    near = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("near"))
    wanted = stored(anchors.join(near, "anchor_id"), "windows")

    def inside(forest: Forest, anchor: dict, vector: np.ndarray) -> Iterator[tuple]:
        near = [(p["positive_id"], p["positive_score"]) for p in anchor["near"]]
        windows = [(i, s, -(-low * s // 100), high * s // 100) for i, s in near]
        windows = [w for w in windows if w[2] <= w[3]]
        if not windows:
            return
        roots = forest.roots[forest.root_labels != anchor["label"]]
        lows, highs = (np.array([w[n] for w in windows], np.float64) for n in (2, 3))
        for (i, s, _, _), (scores, at) in zip(windows, forest.search(vector, roots, lows, highs, negatives, None)):
            for score, n in zip(scores.tolist(), at.tolist()):
                yield anchor["anchor_id"], i, int(forest.ids[n]), s, int(score)

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = _searched(trees, wanted, blocks, size, top, inside, schema)
    found = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
