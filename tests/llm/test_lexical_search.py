"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewlens.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_by_hand(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked_by_hand(docs, items, k=50):
    counts = [(i, Counter(terms_by_hand(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    frequency = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms_by_hand(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            parts = [
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms if t in c
            ]
            if sum(parts) > 0:
                scores.append((-sum(parts), i is None, i or 0))
        out += [(item, n, None if none else i, -s) for n, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, **settings):
    return sorted((tuple(r) for r in ls.search(docs, items, **settings).collect()), key=repr)


def test_terms_of():
    text = "Größe ABC_d-9 x\x7fy 😀Z z ÄB"
    assert [t.decode() for t in ls.terms_of(text.encode())] == terms_by_hand(text) == ["größe", "abc", "d", "9", "x", "y", "😀z z", "Äb"]


@pytest.mark.parametrize("seed", range(30))
def test_best_of_equals_the_sorted_sums(seed):
    draw = np.random.default_rng(seed)
    n, k = int(draw.integers(1, 9000)), int(draw.integers(1, 60))
    blocks, sums, lists = -(-n // ls.BLOCK), np.zeros(n, np.int64), []
    for _ in range(int(draw.integers(1, 12))):
        docs = np.sort(draw.choice(n, int(draw.integers(1, n + 1) ** draw.choice([0.4, 0.8, 1.0])), replace=False))
        parts = draw.integers(0, draw.choice([3, 1000, 1_000_000]), len(docs))
        sums[docs] += parts
        lists.append(ls.PostingList(docs, parts, blocks))
    tie = draw.permutation(n)
    order = np.lexsort((tie, -sums))
    order = order[sums[order] > 0][:k]
    docs, scores = ls.best_of(lists, tie, k)
    assert docs.tolist() == order.tolist() and scores.tolist() == sums[order].tolist()


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, sf_dir, docs, rows, monkeypatch, small):
    """Also with many segments, blocks of few items and terms too many to send."""
    if small:
        for name, value in (("BLOCK_ITEMS", 3), ("SENT_TERMS", 10)):
            monkeypatch.setattr(ls, name, value)
        docs = docs.repartition(7)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(12)
    want = ranked_by_hand([(r["doc_id"], r["text"]) for r in rows], [tuple(r) for r in items.select("item_id", "text").collect()], 20)
    assert found(docs, items, k=20) == want and len(want) > 100


def test_search_in_odd_tables(spark, odd, none):
    pairs = [(1, "One two"), (1, "six alpha"), (2, None), (3, " ,"), (None, "one"), (4, "nowhere"), (5, "größe 😀 delta delta")]
    items = spark.createDataFrame([(*p, 7) for p in pairs], "item_id long, text string, rank int")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(odd, items) == ranked_by_hand(docs, pairs) != []
    assert found(none, items) == [] and found(odd, items.limit(0)) == []
    draw = random.Random(5)
    many = [(i % 9, " ".join(draw.choices("abcdefgh", [9, 8, 5, 3, 2, 1, 1, 1], k=draw.randint(0, 30)))) for i in range(400)]
    table = spark.createDataFrame(many, "doc_id long, text string").repartition(5)
    assert found(table, items.union(spark.createDataFrame([(9, "h a c", 1)], items.schema)), k=50) == ranked_by_hand(many, [(9, "h a c")], 50)
