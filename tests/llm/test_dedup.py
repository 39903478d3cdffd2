"""Exact and SimHash deduplication against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewlens.llm import simhash
from reviewlens.llm.components import components
from reviewlens.llm.exact_dedup import distinct_documents, exact_groups
from reviewlens.llm.simhash import fingerprint_of, near_duplicates, near_fingerprints, near_groups, one_of_each


def groups_by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_groups(docs, rows, odd):
    assert found(exact_groups(docs)) == groups_by_hand(rows)
    assert found(exact_groups(odd)) == groups_by_hand([r.asDict() for r in odd.collect()])


def test_exact_groups_compare_texts_where_digests_collide(docs, rows):
    weak = lambda text: F.encode(F.substring(F.sha2(text, 256), 1, 1), "utf-8")
    assert found(exact_groups(docs, digest=weak)) == groups_by_hand(rows)
    assert distinct_documents(docs, digest=weak).count() == len({r["text"] for r in rows})


def test_hot_text_is_split(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_groups(rows.repartition(13))
    assert out.where("group_size = 2000 and keep_id = 2999").count() == 2000
    assert out.where("kept").count() == 1001


def test_distinct_documents_keep_whole_rows(odd, rows, docs):
    kept = distinct_documents(odd)
    assert kept.columns == odd.columns
    short = [(r["doc_id"], r["text"]) for r in kept.collect() if len(r["text"] or "") < 100]
    assert {i for i, _ in short} == {2, 3, 6, 7, 8} and (2, None) in short
    by_text = {}
    for r in rows:
        by_text[r["text"]] = max(by_text.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in distinct_documents(docs).collect()) == sorted(by_text.values())


def fingerprint_by_hand(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_by_hand(rows, radius=2):
    prints = [fingerprint_by_hand(r["text"] or "") for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[find(i)].append(r["doc_id"])
    return sorted(((r["doc_id"], p, min(least[find(i)], default=None)) for i, (r, p) in enumerate(zip(rows, prints))), key=repr)


def unsigned(df):
    return sorted(((r[0], r[1] % (1 << 64), r[2]) for r in df.collect()), key=repr)


def test_fingerprints_hash_as_spark_does(spark):
    text = "Ärger one two THREE four"
    mine = spark.sql("SELECT xxhash64('a b c') AS h").first()["h"] % (1 << 64)
    assert mine == xxhash.xxh64_intdigest(b"a b c", 42) == fingerprint_of(b"A b\x0bC")
    assert fingerprint_of(text.encode()) == fingerprint_by_hand(text)
    assert fingerprint_of(b"") == 0 and fingerprint_of(b"one") == xxhash.xxh64_intdigest(b"one", 42)


def test_near_duplicates(docs, rows, odd):
    assert unsigned(near_duplicates(docs)) == linked_by_hand(rows)
    assert unsigned(near_duplicates(odd)) == linked_by_hand([r.asDict() for r in odd.collect()])


@pytest.mark.parametrize("radius", [0, 2])
def test_every_pair_in_the_ball_is_linked(spark, radius):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for _ in range(6):
            p ^= 1 << draw.randrange(64)
            if draw.random() < 0.7:
                prints.add(p)
    prints = sorted(prints)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    root = {r["node"]: r["root"] for r in components(near_fingerprints(df, radius)).collect()}
    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= radius:
                assert root[signed(p)] == root[signed(q)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(101)} | {1000 + i: 1000 for i in range(300)}


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        near_fingerprints(spark.createDataFrame([(1,)], "fingerprint long"), 1)


def test_empty_tables(none):
    for df in (exact_groups(none), distinct_documents(none), near_duplicates(none), one_of_each(none)):
        assert df.count() == 0


def test_near_groups_hold_linked_texts_only_and_most_similar_ones(spark):
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, at = [], 0
    for base in range(25):
        words = draw.choices(vocabulary, k=draw.randint(60, 300))
        for copy in range(4):
            edited = list(words)
            for _ in range(copy):
                edited[draw.randrange(len(edited))] = draw.choice(vocabulary)
            rows.append((at, " ".join(edited)))
            at += 1
    rows += [(None, rows[0][1]), (None, None), (900, ""), (901, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    root = {r["node"]: r["root"] for r in near_groups(df).collect()}
    texts = [(i, t or "") for i, t in rows if i is not None]
    grams = {i: {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} for i, t in texts for w in [t.split()]}
    prints = {i: fingerprint_by_hand(t) for i, t in texts}
    linked = {i: {i} for i, _ in texts}
    similar = []
    for i, _ in texts:
        for j, _ in texts:
            if i < j:
                alike = len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])
                similar += [(i, j)] if alike else []
                if alike or (prints[i] ^ prints[j]).bit_count() <= 2:
                    whole = linked[i] | linked[j]
                    for k in whole:
                        linked[k] = whole
    assert all(r in linked[n] for n, r in root.items())
    assert len(similar) > 50 and all(root.get(i, -1) == root.get(j, -2) for i, j in similar)
    assert root[900] == root[901] == 900
    gone = {n for n, r in root.items() if n != r}
    assert sorted(r["doc_id"] for r in one_of_each(df).where("doc_id is not null").collect()) == sorted(set(dict(texts)) - gone)
    assert one_of_each(df).where("doc_id is null").count() == 2


def test_near_groups_find_similar_texts_wherever_they_differ(spark):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    words = lambda n: draw.choices(vocabulary, k=n)
    texts, common = [], words(25)
    for _ in range(12):
        own = words(draw.randint(150, 400))
        block = words(len(own) // 10)
        at = draw.randrange(len(own) - len(block))
        texts += [own, own + block, block + own, own[:at] + words(len(own) // 12) + own[at + len(own) // 12 :], common + words(200)]
    texts += [common, common[:3], []]
    df = spark.createDataFrame(list(enumerate(map(" ".join, texts))), "doc_id long, text string")
    root = {r["node"]: r["root"] for r in near_groups(df).collect()}
    grams = [{tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} for w in texts]
    similar = [(i, j) for i, a in enumerate(grams) for j in range(i) if len(a & grams[j]) >= 0.8 * len(a | grams[j])]
    assert len(similar) > 30
    assert [p for p in similar if root.get(p[0], -1) != root.get(p[1], -2)] == []


def test_near_groups_test_every_pair_that_meets(spark):
    draw = random.Random(8)
    words = lambda n: [f"w{draw.randrange(5000)}" for _ in range(n)]
    texts = []
    for _ in range(8):  # unlike texts with smaller ids hold each part of two near copies
        own = words(200)
        texts += [own[at : at + 60] + words(140) for at in range(0, 200, 40)] + [own[at + 20 : at + 80] + words(140) for at in range(0, 160, 40)]
        texts += [own, own[:190] + words(10)]
    df = spark.createDataFrame(list(enumerate(map(" ".join, texts))), "doc_id long, text string")
    root = {r["node"]: r["root"] for r in near_groups(df).collect()}
    grams = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in texts]
    similar = {(j, i) for i, a in enumerate(grams) for j in range(i) if len(a & grams[j]) >= 0.8 * len(a | grams[j])}
    assert len(similar) == 8 and {(r, n) for n, r in root.items() if n != r} == similar


def test_templated_texts_make_few_pairs(spark, monkeypatch):
    """Texts of common lines only, none similar: what is verified grows with the texts, not with their pairs."""
    draw, tested = random.Random(9), []
    lines = [" ".join(f"w{draw.randrange(5000)}" for _ in range(10)) for _ in range(100)]
    verify = simhash._verified

    def counted(pairs, *rest):
        tested[-1] += pairs.distinct().count()
        return verify(pairs, *rest)

    monkeypatch.setattr(simhash, "_verified", counted)
    for n in (150, 300):
        texts = [" ".join(draw.sample(lines, 30)) for _ in range(n)]
        texts += [" ".join([*t.split(" ")[:-4], "x"]) for t in texts[:10]]
        tested.append(0)
        root = {r["node"]: r["root"] for r in near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
        assert {i: r for i, r in root.items() if i != r} == {n + i: i for i in range(10)}
    assert tested[1] <= 40


def test_near_copies_of_one_text_take_few_rounds(spark, monkeypatch):
    """Edited at random places, copies first meet at many keys; the rounds must not go on for the few pairs each finds."""
    draw, tested = random.Random(3), []
    base = [f"w{draw.randrange(5000)}" for _ in range(300)]
    texts = []
    for _ in range(80):
        text = list(base)
        for _ in range(draw.randint(2, 5)):
            text[draw.randrange(300)] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(text))
    verify = simhash._verified

    def counted(pairs, *rest):
        tested.append(pairs.distinct().count())
        assert len(tested) <= 4
        return verify(pairs, *rest)

    monkeypatch.setattr(simhash, "_verified", counted)
    root = {r["node"]: r["root"] for r in near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert root == dict.fromkeys(range(80), 0)
    assert sum(tested) < 80 * 79 / 4


def test_marks_bound_the_difference():
    draw = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.unique(draw.integers(0, draw.integers(1, 3000), draw.integers(1, 900), dtype=np.uint64) << np.uint64(7)) for _ in range(2))
        apart = sum(int(x).bit_count() for x in (simhash.marks_of(a) ^ simhash.marks_of(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))


def test_frequent_keys_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_LEVEL", 2)
    texts = [" ".join(f"w{k}" for k in range(i % 4, 60 + i // 4)) for i in range(120)]
    root = {r["node"]: r["root"] for r in near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert set(root.values()) == {0} and len(root) == 120
