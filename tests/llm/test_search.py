"""Decontamination, secrets and URL lists against brute force."""

import base64
import datetime
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import decontamination as dc
from reviewlens.llm.secrets import ENCODINGS, battery, listed, secrets
from reviewlens.llm.url_filter import derived_entries, judge_urls, list_keys


def index_of(items, passage=64):
    seen, length = Counter(), 0
    parsed = [(i, *dc.question_and_answer(t)) for i, t in items]
    pieces = [p for _, q, a in parsed for p in dc.split(q + a, passage)]
    for p in pieces:
        seen.update(set(p))
        length += len(p)
    return dc.ItemIndex(parsed, (seen, len(pieces), length / len(pieces)), passage)


def test_block_max_wand_finds_all_above_the_threshold():
    draw = random.Random(1)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(4000)]
    index = index_of([(i, " ".join(draw.choices(vocabulary, k=draw.randint(5, 90)))) for i in range(150)])
    for threshold in (0.2, 0.5, 0.9):
        for _ in range(60):
            piece = draw.randrange(len(index.owner))
            own = [t for t, ds in enumerate(index.docs) if piece in ds and draw.random() < 0.8]
            terms = list(set(own + draw.choices(range(len(index.docs)), k=30)))
            scores = np.zeros(len(index.owner))
            for t in terms:
                np.add.at(scores, index.docs[t], index.weights[t])
            hits = dict(index.search(terms, threshold))
            assert set(hits) == set(np.flatnonzero(scores >= threshold).tolist())
            assert all(abs(scores[p] - s) < 1e-9 for p, s in hits.items())


def common_by_hand(a, b):
    """Length of the longest common subsequence, by the table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def aligned_by_hand(part, words):
    size = len(part) + max(len(part) // 4, 1)
    return max((common_by_hand(part, words[i : i + size]) for i in range(len(words))), default=0) / len(part)


def leaked_by_hand(text, item):
    words = dc.words_of(text)
    there = Counter(words)
    parts = [p for p in dc.question_and_answer(item) if p]
    if any(sum((Counter(p) & there).values()) < 0.8 * len(p) for p in parts):
        return False
    return all(aligned_by_hand(p, words) >= 0.8 for p in parts)


def test_alignment_equals_the_table():
    draw = random.Random(5)
    for _ in range(300):
        part, words = draw.choices("abcdef", k=draw.randint(1, 12)), draw.choices("abcdefgh", k=draw.randint(0, 40))
        want = aligned_by_hand(part, words)
        assert dc.aligned(part, words) == want
        assert dc.aligned(part, words, 0.8) == (want if want >= 0.8 else 0.0)
    assert dc.aligned([], ["a"]) == 1.0 and dc.aligned(["a"], []) == 0.0


@pytest.mark.parametrize("edits, least", [(0, 1.0), (1, 0.9), (2, 0.9)])
def test_items_with_substituted_words_are_found(sf_dir, rows, edits, least):
    items = pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()
    index, draw = index_of([(r["item_id"], r["text"]) for r in items]), random.Random(edits)
    texts = [r["text"] for r in rows if r["text"] and not any(leaked_by_hand(r["text"], i["text"]) for i in items)][:60]
    found = 0
    for n, item in enumerate(items):
        words, base = item["text"].split(), texts[n % len(texts)].split()
        for place in draw.sample(range(len(words)), edits):
            words[place] = "another"
        at = draw.randint(0, len(base))
        text = " ".join([*base[:at], *words, *base[at:]])
        found += item["item_id"] in {h["item_id"] for h in index.hits(text, dc.PASSAGE, dc.THRESHOLD, dc.OVERLAP)}
    assert found >= least * len(items)
    assert not any(index.hits(t, dc.PASSAGE, dc.THRESHOLD, dc.OVERLAP) for t in texts)


def test_very_long_texts_and_items():
    long = " ".join(f"w{i}" for i in range(3000))
    index = index_of([(1, long), (2, "one two three four five six")])
    text = "start " * 20_000 + long + " end" * 20_000 + " one two three four five six"
    assert [h["item_id"] for h in index.hits(text, dc.PASSAGE, dc.THRESHOLD, dc.OVERLAP)] == [1, 2]


@pytest.mark.parametrize("index_chars", [dc.INDEX_CHARS, 2000])
def test_leaks_equal_brute_force(spark, sf_dir, docs, rows, index_chars):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = [(r["item_id"], r["text"]) for r in items.collect()]
    want = {(r["doc_id"], i) for r in rows for i, t in texts if leaked_by_hand(r["text"], t)}
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, items, index_chars=index_chars).collect()}
    assert got == want and want
    clean = {r["doc_id"] for r in dc.without_leaks(docs, items).collect()}
    assert clean == {r["doc_id"] for r in rows} - {d for d, _ in want}


def test_leaks_in_odd_tables(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "one two three four five"), (1, "one two three four five"), (2, None), (3, ""), (None, "no words here at all"), (4, "alpha beta gamma delta " * 60)],
        "item_id long, text string",
    )
    hits = sorted((r["doc_id"] or -1, r["item_id"]) for r in dc.contaminated(odd, items).collect())
    assert hits == [(-1, 1), (4, 4), (5, 1), (6, 1), (6, 1), (8, 1)]
    assert dc.without_leaks(odd, items).columns == odd.columns
    assert dc.contaminated(none, items).count() == 0
    assert dc.contaminated(odd, items.limit(0)).count() == 0
    asked = spark.createDataFrame([(9, "one two three", "four five"), (8, "one two three", "something else")], "item_id long, question string, answer string")
    assert {r["item_id"] for r in dc.contaminated(odd, asked).collect()} == {9}


BASE = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def base_by_hand(text):
    spans = [(m.start(), k, m.end(), n) for k, (n, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(spans))


def test_secrets(spark, docs, rows, odd, none):
    tricky = [
        "token=secret=abcdefgh", "token=token :abcdefgh", "é😀 API_KEY = 'abc.def=' password: short", "AKIAAKIA" + "Z" * 30 + " AKIAshort",
        "x" + "0123456789abcdef" * 2 + "g", "aPiKeY:=x Passwd\"  :  \"longvalue", "secret = ", "token=abc token=abcdef",
    ]
    table = spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string")
    for df in (table, docs, odd):
        texts = sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)
        got = sorted(((r["doc_id"], r["spans"]) for r in secrets(df).select("doc_id", listed(F.col("base")).alias("spans")).collect()), key=repr)
        assert got == sorted(((i, base_by_hand(t)) for i, t in texts), key=repr)
    assert secrets(none).count() == 0


def test_random_strings_are_told_from_words(spark, rows):
    draw = random.Random(3)
    made = [base64.b64encode(draw.randbytes(30)).decode().rstrip("=").replace("+", "x") for _ in range(40)]
    words = ["anotherverylongcompoundword2024", "somethingsomethingsomething1", "aaaaaaaaaaaaaaaa1111111111111111", "abcabcabcabcabcabcabcabc123123123"]
    table = spark.createDataFrame([(i, f"see {s} there") for i, s in enumerate(made + words)] + [(100 + r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    found = {r["doc_id"]: [s["found"] for s in r["random"]] for r in secrets(table).collect()}
    assert sum(found[i] == [s] for i, s in enumerate(made)) >= 36
    assert not any(found[i] for i in range(len(made), len(made) + len(words)))
    assert not any(f for i, f in found.items() if i >= 100)


def test_battery_level(spark):
    draw = random.Random(4)
    strings = ["".join(draw.choices("0123456789abcdef", k=40)) for _ in range(1500)]
    places = F.transform(F.split("s", ""), lambda c: F.position(c, F.lit(ENCODINGS["hex"])).cast("double") - 1)
    low = spark.createDataFrame([(s,) for s in strings], "s string").select(battery(places, 16).alias("p")).where("p < 0.05").count()
    assert low / 1500 < 0.08


def keys_by_hand(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)[^/?#]*(?:/([^?#]*))?", url or "")
    if not m:
        return []
    host, segments = m[1].lower(), [s for s in (m[2] or "").split("/") if s]
    labels = host.split(".")
    return ["/".join([host, *segments[:i]]) for i in range(len(segments), 0, -1)] + [".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))]


URLS = ["HTTP://User@A.B.Example.com:80/x//y/?q#f", "https://b.example.com", "ftp://localhost/z", "no scheme", "", None, "https://a.b.example.com/x/y", "http://"]


def test_list_keys(spark):
    out = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", list_keys(F.col("u")).alias("k")).collect()
    assert [r["k"] for r in out] == [keys_by_hand(u) for u in URLS]


@pytest.mark.parametrize("seed", [1, 2])
def test_entries_active_on_the_day_decide(spark, seed):
    draw, day = random.Random(seed), lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    keys = sorted({k for u in URLS for k in keys_by_hand(u)})
    entries = [(draw.choice([*keys, None]), day(draw.randrange(200)), draw.choice(["block", "allow", "remove"]), draw.choice("ab")) for _ in range(60)]
    entries += [(keys[0], None, "block", "a")]
    captures = [(draw.choice(URLS), None if draw.random() < 0.05 else day(draw.randrange(220)), "own", i % 7) for i in range(300)]
    list_df = spark.createDataFrame(entries, "key string, day date, action string, category string")
    pages = spark.createDataFrame(captures, "url string, day date, action string, _pair int")
    out = judge_urls(pages, list_df)
    assert out.columns == ["url", "day", "_pair", "blocked", "matched_key", "action", "category", "since"]

    def by_hand(url, when):
        for key in keys_by_hand(url) if when else []:
            own = [(d, a, c) for k, d, a, c in entries if k == key and d is not None and d <= when]
            if own and max(own)[1] != "remove":
                d, a, c = max(own)
                return a == "block", key, a, c, d
        return False, None, None, None, None

    want = sorted(((u, d, n, *by_hand(u, d)) for u, d, _, n in captures), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert judge_urls(pages.limit(0), list_df).count() == 0
    assert judge_urls(pages, list_df.limit(0)).where("blocked").count() == 0
    assert derived_entries(pages).where("day is null").count() == 0


def test_a_capture_far_off_changes_nothing_else(spark):
    day = datetime.date
    keys = [f"h{n}.example.com" for n in range(400)]
    entries = spark.createDataFrame([(k, day(2024, 1, 1 + n % 28), "block", "a") for n, k in enumerate(keys)], "key string, day date, action string, category string")
    rows = [(f"https://{k}/x", day(2024, 1, 15)) for k in keys]
    far = [("https://h1.example.com/x", day(9999, 12, 31)), ("https://h1.example.com/x", day(1, 1, 1))]
    judged = lambda r: sorted(tuple(x) for x in judge_urls(spark.createDataFrame(r, "url string, day date"), entries).collect())
    with_far = judged(rows + far)
    assert [x for x in with_far if x[1].year == 2024] == judged(rows)
    assert sorted((x[1].year, x[2]) for x in with_far if x[1].year != 2024) == [(1, False), (9999, True)]
    assert sum(x[2] for x in judged(rows)) == sum(1 + n % 28 <= 15 for n in range(400))
