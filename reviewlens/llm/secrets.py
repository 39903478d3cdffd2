"""Secrets: fixed patterns, and a battery of randomness tests for strings that no pattern names.

All in SQL functions on the row: nothing is exploded but the counts of letters and of evidence.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions.arrays import let
from reviewlens.llm.common import text_or_empty
from reviewlens.session import stored

#: kind -> (pattern, group that is measured, least length of the group), in the order ties are listed.
KINDS = {
    "assign": (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),  # a shorter run holds no match either
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Alphabets from narrow to wide; a string has the first that holds all its characters.
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
#: Shares of the letters a to z in English prose, in percent; a few letters in a hundred are capitals.
LETTERS = [
    8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074,
]
CAPITALS, PRIOR_LETTERS = 0.03, 10_000
#: Share of prose that may be any symbol, level of the battery, and false discovery rate.
ODD_SHARE, ALPHA, RATE = 0.02, 0.001, 0.01
MAX_EVIDENCE = 600


def spans_of(text: Column, pattern: str, group: int, least: int) -> Column:
    """``array<struct<start, end, found>>`` of the leftmost non-overlapping matches whose group is long enough.

    Positions are code points, the end is exclusive. The texts between matches give the positions.
    """
    none = F.array().cast("array<struct<start: int, end: int, found: string>>")
    start = lambda acc, x: acc["at"] + x["gap"]

    def step(acc: Column, x: Column) -> Column:
        end = start(acc, x) + F.length(x["found"])
        span = F.struct(start(acc, x).alias("start"), end.alias("end"), x["found"].alias("found"))
        return F.struct(
            end.alias("at"), F.when(x["size"] >= least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans")
        )

    def fold(found: Column, groups: Column, gaps: Column) -> Column:
        items = F.transform(
            found,
            lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), m.alias("found"), F.length(F.get(groups, i)).alias("size")),
        )
        begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        return F.aggregate(items, begin, step, lambda acc: acc["spans"])

    every = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    spans = let(every(0), lambda m: let(every(group), lambda g: let(F.split(text, pattern, -1), lambda p: fold(m, g, p))))
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(none)


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal for ``z >= 0`` by a rational approximation (error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * z)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series


def battery(indices: Column, k: int) -> Column:
    """p-value of "uniform over ``k`` symbols": the least of three tests, times three.

    ``indices`` are the places in the alphabet. Chi-squared is standardized by its exact moments, as short
    strings need; runs are those above and below the middle of the alphabet; the serial correlation is that of neighbours.
    """
    mean = lambda xs, n: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / n

    def tests(xs: Column, n: Column) -> Column:
        ordered = F.array_sort(xs)
        # Neighbours in sorted order tell how often each symbol occurs: sum of O*(O-1) by runs of equal ones.
        equal = F.aggregate(
            ordered,
            F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("same"), F.lit(0.0).alias("sum")),
            lambda a, x: F.struct(
                x.alias("last"),
                F.when(x == a["last"], a["same"] + 1).otherwise(0.0).alias("same"),
                (a["sum"] + F.when(x == a["last"], 2 * (a["same"] + 1)).otherwise(0.0)).alias("sum"),
            ),
            lambda a: a["sum"],
        )
        expected, variance = n * (n - 1) / k, 2 * n * (n - 1) / k * (1 - 1 / k)
        chi = (equal - expected) / F.sqrt(variance)
        high = F.transform(xs, lambda x: (x >= k / 2).cast("double"))
        ones = mean(high, F.lit(1.0))
        turns = F.aggregate(
            high, F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("n")),
            lambda a, x: F.struct(x.alias("last"), (a["n"] + (x != a["last"]).cast("double")).alias("n")), lambda a: a["n"],
        )
        cross = 2 * ones * (n - ones)
        runs_variance = cross * (cross - n) / (n * n * (n - 1))
        runs = F.when(runs_variance > 0, F.abs(turns - cross / n - 1) / F.sqrt(runs_variance)).otherwise(F.lit(40.0))

        def serial(m: Column) -> Column:
            sums = F.aggregate(
                xs, F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx")),
                lambda a, x: F.struct(
                    (x - m).alias("last"), (a["xy"] + F.coalesce(a["last"], F.lit(0.0)) * (x - m)).alias("xy"), (a["xx"] + (x - m) * (x - m)).alias("xx"),
                ),
            )
            return let(sums, lambda s: F.when(s["xx"] > 0, F.abs(s["xy"] / s["xx"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(40.0)))

        neighbours = let(mean(xs, n), lambda m: 2 * normal_tail(serial(m)))
        tails = [normal_tail(F.greatest(chi, F.lit(0.0))), 2 * normal_tail(runs), neighbours]
        return F.least(F.lit(1.0), 3 * F.least(*tails))

    return let(indices, lambda xs: let(F.size(xs).cast("double"), lambda n: tests(xs, n)))


def judge(token: Column, prose: dict[str, float]) -> Column:
    """``struct<encoding, evidence, p>`` of a string.

    ``evidence`` is the log likelihood ratio of its alphabet, used evenly, to prose. Its exponential has
    mean 1 over prose of any length, so it is an e-value against "this is prose".
    """
    costs = F.create_map(*[F.lit(x) for s, share in prose.items() for x in (s, math.log(share))])
    mixed = F.regexp_like(token, F.lit("[0-9]")) & F.regexp_like(token, F.lit("[A-Za-z]"))
    choice = F.lit(None).cast("struct<encoding: string, evidence: double, p: double>")
    for name, alphabet in reversed(ENCODINGS.items()):
        k = len(alphabet)
        chars = F.split(token, "")
        places = F.transform(chars, lambda c: F.position(c, F.lit(alphabet)).cast("double") - 1)  # noqa: B023
        surprise = F.aggregate(chars, F.lit(0.0), lambda a, c: a - F.element_at(costs, c) - math.log(k))  # noqa: B023
        found = F.struct(F.lit(name).alias("encoding"), surprise.alias("evidence"), battery(places, k).alias("p"))
        whole = f"^[{alphabet.replace('-', '')}{'-' * ('-' in alphabet)}]+$"
        choice = F.when(mixed & F.regexp_like(token, F.lit(whole)), found).otherwise(choice)
    return choice


def letter_shares(found: DataFrame) -> dict[str, float]:
    """Shares of ``SYMBOLS`` in prose; ``ODD_SHARE`` is spread evenly.

    Counted in all long strings of letters only, on top of ``PRIOR_LETTERS`` letters of English.
    """
    words = found.select(F.explode("candidates.found").alias("w")).where(~F.regexp_like("w", F.lit("[^A-Za-z]")))
    counts = {r["c"]: r["count"] for r in words.select(F.explode(F.split("w", "")).alias("c")).groupBy("c").count().collect()}
    for i, share in enumerate(LETTERS):
        for letter, part in ((chr(65 + i), CAPITALS), (chr(97 + i), 1 - CAPITALS)):
            counts[letter] = counts.get(letter, 0) + PRIOR_LETTERS * part * share / sum(LETTERS)
    total, even = sum(counts.values()), 1 / len(SYMBOLS)
    return {s: (1 - ODD_SHARE) * counts.get(s, 0) / total + ODD_SHARE * even for s in SYMBOLS}


def discoveries(found: DataFrame, rate: float) -> dict[str, int]:
    """Least evidence, in tenths, that counts per stratum: e-values under the step-up rule at ``rate``.

    A stratum is an encoding and a length up to the next power of two, so many short strings do not set
    the bar for long ones. The rule needs counts per tenth only, at most ``MAX_EVIDENCE`` per stratum.
    """
    each = found.select(F.explode("candidates").alias("c")).select("c.*").where("stratum is not null")
    counts = each.groupBy("stratum", "tenths").agg(F.count("*").alias("n")).collect()
    bars: dict[str, int] = {}
    for stratum in {r["stratum"] for r in counts}:
        own = sorted(((r["tenths"], r["n"]) for r in counts if r["stratum"] == stratum), reverse=True)
        tried, above = sum(n for _, n in own), 0
        for tenths, n in own:
            above += n
            if tenths / 10 >= math.log(tried / (rate * above)):
                bars[stratum] = tenths
    return bars


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE, alpha: float = ALPHA) -> DataFrame:
    """``(doc_id, base, random)`` for every row: arrays of ``struct<start, order, end, kind, found>``, by start.

    ``base`` holds the matches of ``KINDS``. ``random`` holds strings that mix digits and letters, overlap no
    match, pass the battery for their alphabet at level ``alpha``, and count as discoveries at ``rate``.
    Null and empty texts have none; repeated rows are rows of their own; other columns are not read.
    """
    text = text_or_empty(F.col(text_col))
    columns = [spans_of(F.col("_text"), p, g, n).alias(kind) for kind, (p, g, n) in KINDS.items()]
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    rows = stored(rows.select("doc_id", *columns, spans_of(F.col("_text"), CANDIDATE, 0, 1).alias("candidates")), "spans")
    prose = letter_shares(rows)

    def base_span(kind: str, order: int) -> Column:
        make = lambda s: F.struct(s["start"], F.lit(order).alias("order"), s["end"], F.lit(kind).alias("kind"), s["found"])
        return F.transform(kind, make)

    base = F.array_sort(F.concat(*[base_span(kind, i) for i, kind in enumerate(KINDS)]))
    free = lambda b, c: ~F.exists(b, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    tenths = lambda j: F.least(F.floor(j["evidence"] * 10), F.lit(MAX_EVIDENCE)).cast("int")
    length = lambda c: F.ceil(F.log2((c["end"] - c["start"]).cast("double"))).cast("string")

    def weigh(c: Column) -> Column:
        def with_result(j: Column) -> Column:
            ok = (j["p"] >= alpha) & (j["evidence"] > 0)
            return F.struct(
                c["start"], c["end"], c["found"], F.when(ok, tenths(j)).alias("tenths"),
                F.when(j.isNotNull(), F.concat_ws("/", j["encoding"], length(c))).alias("stratum"),
            )

        return let(judge(c["found"], prose), with_result)

    rows = rows.select("doc_id", base.alias("base"), "candidates")
    weighed = F.transform(F.filter("candidates", lambda c: free(F.col("base"), c)), weigh)
    rows = stored(rows.select("doc_id", "base", weighed.alias("candidates")), "evidence")
    bars = discoveries(rows.select(F.transform("candidates", _zero_if_rejected).alias("candidates")), rate)
    table = F.create_map(*[F.lit(x) for pair in bars.items() for x in pair]) if bars else F.lit(None).cast("map<string, int>")
    chosen = F.filter("candidates", lambda c: F.coalesce(c["tenths"] >= F.try_element_at(table, c["stratum"]), F.lit(False)))
    last = F.lit(len(KINDS)).alias("order")
    random = F.transform(chosen, lambda c: F.struct(c["start"], last, c["end"], F.lit("random").alias("kind"), c["found"]))
    return rows.select("doc_id", "base", random.alias("random"))


def _zero_if_rejected(c: Column) -> Column:
    return F.struct(c["stratum"].alias("stratum"), F.coalesce(c["tenths"], F.lit(0)).alias("tenths"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
