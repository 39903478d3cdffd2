"""URL filters over time: dated list entries become validity intervals, and captures meet those of their day.

Everything is joins and groupings on distinct values: an address is looked up once per day, however
often it was captured, and a host once per day, however many addresses it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.functions.arrays import let
from reviewlens.operators.joins import salted_lookup

HOST = r"^(?i:[a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[^/?#]*//[^/?#]*/([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of an address with a scheme, empty if there is none."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def list_keys(url: Column) -> Column:
    """Keys a list may name, most specific first: path prefixes by whole segments, the host, its parents.

    A host counts as ``a.b.c``, ``b.c``; single labels are no keys but for a host that is one.
    """

    def keys(host: Column) -> Column:
        labels = F.split(host, r"\.")
        parents = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )
        parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
        prefixes = let(
            parts,
            lambda p: F.transform(
                F.filter(F.reverse(F.sequence(F.lit(0), F.size(p))), lambda i: i > 0),
                lambda i: F.concat_ws("/", host, F.array_join(F.slice(p, F.lit(1), i), "/")),
            ),
        )
        return F.concat(prefixes, parents)

    return F.when(host_of(url) != "", let(host_of(url), keys)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``(key, since, until, action, category)`` from dated ``(key, day, action, category)``.

    An entry holds until the next one for its key; ``until`` is exclusive and null for the last. ``remove``
    ends an entry and leaves none. Of entries for a key on one day the largest ``(action, category)`` counts, so a
    key has at most one row per day of the calendar. Entries without key or day do not count.
    """
    daily = entries.where("key is not null and day is not null").groupBy("key", "day").agg(
        F.max(F.struct("action", "category")).alias("_e")
    )
    until = F.lead("day").over(Window.partitionBy("key").orderBy("day"))
    rows = daily.select("key", F.col("day").alias("since"), until.alias("until"), "_e.action", "_e.category")
    return rows.where("action <> 'remove'")


def active_on(wanted: DataFrame, valid: DataFrame) -> DataFrame:
    """As-of join: rows of ``wanted`` (``key``, ``day``, ...) with the interval of ``valid`` that holds that day.

    Both sides in the order of the days, each day takes the last interval that has begun, if that has not ended. Rows of
    ``wanted`` must be distinct by key and day: then a key has at most two rows per day of the calendar, however often it is
    captured, and a date far off adds one row.
    """
    begun = valid.select("key", F.col("since").alias("day"), F.lit(0).alias("_turn"), F.struct("since", "until", "action", "category").alias("_own"))
    both = wanted.withColumn("_turn", F.lit(1)).unionByName(begun, allowMissingColumns=True)
    so_far = Window.partitionBy("key").orderBy("day", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_entry", F.last("_own", ignorenulls=True).over(so_far)).where("_turn = 1 and _entry is not null")
    found = found.where("_entry.until is null or day < _entry.until")
    return found.select(*wanted.columns, "_entry.since", "_entry.action", "_entry.category")


def judge_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "day") -> DataFrame:
    """``captures`` with ``blocked``, ``matched_key``, ``action``, ``category`` and ``since`` of the entry that decides.

    Of the entries active on the day of the capture the one with the most specific key decides. An address
    without a scheme or host, a null address and a null day match nothing and are not blocked. Every
    row of ``captures`` returns once, repeated rows included, with its own columns but for those that are added.
    """
    day, url = F.col(f"`{day_col}`").cast("date"), F.col(f"`{url_col}`")
    pair = F.concat_ws(" ", day.cast("string"), url)
    added = ["blocked", "matched_key", "action", "category", "since"]
    own = F.struct(*[F.col(f"`{c}`") for c in captures.columns if c not in added]).alias("_row")
    pair = F.when(day.isNotNull() & url.isNotNull(), pair)
    pairs = captures.select(pair.alias("_pair"), url.alias("_url"), day.alias("day")).where("_pair is not null")
    pairs = pairs.groupBy("_pair", "_url", "day").agg(F.count("*").alias("_n"))
    rows = captures.select(pair.alias("_pair"), own)
    keyed = pairs.select("_pair", "_n", "day", F.posexplode(list_keys(F.col("_url"))).alias("_rank", "key"))
    keyed = keyed.withColumn("_lookup", F.concat_ws(" ", F.col("day").cast("string"), "key"))
    wanted = keyed.groupBy("key", "day", "_lookup").agg(F.count("*").alias("_uses"))
    active = active_on(wanted, intervals(entries)).drop("day").withColumnRenamed("key", "_key")
    met = salted_lookup(keyed.select("_pair", "_n", "_rank", "_lookup"), active, "_lookup", "_uses").where("_key is not null")
    entry = F.struct("_rank", F.col("_key").alias("matched_key"), "action", "category", "since")
    best = met.groupBy("_pair").agg(F.min(entry).alias("_best"), F.first("_n").alias("_n"))
    judged = salted_lookup(rows, best, "_pair", "_n")
    return judged.select(
        "_row.*", F.coalesce(F.col("_best.action") == "block", F.lit(False)).alias("blocked"),
        "_best.matched_key", "_best.action", "_best.category", "_best.since",
    )


def derived_entries(urls: DataFrame, first_day: str = "2024-01-01") -> DataFrame:
    """A dated list made from the addresses themselves, for tables that come without one.

    The hash of a key says whether it is listed, since when, as what, and whether it is taken off and put
    back later.
    """
    keys = urls.select(F.explode(list_keys(F.col("url"))).alias("key")).distinct()
    keys = keys.withColumn("n", F.conv(F.substring(F.md5(F.col("key")), 1, 7), 16, 10).cast("long")).where("n % 5 = 0")
    listed = F.floor(F.col("n") / 5) % 200
    event = lambda day, action: F.struct(day.cast("int").alias("offset"), action.alias("action"))
    action = F.when(F.col("n") % 3 == 0, F.lit("allow")).otherwise(F.lit("block"))
    events = F.array(
        event(listed, action),
        F.when(F.floor(F.col("n") / 15) % 2 == 0, event(listed + 30 + F.col("n") % 50, F.lit("remove"))),
        F.when(F.floor(F.col("n") / 30) % 2 == 0, event(listed + 120, F.lit("block"))),
    )
    rows = keys.select("key", "n", F.explode(F.array_compact(events)).alias("e"))
    day = F.date_add(F.lit(first_day).cast("date"), F.col("e.offset"))
    return rows.select("key", day.alias("day"), "e.action", F.concat(F.lit("c"), (F.col("n") % 4).cast("string")).alias("category"))
