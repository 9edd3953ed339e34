"""URL filters in time: a capture is judged by the list entries in force when it was fetched.

Dated list entries (add or remove a key, from a day on) become validity
intervals: of the entries of one list and key on one day a removal loses
against an addition, entries that change nothing are dropped, and each addition
is valid until the next removal. A key is a host or, with scope ``domain``, a
host and everything below it.

The as-of join is keyed by host and stretch of time. Every interval is laid out
over the stretches of ``STRETCH`` days that it touches, within the time of the
captures, and every pair of a host and a stretch that captures have meets the
entries of its own name and of the domains above it. That gives one row per host
and stretch, with at most one interval for each two days, list and domain: no
row grows with the table, however many captures or changes a host has. Captures
join it on both and keep the intervals that hold their fetch time. Their side
may be skewed at will (adaptive execution splits it); the other has one row per
key. DataFrame functions only.

Defined cases: a url that is null or has no host matches nothing; a capture
without time matches nothing; an entry without key, list or day is ignored;
hosts compare in lower case and without a final dot; an IPv6 address in brackets
is a host without domains above it; repeated captures give repeated rows; no
captures give no rows, and without entries nothing is blocked; the columns of
the captures are kept whatever their names.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import fresh

#: Scheme, optional user, host: the host, an address in brackets included, is the group.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]+\]|[^/?#:]+)"
#: Days of a stretch of time.
STRETCH = 32


def url_host(url: Column) -> Column:
    """The lower-case host of a url, null where there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")
    return F.when(host != "", host)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, scope, key, valid_from, valid_to) from dated entries (list, scope, key, action, day).

    ``action`` is ``add`` or ``remove``; ``valid_to`` is the first day on which
    the entry no longer holds, null while it still does.
    """
    same = ["list", "scope", "key"]
    daily = (
        entries.filter("list IS NOT NULL AND scope IS NOT NULL AND key IS NOT NULL AND day IS NOT NULL")
        .withColumn("key", F.lower("key"))
        .groupBy(*same, "day")
        .agg(F.max(F.col("action") == "add").alias("on"))
    )
    by_day = Window.partitionBy(*same).orderBy("day")
    changes = daily.withColumn("was", F.coalesce(F.lag("on").over(by_day), F.lit(False))).filter(
        F.col("on") != F.col("was")
    )
    return (
        changes.withColumn("valid_to", F.lead("day").over(by_day))
        .filter("on")
        .select(*same, F.col("day").alias("valid_from"), "valid_to")
    )


def stretch(day: Column) -> Column:
    """The number of the stretch of time that a day lies in."""
    return F.floor(F.unix_date(day) / STRETCH).cast("int")


def laid_out(intervals: DataFrame, first: date, last: date) -> DataFrame:
    """The intervals once for each stretch that they touch from ``first`` to ``last``."""
    start = F.greatest("valid_from", F.lit(first))
    end = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), F.lit(last))
    touched = F.explode(F.sequence(stretch(start), stretch(end)))
    return intervals.filter(start <= end).select("*", touched.alias("stretch"))


def host_intervals(hosts: DataFrame, intervals: DataFrame) -> DataFrame:
    """Per host and stretch the intervals of its own name and of the domains above it, as one array.

    ``hosts`` has the hosts and stretches that are asked for, ``intervals`` those laid out.
    """
    labels = F.when(F.col("host").startswith("["), F.array("host")).otherwise(F.split("host", r"\."))
    depth = F.size(labels)
    above = F.transform(
        F.sequence(F.lit(1), depth),
        lambda i: F.struct(
            F.array_join(F.slice(labels, i, depth - i + 1), ".").alias("key"), (i == 1).alias("own")
        ),
    )
    names = hosts.select("host", "stretch", F.inline(above))
    held = names.join(intervals, ["key", "stretch"]).filter("own OR scope = 'domain'")
    entry = F.struct("valid_from", "valid_to", "list", "scope", "key")
    return held.groupBy("host", "stretch").agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def filter_captures(
    captures: DataFrame, entries: DataFrame, url: str = "url", fetched_on: str = "fetched_on"
) -> DataFrame:
    """The captures with ``host``, ``active`` (entries in force, as an array) and ``blocked``.

    Where the captures already have such columns, the new ones get a leading
    underscore.
    """
    host, active, blocked = (fresh(captures, name) for name in ("host", "active", "blocked"))
    known, then, held = (fresh(captures, name) for name in ("known_host", "known_stretch", "entries"))
    day = F.col(fetched_on).cast("date")
    named = captures.withColumn(host, url_host(F.col(url)))
    asked = named.select(F.col(host).alias("host"), stretch(day).alias("stretch")).dropna().distinct()
    first, last = captures.agg(F.min(day), F.max(day)).first()
    never = date(1970, 1, 1)
    spread = laid_out(validity_intervals(entries), first or never, last or never)
    intervals = host_intervals(asked, spread).select(
        F.col("host").alias(known), F.col("stretch").alias(then), F.col("entries").alias(held)
    )
    none = F.array().cast(intervals.schema[held].dataType)
    in_force = F.filter(
        F.coalesce(held, none),
        lambda e: (e["valid_from"] <= day) & (e["valid_to"].isNull() | (day < e["valid_to"])),
    )
    return (
        named.join(intervals, (F.col(host) == F.col(known)) & (stretch(day) == F.col(then)), "left")
        .withColumn(active, F.coalesce(in_force, none))
        .drop(known, then, held)
        .withColumn(blocked, F.size(active) > 0)
    )
