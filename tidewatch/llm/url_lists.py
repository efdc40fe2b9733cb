"""URL filters: dated list entries as validity intervals, and an as-of join with captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of history per join key; an interval is copied to every span that it touches.
SPAN_DAYS = 32


def url_host(url: Column) -> Column:
    """Lower-cased host without user, port and a last dot; null where the URL has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def url_path(url: Column) -> Column:
    """Path without query and fragment; ``/`` where it is empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def patterns_of(url: Column) -> Column:
    """Everything on a list that covers a URL, from the most to the least specific.

    These are the host with each prefix of the path that ends before a slash
    (``host/a/b``, ``host/a``), the host, and every parent domain of it with at
    least two labels. A URL without a host is covered by nothing.
    """
    host = url_host(url)
    steps = F.filter(F.split(url_path(url), "/"), lambda s: s != "")
    paths = F.transform(
        F.reverse(F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1)))),
        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, n), "/")),
    )
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."),
    )
    every = F.concat(F.when(F.size(steps) > 0, paths).otherwise(F.expr("cast(array() AS array<string>)")), parents)
    return F.when(host.isNull(), F.expr("cast(array() AS array<string>)")).otherwise(every)


def validity(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to) from dated entries (pattern, action, dated).

    An entry holds from the start of its day to the day of the pattern's next
    entry, the last one for ever (null). Of several entries of one pattern and
    day ``block`` wins over ``allow`` and both over ``remove``, which ends what
    was before. Entries without pattern, date or known action are ignored;
    patterns are compared in lower case without a last slash.
    """
    strength = F.when(F.col("action") == "block", 3).when(F.col("action") == "allow", 2).when(F.col("action") == "remove", 1)
    daily = (
        entries.select(F.regexp_replace(F.lower("pattern"), "/+$", "").alias("pattern"), F.col("dated").cast("date").alias("day"), strength.alias("strength"))
        .where("pattern <> '' AND day IS NOT NULL AND strength IS NOT NULL")
        .groupBy("pattern", "day")
        .agg(F.max("strength").alias("strength"))
    )
    following = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    intervals = daily.select("pattern", "strength", F.col("day").alias("valid_from"), following.alias("valid_to")).where("strength > 1")
    return intervals.select("pattern", F.when(F.col("strength") == 3, "block").otherwise("allow").alias("action"), "valid_from", "valid_to")


def filter_captures(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """One row per capture: key, url, fetched_at, matched_pattern, action, listed_since, blocked.

    Of the entries active on the day of the fetch that cover the URL the most
    specific decides: the longest path, then the longest domain. Without one
    the pattern, action and date are null and the capture is not blocked; so it
    is without a URL, a host or a time. Every input row gives one row, repeated
    rows included.

    Captures and intervals meet on pattern and span of ``SPAN_DAYS`` days. A
    pattern has one interval a day at most, so a capture is compared with at
    most one interval per day of its span; all captures of a busy host are
    first reduced to one row per list of patterns and day, and the shuffle
    joins can split the rest.
    """
    urls = captures.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.col(fetched).cast("timestamp").alias("at"), patterns_of(F.lower(F.col(url))).alias("patterns")
    ).withColumn("day", F.to_date("at"))
    asked = urls.select("patterns", "day").where("day IS NOT NULL AND size(patterns) > 0").distinct()
    span = F.floor(F.datediff("day", F.lit("1970-01-01").cast("date")) / SPAN_DAYS)
    each = asked.select("patterns", "day", span.alias("span"), F.posexplode("patterns").alias("rank", "pattern"))

    intervals = validity(entries)
    first, last = asked.select(F.min("day").alias("first"), F.max("day").alias("last")).first()
    if first is None:
        first = last = intervals.sparkSession.sql("SELECT current_date()").first()[0]
    low, high = F.lit(first), F.lit(last)
    number = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / SPAN_DAYS)
    # Only spans in which something was fetched; an open interval reaches to the last of them.
    seen = intervals.where((F.col("valid_from") <= high) & (F.col("valid_to").isNull() | (F.col("valid_to") > low)))
    ends = F.least(F.coalesce(F.date_sub("valid_to", 1), high), high)
    spread = seen.withColumn("span", F.explode(F.sequence(number(F.greatest(F.col("valid_from"), low)), number(ends))))

    active = each.join(spread, ["pattern", "span"]).where("valid_from <= day AND (valid_to IS NULL OR day < valid_to)")
    decided = active.groupBy("patterns", "day").agg(F.min(F.struct("rank", "pattern", "action", "valid_from")).alias("hit"))
    return urls.join(decided, ["patterns", "day"], "left").select(
        F.col("key").alias(key),
        F.col("url").alias(url),
        F.col("at").alias(fetched),
        F.col("hit.pattern").alias("matched_pattern"),
        F.col("hit.action").alias("action"),
        F.col("hit.valid_from").alias("listed_since"),
        F.coalesce(F.col("hit.action") == "block", F.lit(False)).alias("blocked"),
    )
