"""Sums over the last hours of a key, row by row, safe for hot keys.

A plain range frame over ``partitionBy(key)`` puts the whole history of a key
into one task. Here time is cut into buckets; the frame of a row consists of

1. the rows of its own bucket up to it, by a window inside the bucket;
2. the whole buckets between, from a table of one row per key and bucket;
3. the end of the oldest bucket: its rows are copied into the bucket that they
   reach into, moved by the length of the frame, and summed up from the far side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SECOND = 1_000_000


def _total(parts: list[Column]) -> Column:
    """The sum of what is known, null if nothing is."""
    known = F.coalesce(*parts)
    zero = [F.coalesce(p, F.lit(0)) for p in parts]
    return F.when(known.isNotNull(), zero[0] + zero[1] + zero[2])


def rolling_sums(df: DataFrame, keys: list[str], ts: str, sums: dict[str, str], hours: int = 24, bucket_hours: int = 1) -> DataFrame:
    """All rows with a column per entry of ``sums`` (new name: column), its sum over the key's last ``hours``.

    The frame is that of SQL's ``range between interval hours preceding and
    current row``: both ends count, rows of the same time count, nulls do not,
    and a frame of nulls alone has a null. Rows without a key or a time have
    nulls. New names may not be columns already. A task's window holds two buckets of
    one key; sums of whole numbers and decimals are exact.
    """
    if hours % bucket_hours:
        raise ValueError("hours must be a multiple of bucket_hours")
    if taken := {n.lower() for n in sums} & {c.lower() for c in df.columns}:
        raise ValueError(f"the table has columns of these names already: {sorted(taken)}")
    width, step, parts = hours * 3600 * _SECOND, bucket_hours * 3600 * _SECOND, hours // bucket_hours
    complete = F.col(ts).isNotNull()
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    at = F.unix_micros(ts)
    values = {n: f"_value_{i}" for i, n in enumerate(sums)}
    own = df.filter(complete).withColumns({"_at": at, "_bucket": F.expr(f"_at div {step} - int(_at % {step} < 0)"), "_own": F.lit(True), **{v: F.col(sums[n]) for n, v in values.items()}})
    reach = own.select(*keys, (F.col("_at") + width).alias("_at"), (F.col("_bucket") + parts).alias("_bucket"), F.lit(False).alias("_own"), *values.values())
    rows = own.unionByName(reach, allowMissingColumns=True)

    bucket = Window.partitionBy(*keys, "_bucket")
    until = bucket.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    since = bucket.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"{v}_own": F.sum(F.when(F.col("_own"), F.col(v))).over(until) for v in values.values()})
    rows = rows.withColumns({f"{v}_old": F.sum(F.when(~F.col("_own"), F.col(v))).over(since) for v in values.values()}).filter("_own")

    whole = own.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(v) for v in values.values()])
    between = Window.partitionBy(*keys).orderBy("_bucket").rangeBetween(1 - parts, -1)
    middle = whole.select(*keys, "_bucket", *[(F.sum(v).over(between) if parts > 1 else F.lit(None).cast(whole.schema[v].dataType)).alias(f"{v}_mid") for v in values.values()])
    found = rows.join(middle, [*keys, "_bucket"]).select(
        *[F.col(f"`{c}`") for c in df.columns], *[_total([F.col(f"{v}_{p}") for p in ("own", "mid", "old")]).alias(n) for n, v in values.items()]
    )
    return found.unionByName(df.filter(~complete), allowMissingColumns=True)
