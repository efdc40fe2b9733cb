"""Previous and next row of a keyed time series, safe for hot keys.

A plain ``lag`` over ``partitionBy(key)`` puts the whole history of a key into
one task. Here a key's history is cut into time buckets (hours by default):

1. inside a bucket an ordinary window finds the neighbour, on an exchange by
   (key, bucket);
2. each bucket is reduced to its edge row with a partial hash aggregate, and a
   window over that small table finds the edge of the nearest other bucket;
3. rows at a bucket's edge take their neighbour from there, by a join on the
   same (key, bucket) the window has already shuffled by.

So one task holds at most one hour of one key, plus one row per hour of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stand-ins for null keys, so that null groups with null in the join as well.
_NULL_TEXT = "\u0000"
_NULL_LONG = -(2**63)


def _hide_nulls(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(key), F.lit(_NULL_TEXT))
    return F.coalesce(F.col(key).cast("long"), F.lit(_NULL_LONG).cast("long"))


def _show_nulls(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    stand_in = F.lit(_NULL_TEXT) if isinstance(kind, T.StringType) else F.lit(_NULL_LONG).cast("long")
    return F.nullif(F.col(key), stand_in).cast(kind)


def with_neighbour(
    df: DataFrame,
    keys: list[str],
    ts: str,
    values: list[str],
    *,
    prefix: str,
    direction: str = "previous",
    only: Column | None = None,
    bucket: str = "hour",
) -> DataFrame:
    """Add ``<prefix><ts>`` and ``<prefix><value>`` of the neighbouring row.

    ``(keys, ts)`` identifies a row and ``ts`` is not null. ``only`` limits which
    rows count as a neighbour (all rows still get one). ``<prefix><ts>`` is null
    exactly when there is no neighbour.
    """
    if direction not in ("previous", "next"):
        raise ValueError(f"direction must be 'previous' or 'next', not {direction!r}")
    backward = direction == "previous"
    names = [ts, *values]
    counts = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    work = df.withColumns({k: _hide_nulls(df, k) for k in keys}).withColumn("_bucket", F.date_trunc(bucket, ts))

    # 1. Neighbour inside the bucket.
    order = F.col(ts).asc() if backward else F.col(ts).desc()
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    if only is None:
        near = {f"_in_{n}": F.lag(n).over(inside) for n in names}
    else:
        before = inside.rowsBetween(Window.unboundedPreceding, -1)
        packed = F.when(counts, F.struct(*names))
        near = {f"_in_{n}": F.last(packed, ignorenulls=True).over(before)[n] for n in names}

    # 2. Edge row of every bucket, then of the nearest bucket that has one.
    pick = F.max_by if backward else F.min_by
    edges = work.groupBy(*keys, "_bucket").agg(
        *[pick(n, F.when(counts, F.col(ts))).alias(f"_edge_{n}") for n in names]
    )
    by_bucket = F.col("_bucket").asc() if backward else F.col("_bucket").desc()
    across = Window.partitionBy(*keys).orderBy(by_bucket)
    if only is None:
        carried = [F.lag(f"_edge_{n}").over(across).alias(f"_out_{n}") for n in names]
    else:
        before = across.rowsBetween(Window.unboundedPreceding, -1)
        edge = F.when(F.col(f"_edge_{ts}").isNotNull(), F.struct(*[f"_edge_{n}" for n in names]))
        carried = [
            F.last(edge, ignorenulls=True).over(before)[f"_edge_{n}"].alias(f"_out_{n}") for n in names
        ]
    carry = edges.select(*keys, "_bucket", *carried).filter(F.col(f"_out_{ts}").isNotNull())

    # 3. Bucket edges take the carried row.
    joined = work.withColumns(near).join(carry, [*keys, "_bucket"], "left")
    found_inside = F.col(f"_in_{ts}").isNotNull()
    return joined.select(
        *[(_show_nulls(df, c).alias(c) if c in keys else F.col(c)) for c in df.columns],
        *[
            F.when(found_inside, F.col(f"_in_{n}")).otherwise(F.col(f"_out_{n}")).alias(prefix + n)
            for n in names
        ],
    )
