"""Ranks over a whole table without a task that sees all of it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import fresh_path
from tidewatch.sources.tables import publish

#: A value that holds more than one row in so many is joined by broadcast: there are at most as many of them.
_HEAVY = 1000


def _same(df: DataFrame, other: DataFrame, columns: list[str]) -> Column:
    found = F.lit(True)
    for n, c in enumerate(columns):
        found = found & df[c].eqNullSafe(other[f"_key_{n}"])
    return found


def _tile(rank: Column, total: int, tiles: int) -> Column:
    """The tile of a row number: the first ``total % tiles`` tiles have one row more."""
    size, larger = divmod(total, tiles)
    edge = larger * (size + 1)
    beyond = larger + F.floor((rank - 1 - edge) / max(size, 1)) + 1
    return F.when(rank <= edge, F.floor((rank - 1) / (size + 1)) + 1).otherwise(beyond)


def global_ranks(df: DataFrame, order: list[str], descending: bool = False, parts: int = 200, tiles: int = 4) -> DataFrame:
    """All rows with ``rank``, ``dense_rank`` and ``tile`` by the columns ``order`` over the whole table.

    Nulls come last. Equal values share all three; ``tile`` is ``ntile(tiles)``
    of the first row with these values, so it is SQL's where ``order`` tells
    rows apart. The table may not have columns of these names; an empty table
    gives no rows.

    Rows are counted per value first, so heavy ties cost one row. The values are
    cut into ``parts`` ranges and stored with the number of their range; running
    counts inside a range are windows, and what a range begins with is summed up
    from one row per range, ``parts`` at most, on the driver. Values that hold
    more than a thousandth of the rows are joined back by broadcast, the others
    by shuffle, so no key of that join is crowded.
    """
    if taken := {"rank", "dense_rank", "tile"} & {c.lower() for c in df.columns}:
        raise ValueError(f"the table has columns of these names already: {sorted(taken)}")
    keys = [f"_key_{n}" for n in range(len(order))]
    values = df.groupBy(*[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys)]).agg(F.count(F.lit(1)).alias("_n"))
    ways = [F.col(k).desc_nulls_last() if descending else F.col(k).asc_nulls_last() for k in keys]
    ranged = values.repartitionByRange(parts, *ways).withColumn("_part", F.spark_partition_id())
    ranged = publish(ranged, fresh_path(df.sparkSession, "ranked-values"))

    sizes = sorted(ranged.groupBy("_part").agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("values")).collect())
    total = sum(s.rows for s in sizes)
    starts = zip([s._part for s in sizes], accumulate([0, *[s.rows for s in sizes[:-1]]]), accumulate([0, *[s["values"] for s in sizes[:-1]]]))
    starts = df.sparkSession.createDataFrame(list(starts) if sizes else [], "_part int, _rows long, _values long")

    inside = Window.partitionBy("_part").orderBy(*ways)
    before = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = ranged.withColumns({"_before": before, "_nth": F.row_number().over(inside)}).join(F.broadcast(starts), "_part")
    rank = F.col("_rows") + F.col("_before") + 1
    ranked = counted.select(
        *keys, "_n", rank.alias("rank"), (F.col("_values") + F.col("_nth")).alias("dense_rank"), _tile(rank, total, tiles).alias("tile")
    )

    heavy = F.col("_n") * _HEAVY > total
    crowded = F.broadcast(ranked.filter(heavy))
    found = ["rank", "dense_rank", "tile"]
    columns = [F.col(f"`{c}`") for c in df.columns]
    of_crowded = df.join(crowded, _same(df, crowded, order)).select(*columns, *found)
    few = ranked.filter(~heavy)
    others = df.join(crowded, _same(df, crowded, order), "left_anti")
    return of_crowded.unionByName(others.join(few, _same(others, few, order)).select(*columns, *found))
