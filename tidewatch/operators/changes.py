"""What differs between two builds of a table, by multiplicity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ranges(df: DataFrame, keys: list[str], ranges: int) -> DataFrame:
    return df.withColumn("_range", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(ranges)))


def range_hashes(df: DataFrame, keys: list[str], ranges: int = 4096) -> DataFrame:
    """(range, n_rows, one, two): rows and two sums of row hashes of each of ``ranges`` key ranges.

    Sums do not depend on the order of rows and count repeated rows as often as
    they occur. A range may be stored with a build and compared without reading
    the build again.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    # xxhash64 skips nulls: which columns are null is hashed with the values.
    empty = [c.isNull() for c in columns]
    hashes = {"one": F.xxhash64(*columns, *empty), "two": F.xxhash64(F.lit(1), *empty, *columns)}
    return _ranges(df, keys, ranges).groupBy(F.col("_range").alias("range")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(h.cast("decimal(38,0)")).alias(n) for n, h in hashes.items()]
    )


def differing_ranges(before: DataFrame, after: DataFrame) -> list[int]:
    """The ranges whose hashes differ or that one side lacks: as many numbers as there are ranges at most."""
    one, two = before.alias("b"), after.alias("a")
    same = F.lit(True)
    for c in ("n_rows", "one", "two"):
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    found = one.join(two, F.col("b.range") == F.col("a.range"), "full").filter(~same)
    return sorted(r[0] for r in found.select(F.coalesce("b.range", "a.range")).collect())


def build_changes(before: DataFrame, after: DataFrame, keys: list[str], ranges: int = 4096) -> DataFrame:
    """Rows that one build has more often than the other, with ``change``: how many more ``after`` has (negative: fewer).

    Both tables have the same columns, none of them named ``change`` or
    ``_range``. The builds are compared by hashes of key ranges first (128 bits
    and the number of rows per range); only rows of ranges that differ are
    compared in whole, by counts per different row, so a row repeated very often
    leaves each map task once. Two equal builds give no rows and read none a
    second time.
    """
    if sorted(before.columns) != sorted(after.columns) or before.select(sorted(before.columns)).dtypes != after.select(sorted(after.columns)).dtypes:
        raise ValueError("the two builds have different columns or types")
    found = differing_ranges(range_hashes(before, keys, ranges), range_hashes(after, keys, ranges))
    if not found:
        return before.sparkSession.createDataFrame([], before.schema).withColumn("change", F.lit(0).cast("long"))
    wanted = F.col("_range").isin(found)
    sides = [_ranges(df, keys, ranges).filter(wanted).drop("_range").withColumn("_sign", F.lit(sign)) for df, sign in ((before, -1), (after, 1))]
    both = sides[0].unionByName(sides[1])
    return both.groupBy(*[F.col(f"`{c}`") for c in before.columns]).agg(F.sum("_sign").alias("change")).filter("change <> 0")
