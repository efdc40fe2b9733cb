"""Isolation forest: outlier scores from random partitioning trees (Liu, Ting, Zhou 2008).

Each tree sees a sample of fixed size, so trees are built in parallel, one per
group, from one tagged sample of the data. The forest has a fixed size (trees x
twice the sample) and is the only thing that passes through the driver; scoring
is a vectorised pass over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import ship_package

TREES = 200
SAMPLE = 256
_NODES = "tree int, feature array<int>, cut array<double>, depth array<double>, sample int"
#: Rows that all trees draw from, as a multiple of one tree's sample.
_POOL = 64


def _expected_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n if n > 2 else 1.0


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in arrays: the children of node i are 2i+1 and 2i+2.

    A branch that ends early is continued by cuts every row passes on the left,
    so scoring takes the same number of steps for all rows. ``depth`` holds the
    path length of each place on the last level, ``samples`` the rows that each
    tree was grown from.
    """

    feature: np.ndarray
    cut: np.ndarray
    depth: np.ndarray
    samples: np.ndarray
    levels: int


def _levels(rows: int) -> int:
    return max(1, int(np.ceil(np.log2(max(rows, 2)))))


def _grow(values: np.ndarray, rng: np.random.Generator, levels: int) -> tuple[list, list, list]:
    """A tree of ``levels`` levels in all; its own cuts end where its rows' number says."""
    deepest = _levels(len(values))
    inner = 2**levels - 1
    feature, cut, depth = [0] * inner, [np.inf] * inner, [0.0] * (inner + 1)

    def place(node: int, rows: np.ndarray, level: int) -> None:
        spread = np.flatnonzero(rows.min(axis=0) < rows.max(axis=0)) if len(rows) > 1 else []
        if level == deepest or len(spread) == 0:
            for _ in range(level, levels):
                node = 2 * node + 1
            depth[node - inner] = level + _expected_path(len(rows))
            return
        f = int(rng.choice(spread))
        at = float(rng.uniform(rows[:, f].min(), rows[:, f].max()))
        below = rows[:, f] <= at
        feature[node], cut[node] = f, at
        place(2 * node + 1, rows[below], level + 1)
        place(2 * node + 2, rows[~below], level + 1)

    place(0, values, 0)
    return feature, cut, depth


def tagged_sample(df: DataFrame, columns: list[str], key: list[str], trees: int, sample: int, seed: int) -> DataFrame:
    """Rows with the tree they belong to, about a third more than ``sample`` per tree where there are so many.

    One rule at every size: a pool of about 64 samples is drawn by a hash of the
    key, the whole table if it has no more, and every row of the pool is offered
    to every tree, which takes it by a hash of its own. A tree never has a row
    twice; the pool bounds what is offered.
    """
    steps = 1 << 30
    n = df.count()
    pool = min(1.0, _POOL * sample / max(n, 1))
    share = min(1.0, 1.33 * sample / max(n * pool, 1))
    keyed = df.select(*columns, F.xxhash64(F.lit(seed), *key).alias("_h"))
    drawn = keyed.filter(F.pmod(F.xxhash64("_h", F.lit(1)), F.lit(steps)) < int(pool * steps))
    offered = drawn.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    own = F.xxhash64("_h", "tree")
    return offered.withColumn("_own", own).filter(F.pmod("_own", F.lit(steps)) < int(share * steps))


def iforest_fit(
    df: DataFrame, columns: list[str], key: list[str], trees: int = TREES, sample: int = SAMPLE, seed: int = 42
) -> Forest:
    """A forest whose trees are grown from ``sample`` rows each, or from all rows if there are fewer."""
    ship_package(df.sparkSession)
    tagged = tagged_sample(df, columns, key, trees, sample, seed)
    levels = _levels(sample)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = pdf.sort_values("_own").head(sample)[columns].to_numpy(dtype=float)
        feature, cut, depth = _grow(rows, np.random.default_rng([seed, tree]), levels)
        return pd.DataFrame([{"tree": tree, "feature": feature, "cut": cut, "depth": depth, "sample": len(rows)}])

    built = tagged.groupBy("tree").applyInPandas(build, _NODES).orderBy("tree").toPandas()
    stacked = [np.stack([np.asarray(v) for v in built[part]]) for part in ("feature", "cut", "depth")]
    return Forest(*stacked, built["sample"].to_numpy(), levels)


def path_norm(forest: Forest) -> float:
    """Mean path length that the trees' samples would lead one to expect."""
    return float(np.mean([_expected_path(n) for n in forest.samples]))


def iforest_score(df: DataFrame, columns: list[str], forest: Forest, out: str = "iso_score") -> DataFrame:
    """Add a score in (0, 1], six decimals; higher is more unusual."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        f = shared.value
        norm = path_norm(f)
        inner = f.feature.shape[1]
        for batch in batches:
            n = len(batch)
            by_column = np.ascontiguousarray(batch.to_numpy(dtype=float).T).ravel()
            rows = np.arange(n)
            total = np.zeros(n)
            for feature, cut, depth in zip(f.feature * n, f.cut, f.depth):
                at = np.zeros(n, dtype=np.int64)
                for _ in range(f.levels):
                    at = 2 * at + 1 + (by_column.take(rows + feature.take(at)) > cut.take(at))
                total += depth.take(at - inner)
            yield pd.Series(np.round(np.exp2(-total / len(f.feature) / norm), 6))

    return df.withColumn(out, score(F.struct(*columns)))


def flag_outliers(scored: DataFrame, contamination: float, score: str = "iso_score", out: str = "iso_anomaly") -> DataFrame:
    """1 where the score is beyond the ``contamination`` share, else 0.

    Scores have six decimals, so counting per score leaves at most a million
    rows for the exact percentile. Nothing is flagged at contamination 0.
    """
    if contamination <= 0:
        return scored.withColumn(out, F.lit(0))
    per_score = scored.groupBy(F.col(score).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    threshold = per_score.agg(F.percentile("v", 1.0 - contamination, F.col("n"))).scalar()
    return scored.withColumn(out, F.when(F.col(score) > threshold, 1).otherwise(0))
