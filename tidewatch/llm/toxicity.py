"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import labelled_sample, prepare, stored

_MULTIPLY, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)
_PIECE = 1 << 20


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` has one number per hashed n-gram: log-count ratio times learned coefficient."""

    weights: np.ndarray
    bias: float
    shortest: int
    longest: int


def gram_slots(text: str, shortest: int, longest: int, bits: int) -> Iterator[np.ndarray]:
    """Hash slots of all character n-grams of the lower-cased text, repeats included, piece by piece."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for start in range(0, max(len(points), 1), _PIECE):
        piece = points[start : start + _PIECE + longest - 1]
        code = np.zeros(len(piece), np.uint32)
        for n in range(1, longest + 1):
            if len(piece) < n:
                break
            code = code[: len(piece) - n + 1] * _MULTIPLY + piece[n - 1 :]
            if n >= shortest:
                yield (code * _SPREAD) >> np.uint32(32 - bits)


def _present(text: str, shortest: int, longest: int, wanted: np.ndarray) -> np.ndarray:
    """Distinct slots of a text among the wanted ones (a boolean for every slot)."""
    bits = len(wanted).bit_length() - 1
    found = [s[wanted[s]] for s in gram_slots(text, shortest, longest, bits)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


def _fit_coefficients(rows: list[np.ndarray], label: np.ndarray, scale: np.ndarray, steps: int, ridge: float):
    """Logistic regression over the scaled presence features by full-batch gradient steps (Adam)."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    slot = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    value = scale[slot]
    weight, bias = np.zeros(len(scale)), float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
    first, second, b1, b2 = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1), 0.9, 0.99
    for step in range(1, steps + 1):
        margin = bias + np.bincount(owner, value * weight[slot], minlength=len(rows))
        wrong = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label) / len(label)
        grad = np.append(np.bincount(slot, value * wrong[owner], minlength=len(scale)) + ridge * weight, wrong.sum())
        first, second = b1 * first + (1 - b1) * grad, b2 * second + (1 - b2) * grad**2
        move = 0.1 * (first / (1 - b1**step)) / (np.sqrt(second / (1 - b2**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    return weight, bias


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    keep: Column,
    label: str = "toxic",
    fit_rows: int = 6_000,
    bits: int = 20,
    shortest: int = 3,
    longest: int = 6,
    features: int = 2_000,
    steps: int = 150,
    ridge: float = 1e-4,
) -> ToxicityModel:
    """Learn from at most ``fit_rows`` labelled documents whose label row satisfies ``keep``.

    Document counts per n-gram and class are made and ranked by Spark, and the
    coefficients are fitted by one task over the sample's encoded rows, so that
    ``features`` n-grams with their weights are all that reaches the driver.
    Without rows of both classes the score is the share of label 1 (one half
    without any row). Repeated documents count again, nulls are empty texts.
    """
    spark = documents.sparkSession
    prepare(spark)
    sample = stored(labelled_sample(documents, labels, label, keep, fit_rows), "toxicity-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, every = np.zeros((2, 1 << bits), np.int32), np.ones(1 << bits, bool)
        for batch in batches:
            for text, y in zip(batch["text"], batch["label"], strict=True):
                counts[int(y > 0), _present(text, shortest, longest, every)] += 1
        slots = np.flatnonzero(counts.any(axis=0))
        yield pd.DataFrame({"slot": slots, "clean": counts[0, slots], "toxic": counts[1, slots]})

    per_class = {r["label"]: r["n"] for r in sample.groupBy((F.col("label") > 0).alias("label")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = per_class.get(True, 0), per_class.get(False, 0)
    if not toxic or not clean:
        return ToxicityModel(np.zeros(1 << bits, np.float32), float(np.log((toxic + 0.5) / (clean + 0.5))), shortest, longest)

    # How far the count among toxic rows is from its expectation, in standard deviations.
    expected = toxic * (F.col("clean") + F.col("toxic")) / (toxic + clean)
    distance = F.abs(F.col("toxic") - expected) / F.sqrt(expected * (clean / (toxic + clean)) + 0.5)
    ratio = F.log((F.col("toxic") + 1) / F.lit(float(toxic + 2))) - F.log((F.col("clean") + 1) / F.lit(float(clean + 2)))
    sums = sample.mapInPandas(count, "slot long, clean long, toxic long").groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # What one document has tells nothing.
    best = sums.where("clean + toxic > 1").select("slot", ratio.alias("ratio"), distance.alias("distance"))
    best = sorted(best.orderBy(F.col("distance").desc(), "slot").limit(features).select("slot", "ratio").collect())
    slots, scale = np.array([r.slot for r in best], np.int64), np.array([r.ratio for r in best], float)
    wanted = np.zeros(1 << bits, bool)
    wanted[slots] = True
    held = spark.sparkContext.broadcast(wanted)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_present(t, shortest, longest, held.value).astype(np.int32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"found": found, "label": (batch["label"] > 0).astype(float)})

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, label = [], []
        for batch in batches:
            found += [np.searchsorted(slots, np.frombuffer(bytes(f), np.int32)) for f in batch["found"]]
            label += batch["label"].tolist()
        if found:
            weight, bias = _fit_coefficients(found, np.array(label), scale, steps, ridge)
            yield pd.DataFrame({"at": np.arange(-1, len(weight)), "value": np.append(bias, weight)})

    encoded = stored(sample.mapInPandas(encode, "found binary, label double"), "toxicity-rows")
    fitted = sorted(encoded.coalesce(1).mapInPandas(fit, "at int, value double").collect())
    bias, weight = fitted[0].value, np.array([r.value for r in fitted[1:]])
    weights = np.zeros(1 << bits, np.float32)
    weights[slots] = weight * scale
    return ToxicityModel(weights, float(bias), shortest, longest)


def toxicity_score(model: ToxicityModel, documents: DataFrame, text: str = "text") -> Column:
    """A number from 0 to 1 for every text; a null or empty text has the score of no evidence.

    Equal texts have equal scores. A text is read whole, in pieces of 2**20 code
    points, so a very long one costs time and little memory.
    """
    prepare(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m: ToxicityModel = held.value
        wanted = m.weights != 0
        for batch in texts:
            sums = [float(m.weights[_present(t or "", m.shortest, m.longest, wanted)].sum(dtype=float)) for t in batch]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(sums, float) + m.bias, -30, 30))))

    return score(F.col(text))
