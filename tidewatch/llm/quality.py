"""Quality: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import labelled_sample, prepare, stored

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CAPITALS = zlib.crc32(b"\x00capitals")
_KEPT_CODES = 1 << 17
#: Length of every document's vector; larger ones let few n-grams decide.
_LENGTH = 6.0


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    longest: int


class WordGrams:
    """Hashed word n-grams of texts as (slots, values), the values a vector of fixed length.

    Words are lower-cased and runs of signs are words too; a word in capitals is
    led by a mark, so that the habit counts and not the word. A slot's value is
    1 + log of its count.
    """

    def __init__(self, bits: int, longest: int):
        self.bits, self.longest = bits, longest
        self.codes: dict[str, tuple[int, ...]] = {}

    def _code(self, token: str) -> tuple[int, ...]:
        if len(self.codes) >= _KEPT_CODES:
            self.codes.clear()
        code = zlib.crc32(token.lower().encode("utf-8", "surrogatepass"))
        self.codes[token] = pair = (_CAPITALS, code) if len(token) > 1 and token.isupper() else (code,)
        return pair

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        known = self.codes
        flat = [c for t in _TOKEN.findall(text) for c in (known.get(t) or self._code(t))]
        words = np.array(flat, np.uint64)
        slots, code = [], np.zeros(len(words), np.uint64)
        for n in range(1, self.longest + 1):
            if len(words) < n:
                break
            code = (code[: len(words) - n + 1] * np.uint64(0x9E3779B97F4A7C15)) + words[n - 1 :] + np.uint64(n)
            slots.append((code * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits))
        if not slots:
            return np.zeros(0, np.int64), np.zeros(0)
        unique, count = np.unique(np.concatenate(slots), return_counts=True)
        value = 1 + np.log(count)
        return unique.astype(np.int64), value * (_LENGTH / np.sqrt((value**2).sum()))


def ftrl_weights(rows: list, labels: np.ndarray, size: int, passes: int, alpha: float, beta: float, l1: float, l2: float):
    """Per-coordinate FTRL-proximal; the last coordinate is the bias."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def current(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - np.where(at == size, 0.0, l1), 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(passes):
        for (slots, values), y in zip(rows, labels, strict=True):
            at, x = np.append(slots, size), np.append(values, 1.0)
            w = current(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return current(np.arange(size + 1))


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    keep: Column,
    label: str = "quality",
    fit_rows: int = 12_000,
    bits: int = 18,
    longest: int = 2,
    shards: int = 4,
    passes: int = 3,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> QualityModel:
    """Learn from at most ``fit_rows`` labelled documents whose label row satisfies ``keep``.

    Each of ``shards`` tasks runs the updates over its share of the sample; the
    model is the mean of theirs. At most 2**bits weights reach the driver.
    Without rows the score of every text is one half.
    """
    prepare(documents.sparkSession)
    sample = stored(labelled_sample(documents, labels, label, keep, fit_rows), "quality-sample")
    size = 1 << bits

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place", kind="stable")
        grams = WordGrams(bits, longest)
        w = ftrl_weights([grams(t) for t in part["text"]], (part["label"] > 0).to_numpy(float), size, passes, alpha, beta, l1, l2)
        used = np.flatnonzero(w)
        return pd.DataFrame({"slot": used, "weight": w[used], "rows": len(part)})

    placed = sample.withColumn("place", F.xxhash64("text", "label")).withColumn("shard", F.pmod("place", F.lit(shards)))
    found = placed.groupBy("shard").applyInPandas(train, "slot long, weight double, rows long")
    summed = found.groupBy("slot").agg(F.sum("weight").alias("weight")).toPandas()
    present = placed.select("shard").distinct().count()
    weights = np.zeros(size + 1)
    weights[summed["slot"].to_numpy()] = summed["weight"].to_numpy() / max(present, 1)
    return QualityModel(weights[:size].astype(np.float32), float(weights[size]), longest)


def quality_score(model: QualityModel, documents: DataFrame, text: str = "text") -> Column:
    """A number from 0 to 1 for every text: a sparse dot product; a null or empty text has the bias alone.

    Equal texts have equal scores. A text is read whole, however long: a task
    holds the words of one text and a vector of fixed length.
    """
    prepare(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m: QualityModel = held.value
        grams = WordGrams(len(m.weights).bit_length() - 1, m.longest)
        for batch in texts:
            sums = []
            for t in batch:
                slots, values = grams(t or "")
                sums.append(float(values @ m.weights[slots]))
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(sums, float) + m.bias, -30, 30))))

    return score(F.col(text))
