"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare

UNKNOWN = "und"
_PIECE = 1 << 18
_BITS = 21


@dataclass(frozen=True)
class LanguageModel:
    """One unit prototype per language; ``size`` numbers each."""

    languages: tuple[str, ...]
    prototypes: np.ndarray
    size: int


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letter_vector(point: int, size: int) -> np.ndarray:
    """The random +1/-1 vector of a letter, fixed by its code point."""
    return np.random.default_rng(point).integers(0, 2, size, dtype=np.int8) * np.int8(2) - np.int8(1)


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams (three code points in one number) and how often they occur.

    Text is lower-cased; every run of other characters counts as one blank, and
    the text begins and ends with one.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _is_letter()[points]
    found: dict[int, int] = {}
    blank = np.where(letters, points, np.uint32(32))
    keep = letters | np.append(True, letters[:-1])[: len(letters)]
    line = np.concatenate(([32], blank[keep], [32])).astype(np.uint64)
    if len(line) > 2 and line[1] == 32:
        line = line[1:]
    if len(line) > 2 and line[-2] == 32:
        line = line[:-1]
    if not letters.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pieces = []
    for at in range(0, len(line) - 2, _PIECE):
        part = line[at : at + _PIECE + 2]
        code = (part[:-2] << np.uint64(2 * _BITS)) | (part[1:-1] << np.uint64(_BITS)) | part[2:]
        pieces.append(np.unique(code, return_counts=True))
    if len(pieces) == 1:
        return pieces[0]
    for codes, counts in pieces:
        for code, count in zip(codes.tolist(), counts.tolist(), strict=True):
            found[code] = found.get(code, 0) + count
    return np.fromiter(found, np.uint64, len(found)), np.fromiter(found.values(), np.int64, len(found))


class LetterSpace:
    """Turns trigram counts into vectors; keeps the vectors of letters and letter pairs it met, up to a bound.

    A trigram's vector is the product of its letters' vectors, the first turned
    by two places and the second by one. Counts of trigrams that end in the same
    letter are summed over their pair vectors before that letter is applied.
    """

    KEPT = 8192

    def __init__(self, size: int):
        self.size = size
        self.pairs = np.zeros((self.KEPT, size), np.float32)
        self.rows: dict[int, int] = {}
        self.letters: dict[int, np.ndarray] = {}

    def _letter(self, point: int) -> np.ndarray:
        vector = self.letters.get(point)
        if vector is None:
            if len(self.letters) >= self.KEPT:
                self.letters.clear()
            self.letters[point] = vector = letter_vector(point, self.size).astype(np.float32)
        return vector

    def _pair_rows(self, pairs: list[int]) -> np.ndarray:
        if len(self.rows) + len(pairs) > self.KEPT:
            self.rows.clear()
        for pair in pairs:
            if pair not in self.rows:
                first, second = self._letter(pair >> _BITS), self._letter(pair & ((1 << _BITS) - 1))
                self.pairs[len(self.rows)] = np.roll(first, 2) * np.roll(second, 1)
                self.rows[pair] = len(self.rows)
        return self.pairs[[self.rows[p] for p in pairs]]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the trigrams' vectors times their counts."""
        total = np.zeros(self.size, np.float32)
        if not len(codes):
            return total
        points, column = np.unique(codes & np.uint64((1 << _BITS) - 1), return_inverse=True)
        pairs, row = np.unique(codes >> np.uint64(_BITS), return_inverse=True)
        last = np.stack([self._letter(p) for p in points.tolist()])
        at_once = min(self.KEPT, max(1, (1 << 22) // len(points)))
        for start in range(0, len(pairs), at_once):
            block = pairs[start : start + at_once].tolist()
            here = slice(None) if len(block) == len(pairs) else (row >= start) & (row < start + at_once)
            table = np.zeros((len(points), len(block)), np.float32)
            table[column[here], row[here] - start] = counts[here]
            total += ((table @ self._pair_rows(block)) * last).sum(axis=0)
        return total


def fit_languages(documents: DataFrame, keep: Column, text: str = "text", lang: str = "lang", size: int = 256) -> LanguageModel:
    """Prototypes from all documents with a language for which ``keep`` holds.

    A bundle is a sum, so a prototype is made from the language's trigram
    counts: counted per task, summed by trigram, turned into vectors in tasks,
    and summed by language. One vector per language reaches the driver, so the
    column should name languages: its different values are not limited. Texts
    without a letter add nothing, repeated rows add again; a language without
    any letter is not learned.
    """
    spark = documents.sparkSession
    prepare(spark)
    rows = documents.where(keep & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("lang"):
                together = [trigram_counts(t) for t in part["text"]]
                codes, place = np.unique(np.concatenate([c for c, _ in together]), return_inverse=True)
                sums = np.bincount(place, np.concatenate([n for _, n in together]).astype(float), minlength=len(codes))
                yield pd.DataFrame({"lang": name, "code": codes.astype(np.int64), "n": sums.astype(np.int64)})

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        space = LetterSpace(size)
        for batch in batches:
            for name, part in batch.groupby("lang"):
                vector = space.bundle(part["code"].to_numpy().astype(np.uint64), part["n"].to_numpy()).astype(float)
                sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            yield pd.DataFrame({"lang": name, "place": np.arange(size), "value": vector})

    counts = rows.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    sums = counts.mapInPandas(profile, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    table = sums.toPandas().sort_values(["lang", "place"])
    languages = tuple(sorted(table["lang"].unique()))
    matrix = table["value"].to_numpy(float).reshape(len(languages), size) if languages else np.zeros((0, size))
    norms = np.maximum(np.sqrt((matrix**2).sum(axis=1, keepdims=True)), 1e-12)
    return LanguageModel(languages, (matrix / norms).astype(np.float32), size)


def language_of(model: LanguageModel, documents: DataFrame, text: str = "text") -> Column:
    """struct(lang_pred, score): the nearest prototype and its cosine, not below 0.

    ``und`` and 0 where the text is null or has no letter, or no language was
    learned. Equal cosines go to the language that sorts first, and equal texts
    to the same one. A text is read whole; a task holds the trigrams of one text.
    """
    prepare(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def nearest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m: LanguageModel = held.value
        space = LetterSpace(m.size)
        for batch in texts:
            names, scores = [], []
            for t in batch:
                codes, counts = trigram_counts(t or "")
                if not len(codes) or not m.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = space.bundle(codes, counts)
                cosine = (m.prototypes @ vector) / max(float(np.sqrt((vector**2).sum())), 1e-12)
                best = int(np.argmax(cosine))
                names.append(m.languages[best])
                scores.append(float(min(max(cosine[best], 0.0), 1.0)))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return nearest(F.col(text))
