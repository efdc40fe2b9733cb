"""Document fingerprints by order MinHash, and how alike neighbouring documents are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare

_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _windows(points: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of every k consecutive numbers, from windows of 1, 2, 4, ... joined."""
    whole, size, block, width = None, 0, points, 1
    while True:
        if k & width:
            if whole is None:
                whole = block
            else:
                power = np.uint64(pow(_BASE, width, 1 << 64))
                n = len(points) - size - width + 1
                whole = whole[:n] * power + block[size : size + n]
            size += width
        if size == k:
            return whole
        block = block[: len(block) - width] * np.uint64(pow(_BASE, width, 1 << 64)) + block[width:]
        width *= 2


def _ascending(code: np.ndarray) -> np.ndarray:
    """Positions by ascending code, equal codes in order: code and position are sorted as one number."""
    bits = np.uint64(max(len(code) - 1, 1).bit_length())
    packed = ((code >> bits) << bits) | np.arange(len(code), dtype=np.uint64)
    packed.sort()
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def order_minhash(text: str, k: int = 9, tuple_size: int = 2, slots: int = 64) -> np.ndarray:
    """``slots`` numbers of 16 bits.

    The k-mers of code points are numbered by occurrence and hashed. Slot ``j``
    takes the ``tuple_size`` k-mers that are smallest when hashes are counted
    from j/slots of the hash circle on, puts them back into text order, and
    hashes the tuple. A text shorter than ``k`` is one k-mer; an empty text has
    zeros. Equal texts have equal numbers.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.zeros(slots, np.uint16)
    code = _mix(_windows(points, min(k, len(points))))
    place = _ascending(code)
    ranked = code[place]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    if not fresh.all():
        # Occurrence numbers: 0 for the first in the text, and so on.
        each = np.arange(len(ranked))
        number = each - np.maximum.accumulate(np.where(fresh, each, 0))
        again = np.flatnonzero(number)
        code[place[again]] = _mix(ranked[again] + number[again].astype(np.uint64) * _M2)
        place = _ascending(code)
        ranked = code[place]
    edges = np.arange(slots, dtype=np.uint64) * np.uint64((1 << 64) // slots)
    at = (np.searchsorted(ranked, edges)[:, None] + np.arange(tuple_size)) % len(ranked)
    in_text = np.take_along_axis(at, np.argsort(place[at], axis=1, kind="stable"), axis=1)
    out = np.zeros(slots, np.uint64)
    for column in in_text.T:
        out = _mix(out * np.uint64(_BASE) + ranked[column])
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Share of equal slots."""
    return float((one == other).mean())


def fingerprint(documents: DataFrame, text: str = "text", k: int = 9, tuple_size: int = 2, slots: int = 64) -> Column:
    """Order MinHash of every text as hexadecimal text, four digits a slot; null counts as empty."""
    prepare(documents.sparkSession)

    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        return pd.Series([order_minhash(t or "", k, tuple_size, slots).astype(">u2").tobytes().hex() for t in texts], dtype=object)

    return digest(F.col(text))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many code points of the following text, or all it has."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprint_neighbours(
    documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = 9, tuple_size: int = 2, slots: int = 64, buckets: int | None = None
) -> DataFrame:
    """Fingerprints of every document and of its edited text, and two likenesses.

    Documents follow each other by descending key, nulls last, and the first
    follows the last; rows with equal keys follow each other by text. Result:
    key, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited,
    near_next; one row per input row. A single document follows itself.

    The keys are cut into about ``buckets`` ranges (four per shuffle partition
    by default) at keys drawn by hash. A range holds its keys and, as a guest,
    the cut below it, which is the follower of its last row; the lowest range
    has the highest key as guest. Texts move once and stream through their
    range in order. About ``buckets`` keys reach the driver, however many
    documents there are.
    """
    spark = documents.sparkSession
    prepare(spark)
    schema = (
        f"`{key}` long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    rows = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("key")
    count, highest = keys.agg(F.count("*"), F.max("key")).first()
    drawn = keys.where(F.pmod(F.xxhash64("key"), F.lit(max(1, count // buckets))) == 0)
    # Any set of existing keys will do as cuts; the limit bounds what the driver holds.
    cuts = np.array(sorted({r[0] for r in drawn.where("key is not null").limit(4 * buckets).collect()} - {highest}), np.int64)
    held = spark.sparkContext.broadcast((cuts, highest))

    @F.pandas_udf("array<struct<range:int,guest:boolean>>")
    def places(ids: pd.Series) -> pd.Series:
        cut, top = held.value
        out = []
        for i, at in zip(ids, np.searchsorted(cut, ids.to_numpy(), side="left"), strict=True):
            here = [{"range": int(at), "guest": False}]
            if at < len(cut) and cut[at] == i:
                here.append({"range": int(at) + 1, "guest": True})
            if i == top:
                here.append({"range": 0, "guest": True})
            out.append(here)
        return pd.Series(out, dtype=object)

    lowest = F.array(F.struct(F.lit(0).alias("range"), F.lit(False).alias("guest")))
    placed = (
        rows.withColumn("places", places(F.coalesce("key", F.lit(0).cast("long"))))
        .withColumn("place", F.explode(F.when(F.col("key").isNull(), lowest).otherwise(F.col("places"))))
        .select("key", "text", "place.range", "place.guest")
        .repartition("range")
        .sortWithinPartitions("range", "guest", F.col("key").desc_nulls_last(), "text")
    )

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = pending = None
        here, closed = None, False

        def paired(row, following) -> tuple:
            doc, body, own = row
            changed = edited(body, following[1])
            mark = order_minhash(changed, k, tuple_size, slots)
            return (
                doc, len(body), changed, own.astype(">u2").tobytes().hex(), mark.astype(">u2").tobytes().hex(),
                likeness(own, mark), likeness(own, following[2]),
            )

        def frame(found: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(found, columns=[key, "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            out[key] = out[key].astype("Int64")
            return out

        for batch in batches:
            found = []
            ids = batch["key"].tolist()
            known = batch["key"].notna().tolist()
            for at, (body, rank, guest) in enumerate(zip(batch["text"], batch["range"], batch["guest"], strict=True)):
                if rank != here:
                    if pending is not None:
                        found.append(paired(pending, first))
                    here, closed, first, pending = rank, False, None, None
                if closed:
                    continue
                row = (int(ids[at]) if known[at] else None, body, order_minhash(body, k, tuple_size, slots))
                if pending is not None:
                    found.append(paired(pending, row))
                first = first or row
                pending, closed = (None, True) if guest else (row, False)
            if found:
                yield frame(found)
        if pending is not None:
            yield frame([paired(pending, first)])

    exact = placed.withColumn("key", F.col("key").cast("string"))
    return exact.mapInPandas(measure, schema)
