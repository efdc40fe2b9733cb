"""Near-duplicate documents: MinHash banding over word n-gram sets, verified on the full sets."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare, stored
from tidewatch.llm.components import connected

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_KEPT_WORDS = 1 << 17
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def choose_bands(threshold: float, recall: float, most_hashes: int = 160) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold is missed with at most 1 - recall."""
    best = None
    for rows in range(1, most_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))) if threshold < 1 else 1
        if bands * rows > most_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class GramSets:
    """Sets of hashed word n-grams; words are lower-cased runs of letters and digits."""

    def __init__(self, n: int):
        self.n = n
        self.codes: dict[str, int] = {}

    def _code(self, word: str) -> int:
        import xxhash

        if len(self.codes) >= _KEPT_WORDS:
            self.codes.clear()
        self.codes[word] = code = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return code

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct hashes. A text of fewer than n words has one n-gram of all its words; one without words none."""
        known = self.codes
        words = [known.get(w) or self._code(w) for w in _WORD.findall(text.lower())]
        if not words:
            return np.zeros(0, np.uint64)
        codes = np.array(words, np.uint64)
        n = min(self.n, len(codes))
        grams = np.zeros(len(codes) - n + 1, np.uint64)
        for i in range(n):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i]
        return np.unique(_mix(grams + np.uint64(n)))


def band_values(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit number per band, from the minima of bands * rows hash functions."""
    rng = np.random.default_rng(8)
    factor = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32) | np.uint32(1)
    flip = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32)
    low = np.full(bands * rows, np.uint32(0xFFFFFFFF))
    points = (grams >> np.uint64(16)).astype(np.uint32)
    for start in range(0, len(points), 1024):
        block = (points[start : start + 1024][None, :] ^ flip) * factor
        block ^= block >> np.uint32(15)
        low = np.minimum(low, (block * np.uint32(0x2C1B3C6D)).min(axis=1))
    out = np.zeros(bands, np.uint64)
    for column in low.reshape(bands, rows).T:
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out.view(np.int64)


def row_key(document: Column, text: Column) -> Column:
    """What tells document rows apart: id and text. Rows equal in both count as one document."""
    return F.unhex(F.md5(F.concat(F.coalesce(document.cast("string"), F.lit("~")), F.lit(":"), F.coalesce(text, F.lit("")))))


def _grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows with equal keys, one after the other, from batches sorted by them."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch[k].to_numpy() for k in keys]
        change = np.zeros(len(batch), bool)
        change[0] = bool(rest) and any(rest[-1][k].iloc[-1] != batch[k].iloc[0] for k in keys)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        ends = [*starts, len(batch)]
        if not len(starts) or starts[0]:
            rest.append(batch.iloc[: ends[0]])
        if len(starts):
            if rest:
                yield pd.concat(rest) if len(rest) > 1 else rest[0]
            for a, b in zip(ends[:-2], ends[1:-1], strict=True):
                yield batch.iloc[a:b]
            rest = [batch.iloc[ends[-2] :]]
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]


def _sides(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the group's rows in the first and in the second block; equal where the blocks are one."""
    one, two, own = group["one"].iloc[0], group["two"].iloc[0], group["block"].to_numpy()
    return (np.flatnonzero(own == one), np.flatnonzero(own == two)) if one != two else (np.arange(len(own)),) * 2


def _new_pairs(bands: np.ndarray, sizes: np.ndarray, band: int, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs meet in no earlier band and have sizes that allow the similarity."""
    a, b = sizes[left][:, None], sizes[right][None, :]
    fine = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
    for k in range(band):
        fine &= bands[left, k][:, None] != bands[right, k][None, :]
    fine &= left[:, None] != right[None, :]
    return fine


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [start, start + width])
        table = np.zeros((len(sets), min(width, int(column[-1]) + 1 - start)), np.float32)
        table[owner[a:b], column[a:b] - start] = 1
        total += table[left] @ table[right].T
    return total


def near_duplicates(
    documents: DataFrame,
    document: str = "doc_id",
    text: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
    block: int = 512,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """One row per document row: document, row_key, class_id, keeper, n_links, n_text_links.

    Two documents are linked if the Jaccard similarity of their sets of n words
    in a row is at least ``threshold``; classes are the connected groups.
    ``class_id`` is the least id in the class; ``keeper`` marks one row of it,
    that with the least id (nulls last) and then the least row key. ``n_links``
    counts the linked documents, copies included, ``n_text_links`` the linked
    different sets. Documents without words are linked to nothing; a null id
    gives a null class only if the class has no other. Rows equal in id and
    text count as one document, and all of them are marked as keepers.

    Documents with equal sets are one set from the start. Bands and rows follow
    from the recall at the threshold. Sets that share a band meet in a bucket; a
    bucket is dealt out in blocks of about ``block`` sets, and each pair of
    blocks is a group of rows of its own, so that no bucket meets in one task.
    A pair of sets is looked at in its first common band only. First the bands
    alone tell which sets have a pair in a group, then those sets travel, all
    overlaps in a group are counted with one matrix product, and a group gives
    one row per set: its links, and the root of its linked group. Pairs are
    never listed. The keys of the documents whose sets travel are broadcast if
    there are at most ``broadcast_rows``; beyond it texts are shuffled to them.
    """
    spark = documents.sparkSession
    prepare(spark)
    bands, rows = choose_bands(threshold, recall)

    @F.pandas_udf("digest binary, n int, bands array<long>")
    def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        sets = GramSets(n)
        for batch in texts:
            found = [sets(t or "") for t in batch]
            yield pd.DataFrame(
                {
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in found],
                    "n": [len(s) for s in found],
                    "bands": [band_values(s, bands, rows) if len(s) else np.zeros(0, np.int64) for s in found],
                }
            )

    @F.pandas_udf("binary")
    def gram_set(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sets = GramSets(n)
        for batch in texts:
            yield pd.Series([sets(t or "").tobytes() for t in batch], dtype=object)

    keyed = documents.select(F.col(document).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = keyed.withColumn("row_key", row_key(F.col("doc"), F.col("text")))
    sketched = keyed.withColumn("s", sketch(F.col("text"))).select("doc", "row_key", "s.digest", "s.n", "s.bands")
    sketched = stored(sketched, "sketches")

    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row_key")
    sets = (
        sketched.where("n > 0")
        .groupBy("digest")
        .agg(F.min(order).alias("least"), F.count_distinct("row_key").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    )
    sets = stored(sets, "sets")

    banded = sets.select("digest", F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1")
    members = (
        banded.join(shared, ["band", "value"])
        .withColumn("blocks", F.expr(f"cast(ceil(size / {block}) AS int)"))
        .withColumn("block", F.expr("cast(pmod(xxhash64(digest), blocks) AS int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("band", "value", "digest", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    )
    keys = ["band", "value", "one", "two"]

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys)

    def select(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for group in _grouped(batches, keys):
            if len(group) < 2:
                continue
            left, right = _sides(group)
            values = np.stack(group["bands"].to_numpy())
            pairs = _new_pairs(values, group["n"].to_numpy(float), int(group["band"].iloc[0]), left, right, threshold)
            busy = np.zeros(len(group), bool)
            busy[left[pairs.any(axis=1)]] = True
            busy[right[pairs.any(axis=0)]] = True
            if busy.any():
                out.append(group.loc[busy, [*keys, "block", "digest"]])
            if len(out) >= 500:
                yield pd.concat(out)
                out = []
        if out:
            yield pd.concat(out)

    light = dealt(members.join(sets.select("digest", "n", "bands"), "digest"))
    busy = stored(light.mapInPandas(select, "band int, value long, one int, two int, block int, digest binary"), "busy-sets")

    needed = busy.select("digest").distinct().join(sets.select("digest", "least.row_key"), "digest")
    needed = stored(needed, "needed-sets")
    if needed.count() <= broadcast_rows:
        needed = F.broadcast(needed)
    full = (
        keyed.join(needed, "row_key")
        .select("digest", gram_set(F.col("text")).alias("grams"))
        .dropDuplicates(["digest"])
    )
    full = stored(full, "full-sets")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[pd.DataFrame] = []
        for group in _grouped(batches, keys):
            left, right = _sides(group)
            values, sizes = np.stack(group["bands"].to_numpy()), group["n"].to_numpy(float)
            pairs = _new_pairs(values, sizes, int(group["band"].iloc[0]), left, right, threshold)
            common = _overlaps([np.frombuffer(bytes(g), np.uint64) for g in group["grams"]], left, right)
            near = pairs & (common >= threshold * (sizes[left][:, None] + sizes[right][None, :] - common) - 1e-6)
            if not near.any():
                continue
            copies, same = group["copies"].to_numpy(float), left is right
            texts, docs = np.zeros(len(group)), np.zeros(len(group))
            texts[left] += near.sum(axis=1)
            docs[left] += near @ copies[right]
            if not same:
                texts[right] += near.sum(axis=0)
                docs[right] += copies[left] @ near
            # The least linked position, again and again, until it stays: the root of the linked group.
            root = np.arange(len(group))
            while True:
                low = root.copy()
                a = np.where(near, root[right][None, :], len(group)).min(axis=1)
                low[left] = np.minimum(low[left], a)
                b = np.where(near, root[left][:, None], len(group)).min(axis=0)
                low[right] = np.minimum(low[right], b)
                low = np.minimum(low, low[low])
                if (low == root).all():
                    break
                root = low
            linked = texts > 0
            digests = group["digest"].to_numpy()
            out.append(
                pd.DataFrame(
                    {"a": digests[linked], "b": digests[root[linked]], "texts": texts[linked].astype(np.int64), "docs": docs[linked].astype(np.int64)}
                )
            )
            if len(out) >= 500:
                yield pd.concat(out)
                out = []
        if out:
            yield pd.concat(out)

    heavy = dealt(busy.join(sets.select("digest", "n", "bands", "copies"), "digest").join(full, "digest"))
    links = stored(heavy.mapInPandas(verify, "a binary, b binary, texts long, docs long"), "links")

    counted = links.groupBy(F.col("a").alias("digest")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    labels = connected(links.select("a", "b")).select(F.col("node").alias("digest"), "label")
    placed = sets.select("digest", "least", "copies").join(labels, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    first = placed.groupBy("label").agg(F.min("least").alias("first"))
    classes = (
        placed.join(first, "label")
        .join(counted, "digest", "left")
        .select(
            "digest",
            F.col("first.doc").alias("class_doc"),
            F.col("first.row_key").alias("class_key"),
            (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
        )
    )
    classes = stored(classes, "classes")
    without = F.col("n") == 0
    return sketched.select("doc", "row_key", "digest", "n").join(classes, "digest", "left").select(
        F.col("doc").alias(document),
        "row_key",
        F.when(without, F.col("doc")).otherwise(F.col("class_doc")).alias("class_id"),
        (without | (F.col("row_key") == F.col("class_key"))).alias("keeper"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"),
    )


def one_per_class(documents: DataFrame, document: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, columns as before; rows equal in id and text count as one."""
    found = near_duplicates(documents, document, text)
    keepers = stored(found.where("keeper").select(F.col("row_key").alias("_tw_key")).distinct(), "keepers")
    keyed = documents.withColumn("_tw_row_key", row_key(F.col(document), F.col(text)))
    return keyed.join(keepers, F.col("_tw_row_key") == F.col("_tw_key")).dropDuplicates(["_tw_row_key"]).select(*[F.col(f"`{c}`") for c in documents.columns])
