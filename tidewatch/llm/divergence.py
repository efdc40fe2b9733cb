"""Source divergence audit: how far the term shares of every source are from its peers' and its language's.

Groups are multiplied with the term-major index row by row (Gustavson): a group
scatters its terms through the index into one dense row of sums per peer, so
pairs of postings are never rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare, stored

_BREAKS = bytes(b for b in range(128) if not (0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
_TERMS = bytes.maketrans(_BREAKS, b" " * len(_BREAKS))
#: Characters of a text that are cut into terms at a time, and different terms a task holds before it hands them on.
_CUT, _HELD = 1 << 20, 1 << 19
#: Postings that a task gathers before it scatters them.
_ROWS = 1 << 18


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text, part by part: runs of ASCII letters and of anything beyond ASCII, A-Z lower-cased."""
    rest = text.lower().translate(_TERMS)
    start = 0
    while start < len(rest):
        end = rest.find(b" ", start + _CUT) if start + _CUT < len(rest) else len(rest)
        end = len(rest) if end < 0 else end
        yield rest[start:end].split()
        start = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the rows of a task; a group without terms has one row with an empty term."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    known: set[tuple[str, str]] = set()

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, documents) in counts.items():
            size = len(times)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array(list(times.keys()), pa.binary()).cast(pa.string()),
                    pa.array(list(times.values()), pa.int64()),
                    pa.array([documents[t] for t in times], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            group = (lang, source)
            if group not in counts:
                counts[group] = (Counter(), Counter())
                if group not in known:
                    known.add(group)
                    counts[group][0][b""] = 0
            times, documents = counts[group]
            before, own = len(times), set()
            for part in terms_of(text):
                times.update(part)
                own.update(part)
            documents.update(own)
            held += len(times) - before
            if held > _HELD:
                yield from flush()
                held = 0
    yield from flush()


def _share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)) without rounding."""
    above = (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)") + 2
    return F.call_function("div", F.lit(10**9).cast("decimal(12,0)") * above, F.col(total).cast("decimal(20,0)") + 2 * F.col(terms).cast("decimal(18,0)")) + 1


def _distance(p: Column | str, q: Column | str) -> Column:
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of all runs, one after the other."""
    before = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(starts, lengths) + np.arange(lengths.sum()) - before


class PairSums:
    """Dense sums over the pairs of two blocks of groups, against the value of a pair that shares no term at all."""

    def __init__(self, one: np.ndarray, two: np.ndarray, same: bool):
        self.one, self.two, self.same = one, two, same
        self.base = divergence(one[:, None], two[None, :])
        self.sums = np.zeros(self.base.shape, np.int64)

    def _against_zero(self, slots: np.ndarray, shares: np.ndarray, zeros: np.ndarray, base: np.ndarray) -> np.ndarray:
        """What terms that only one side has add; equal shares of a group are taken together."""
        out = np.zeros(base.shape, np.int64)
        for g in np.unique(slots):
            share, times = np.unique(shares[slots == g], return_counts=True)
            for at in range(0, len(share), 4096):
                block = divergence(share[at : at + 4096, None], zeros[None, :]) - base[g]
                out[g] += times[at : at + 4096] @ block
        return out

    def add(self, term: np.ndarray, right: np.ndarray, slot: np.ndarray, share: np.ndarray) -> None:
        """Postings of whole terms, sorted by term: term number, block (False: first), group's slot, share."""
        left = ~right
        lt, ls, lp = term[left], slot[left], share[left]
        rt, rs, rp = (lt, ls, lp) if self.same else (term[right], slot[right], share[right])
        alone = self._against_zero(ls, lp, self.two, self.base)
        self.sums += alone
        self.sums += alone.T if self.same else self._against_zero(rs, rp, self.one, self.base.T).T
        begin, end = np.searchsorted(rt, lt, "left"), np.searchsorted(rt, lt, "right")
        for g in np.unique(ls):
            mine = np.flatnonzero((ls == g) & (end > begin))
            many = end[mine] - begin[mine]
            at = _runs(begin[mine], many)
            peer, p, q = rs[at], np.repeat(lp[mine], many), rp[at]
            # What both have, less what was added for each of them alone.
            value = divergence(p, q) - divergence(p, self.two[peer]) - divergence(self.one[g], q) + self.base[g, peer]
            np.add.at(self.sums[g], peer, value)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, h = np.nonzero(self.sums)
        return g, h, self.sums[g, h]


_TILE = ["lang", "one", "two", "part"]


def _tile_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per pair of slots of every tile; its rows come with the zero shares first, then sorted by term."""
    tile: tuple | None = None
    sums: PairSums | None = None
    zeros: list[tuple[int, int, int]] = []
    kept: list[np.ndarray] = []
    held = 0

    def scatter(rows: np.ndarray, last: bool) -> list[np.ndarray]:
        nonlocal sums
        if sums is None:
            sides = [np.zeros(1 + max((s for b, s, _ in zeros if b == side), default=0), np.int64) for side in (0, 1)]
            for side, slot, share in zeros:
                sides[side][slot] = share
            same = tile[1] == tile[2]
            sums = PairSums(sides[0], sides[0] if same else sides[1], same)
        whole = len(rows) if last or not len(rows) else int(np.searchsorted(rows[:, 0], rows[-1, 0], "left"))
        if whole:
            part = rows[:whole]
            sums.add(part[:, 0], part[:, 1] == 1, part[:, 2], part[:, 3])
        return [rows[whole:]]

    def finish() -> Iterator[pa.RecordBatch]:
        if tile is None or not zeros:
            return
        scatter(np.concatenate(kept) if kept else np.zeros((0, 4), np.int64), True)
        g, h, value = sums.rows()
        if not sums.same:  # both directions
            blocks = [tile[1]] * len(g) + [tile[2]] * len(g), [tile[2]] * len(g) + [tile[1]] * len(g)
            g, h, value = np.concatenate([g, h]), np.concatenate([h, g]), np.concatenate([value, value])
        else:
            blocks = [tile[1]] * len(g), [tile[2]] * len(g)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([tile[0]] * len(g), pa.string()),
                *(pa.array(b, pa.int32()) for b in blocks),
                pa.array(g, pa.int32()),
                pa.array(h, pa.int32()),
                pa.array(value, pa.int64()),
            ],
            names=["lang", "block", "peer_block", "slot", "peer_slot", "value"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column(0).dictionary_encode()
        numbers = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 8)]
        keys = np.stack([langs.indices.to_numpy(zero_copy_only=False), *numbers[:3]], axis=1)
        change = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(change, change[1:]):
            now = (langs[a].as_py(), *keys[a, 1:].tolist())
            if now != tile:
                yield from finish()
                tile, sums, zeros, kept, held = now, None, [], [], 0
            term, side, slot, share = (n[a:b] for n in numbers[3:])
            first = term < 0
            zeros += zip(side[first].tolist(), slot[first].tolist(), share[first].tolist())
            kept.append(np.stack([term[~first], side[~first], slot[~first], share[~first]], axis=1))
            held += len(kept[-1])
            if held > _ROWS:
                kept = scatter(np.concatenate(kept), False)
                held = len(kept[0])
    yield from finish()


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group.

    Tasks count before anything is shuffled. Every occurring group has a row
    with an empty term, so that groups without terms are known too.
    """
    prepare(documents.sparkSession)
    empty = F.lit("")
    rows = documents.select(
        F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source"), F.encode(F.coalesce(F.col(text), empty), "UTF-8").alias("text")
    )
    found = rows.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def source_divergence(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = 10,
    top_terms: int = 10,
    block: int = 512,
    part_terms: int = 20_000,
) -> DataFrame:
    """(lang, source, part, item, value, rank): the peers and the terms from which every source differs most.

    A language keeps the terms of at least ``min_documents`` of its documents
    (rows; repeated rows count). A group, that is a source within a language,
    gives a kept term the share 1 + floor(10**9 (count + 2) / (all + 2 terms)),
    as does the language itself, and two shares p, q differ by floor((p - q)**2
    / (p + q)). Part ``pair`` ranks all other sources of the language by the sum
    over all kept terms, part ``term`` the first ``top_terms`` kept terms that the
    source has and uses more than its language does. Ties go by item in UTF-8
    order. Null text, lang and source count as empty; a source alone in its
    language has no pair, one without kept terms has pairs of their zero
    shares; an empty table gives no rows. Other columns are not read.

    Sources of a language are numbered in blocks of ``block``; two blocks are a
    tile whose sums are one dense array of that size squared, whatever the
    corpus. A tile is dealt out in parts of about ``part_terms`` terms, each a
    task's share, and the parts' sums are added by Spark. The result itself has
    a row for every pair of sources of a language.
    """
    spark = documents.sparkSession
    counts = stored(term_counts(documents, text, lang, source), "term-counts")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n"), F.collect_list(F.struct("source", "n")).alias("postings"))
    index = kept.where(F.col("docs") >= min_documents).select(F.monotonically_increasing_id().alias("term_id"), "lang", "term", "all_n", "postings")
    index = stored(index, "term-index")

    postings = index.select("lang", "term_id", "term", "all_n", F.explode("postings").alias("p")).select("lang", "term_id", "term", "all_n", "p.source", "p.n")
    languages = index.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("lang_total"))
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        counts.where("term = ''").select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .fillna(0, ["total", "terms", "lang_total"])
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        .withColumn("block", F.floor(F.col("number") / block).cast("int"))
        .withColumn("slot", (F.col("number") % block).cast("int"))
        .withColumn("blocks", (F.max("block").over(Window.partitionBy("lang")) + 1).cast("int"))
        # A language without kept terms has no shares; any positive number stands in.
        .withColumn("zero", F.when(F.col("terms") > 0, _share(F.lit(0), "total", "terms")).otherwise(F.lit(1)))
    )
    groups = stored(groups.drop("number"), "groups")

    shared = postings.join(groups, ["lang", "source"]).withColumn("share", _share("n", "total", "terms"))
    shared = stored(shared.select("lang", "source", "term_id", "term", "all_n", "share", "terms", "lang_total", "block", "slot", "blocks"), "shares")
    parts = F.greatest(F.lit(1), F.ceil(F.col("terms") / part_terms)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    one, two = F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    side = (F.col("block") > F.col("other")).cast("int").alias("side")
    of_terms = shared.select("lang", "block", "slot", "share", "term_id", F.pmod(F.xxhash64("term_id"), parts).cast("int").alias("part"), other)
    of_terms = of_terms.select("lang", one, two, "part", F.col("term_id").alias("term"), side, "slot", "share")
    of_groups = groups.select("lang", "block", "slot", "zero", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "blocks")
    of_groups = of_groups.select("lang", "block", "slot", "zero", "part", other)
    of_groups = of_groups.select("lang", one, two, "part", F.lit(-1).cast("long").alias("term"), side, "slot", F.col("zero").alias("share"))
    tiles = of_groups.union(of_terms).repartition(*_TILE).sortWithinPartitions(*_TILE, "term")
    sums = tiles.mapInArrow(_tile_sums, "lang string, block int, peer_block int, slot int, peer_slot int, value long")
    sums = stored(sums.groupBy("lang", "block", "peer_block", "slot", "peer_slot").agg(F.sum("value").alias("extra")), "pair-sums")

    mine = groups.select("lang", "source", "block", "slot", "zero", "terms", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("peer_block"))
    peers = groups.select("lang", F.col("source").alias("item"), F.col("block").alias("peer_block"), F.col("slot").alias("peer_slot"), F.col("zero").alias("peer_zero"))
    pairs = mine.join(peers, ["lang", "peer_block"]).where("source <> item").join(sums, ["lang", "block", "peer_block", "slot", "peer_slot"], "left")
    value = F.coalesce("extra", F.lit(0)) + F.col("terms") * _distance("zero", "peer_zero")
    per_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn("rank", F.row_number().over(per_group))

    own = shared.withColumn("q", _share("all_n", "lang_total", "terms")).where("share > q")
    own = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance("share", "q").cast("long").alias("value"))
    own = own.withColumn("rank", F.row_number().over(per_group)).where(F.col("rank") <= top_terms)
    return ranked.union(own)
