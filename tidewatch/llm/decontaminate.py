"""Benchmark decontamination: exact containment of item-sized windows, by a prefix-filtered join on rare shingles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

#: After A-Z are lower-cased, these characters separate words.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shingle value of the one row that every document has whatever it holds.
_DOCUMENT = 0


def contract_words(text: Column) -> Column:
    """Words after lower-casing A-Z and nothing else; null has none."""
    text = F.coalesce(text, F.lit(""))
    # lower() is much faster and the same where every character is one byte.
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(lowered, SEPARATOR), lambda w: w != "")


def _shingles(hashes: str, q: int) -> Column:
    """Hashes of every ``q`` consecutive words, from an array of word hashes."""
    parts = ", ".join(f"get({hashes}, i + {k})" for k in range(q))
    return F.expr(
        f"CASE WHEN size({hashes}) >= {q} THEN transform(sequence(0, size({hashes}) - {q}), i -> xxhash64({parts}))"
        f" ELSE cast(array() AS array<bigint>) END"
    )


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    item: str = "item_id",
    window: int = 13,
    shingle: int = 5,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Per document row: the ``keep`` columns, text_key, n_words, n_hit and items.

    A window is ``window`` consecutive words of an item, or the whole item if it
    is shorter. ``n_hit`` counts the document's words inside any occurrence of a
    window, ``items`` lists the ids (as text, sorted) of the items with
    occurring windows. Items without words never occur; repeated items count
    once; a null id is listed as empty text. Null texts have no words. Equal
    texts are searched once.

    Shingles of ``shingle`` words (the whole item, if shorter) stand for words.
    One pass over the documents finds those that the benchmark has too; their
    number of places is their rarity. Every window is looked up by its rarest
    shingle alone, and not at all if one of its shingles occurs nowhere. The
    places found fix where an item would lie in a text; those that leave the
    text (length and position) go, the others are compared shingle by shingle,
    and runs as long as a window count. The benchmark's shingles are broadcast
    if there are at most ``broadcast_rows``, and joined by shuffle beyond it.
    """
    words = contract_words(F.col("_text"))
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    named = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("_text"))
    items = named.select("item", text_key(F.col("_text")).alias("ikey"), hashed.alias("w")).where(F.size("w") > 0).distinct()
    items = stored(items.select("item", "ikey", "w", F.size("w").alias("n"), F.least(F.size("w"), F.lit(shingle)).alias("q")), "items")
    lengths = sorted(r["q"] for r in items.select("q").distinct().collect())
    texts = items.select("ikey", "w", "n", "q").dropDuplicates(["ikey"])
    by_length = F.expr("cast(array() AS array<bigint>)")
    for q in lengths:
        by_length = F.when(F.col("q") == q, _shingles("w", q)).otherwise(by_length)
    parts = texts.select("ikey", "n", "q", F.posexplode(by_length).alias("ip", "h"))
    parts = stored(parts.withColumn("len", F.least("n", F.lit(window))), "item-shingles")
    wanted = parts.select("h").distinct().union(documents.sparkSession.sql(f"SELECT CAST({_DOCUMENT} AS BIGINT) AS h"))
    if parts.count() <= broadcast_rows:
        wanted = F.broadcast(wanted)

    source = documents.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kept = [f"_k{i}" for i in range(len(keep))]
    read = source.select(*kept, text_key(F.col("_text")).alias("text_key"), hashed.alias("w"))
    each = F.array(F.lit(_DOCUMENT).cast("long"))
    exploded = [
        read.select(*kept, "text_key", F.size("w").alias("n_words"), F.posexplode(F.concat(each, _shingles("w", q))).alias("at", "h"))
        for q in (lengths or [shingle])
    ]
    found = exploded[0].join(wanted, "h")
    for more in exploded[1:]:
        found = found.union(more.join(wanted, "h").where(F.col("h") != _DOCUMENT))
    found = stored(found.withColumn("pos", F.col("at") - 1), "found-shingles")

    rows = found.where(F.col("h") == _DOCUMENT).select(*kept, "text_key", "n_words")
    shared = found.where(F.col("h") != _DOCUMENT).select("text_key", "n_words", "pos", "h").distinct()
    shared = stored(shared, "shared-shingles")

    rarity = shared.groupBy("h").agg(F.count("*").alias("places"))
    # Windows start at every word but the last len - 1; the shingle at ip lies in those from ip - (len - q) to ip.
    in_windows = parts.withColumn("start", F.explode(F.expr("sequence(greatest(0, ip - (len - q)), least(ip, n - len))")))
    looked_up = (
        in_windows.join(rarity, "h")
        .groupBy("ikey", "start", "n", "q", "len")
        .agg(F.count("*").alias("known"), F.min(F.struct("places", "h", "ip")).alias("rarest"))
        .where(F.col("known") == F.col("len") - F.col("q") + 1)
        .select("ikey", "n", "q", "len", "rarest.h", "rarest.ip")
        .distinct()
    )
    candidates = (
        shared.join(looked_up, "h")
        .withColumn("shift", F.col("pos") - F.col("ip"))
        .where("n_words >= len AND shift + least(ip, n - len) >= 0 AND shift + greatest(0, ip - (len - q)) + len <= n_words")
        .select("text_key", "ikey", "shift", "n_words")
        .distinct()
    )
    expected = (
        candidates.join(parts, "ikey")
        .withColumn("pos", F.col("shift") + F.col("ip"))
        .where("pos >= 0 AND pos + q <= n_words")
        .select("text_key", "pos", "h", "ikey", "shift", "ip", "q", "len")
    )
    matched = expected.join(shared.select("text_key", "pos", "h"), ["text_key", "pos", "h"])
    numbered = matched.selectExpr(
        "*", "ip - row_number() OVER (PARTITION BY text_key, ikey, shift ORDER BY ip) AS run"
    )
    runs = (
        numbered.groupBy("text_key", "ikey", "shift", "run", "q", "len")
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        .where("last - first + q >= len")
        .select("text_key", "ikey", "first", F.expr("last + q - 1 AS last"))
    )
    runs = stored(runs, "occurrences")
    hit = runs.select("text_key", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("text_key").agg(F.count("*").alias("n_hit"))
    listed = (
        runs.select("text_key", "ikey")
        .distinct()
        .join(items.select("ikey", "item"), "ikey")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    results = stored(hit.join(listed, "text_key"), "contaminated")
    return rows.join(results, "text_key", "left").select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() AS array<string>)")).alias("items"),
    )


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty lies in an occurrence."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents whose texts are not contaminated, columns and order of columns as before."""
    found = find_contamination(documents, benchmark, keep=(), text=text)
    bad = found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("text_key").alias("_tw_bad")).distinct()
    return documents.join(stored(bad, "bad-texts"), text_key(F.col(text)) == F.col("_tw_bad"), "left_anti")
