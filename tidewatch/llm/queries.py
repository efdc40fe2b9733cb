"""The registered query of every operator in this subpackage, and its check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    chat,
    collocations,
    decontaminate,
    divergence,
    fingerprints,
    html_text,
    jaccard_join,
    language,
    line_dedup,
    pieces,
    quality,
    toxicity,
    url_lists,
)
from tidewatch.llm.common import in_fold

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public vocabulary file of the contract; the operator itself takes any model's bytes."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokenizer_model() -> bytes:
    with open(tokenizer_path(), "rb") as file:
        return file.read()


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    model = toxicity.fit_toxicity(documents, table(spark, sf_dir, "labels"), ~held_out)
    scored = documents.select("doc_id", held_out.alias("held_out"), toxicity.toxicity_score(model, documents).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = quality.fit_quality(documents, table(spark, sf_dir, "labels"), ~held_out)
    scored = documents.select("doc_id", held_out.alias("held_out"), quality.quality_score(model, documents).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures; every page's host or first path step as a dated list entry."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, page_id * 7919 % 31536000)"))
    host = F.regexp_extract("url", "://([^/?#]+)", 1)
    step = F.regexp_extract("url", "://[^/?#]+/([^/?#]+)", 1)
    entries = pages.select(
        F.when(F.col("page_id") % 2 == 0, host).otherwise(F.concat(host, F.lit("/"), step)).alias("pattern"),
        F.expr("CASE page_id % 5 WHEN 0 THEN 'remove' WHEN 1 THEN 'allow' ELSE 'block' END").alias("action"),
        F.expr("date_add(date'2024-01-01', cast(page_id * 31 % 400 AS int) - 30)").alias("dated"),
    )
    found = url_lists.filter_captures(captures, entries)
    return found.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


OP3_SQL = r"""
WITH captures AS (
  SELECT page_id, url, timestamp '2024-01-01 00:00:00' + to_seconds(page_id * 7919 % 31536000) AS fetched_at,
         regexp_extract(lower(url), '://([^/?#]+)', 1) AS host,
         list_filter(string_split(regexp_extract(lower(url), '://[^/?#]+(/[^?#]*)?', 1), '/'), lambda s: s <> '') AS steps
  FROM pages),
entries AS (
  SELECT lower(CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '://([^/?#]+)', 1)
              ELSE regexp_extract(url, '://([^/?#]+)', 1) || '/' || regexp_extract(url, '://[^/?#]+/([^/?#]+)', 1) END) AS pattern,
         CASE page_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS strength,
         date '2024-01-01' + (page_id * 31 % 400 - 30)::INTEGER AS day
  FROM pages),
daily AS (SELECT pattern, day, max(strength) AS strength FROM entries GROUP BY ALL),
cover AS (
  SELECT page_id, fetched_at, host || '/' || array_to_string(steps[1:n], '/') AS pattern, 1000 - n AS place
  FROM captures, unnest(range(1, len(steps) + 1)) AS t(n)
  UNION ALL
  SELECT page_id, fetched_at, array_to_string(string_split(host, '.')[n:], '.'), 1000 + n
  FROM captures, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS t(n)),
latest AS (
  SELECT page_id, place, pattern, arg_max(strength, day) AS strength, max(day) AS day
  FROM cover JOIN daily USING (pattern) WHERE day <= fetched_at::DATE GROUP BY ALL),
decided AS (
  SELECT page_id, arg_min(pattern, place) AS pattern, arg_min(strength, place) AS strength, arg_min(day, place) AS day
  FROM latest WHERE strength > 1 GROUP BY page_id)
SELECT c.page_id, c.url, c.fetched_at, d.pattern AS matched_pattern,
       CASE d.strength WHEN 3 THEN 'block' WHEN 2 THEN 'allow' END AS action, d.day AS listed_since, coalesce(d.strength = 3, false) AS blocked
FROM captures c LEFT JOIN decided d USING (page_id)
"""


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprint_neighbours(table(spark, sf_dir, "documents"))
    return found.withColumn("edited_sha256", F.sha2(F.encode("edited_text", "UTF-8"), 256)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


OP5_SQL = r"""
WITH item AS (
  SELECT DISTINCT item_id::VARCHAR AS item, w, len(w) AS n, least(len(w), 13) AS k
  FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS words FROM item, unnest(range(1, n - k + 2)) AS t(i)),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
place AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM doc, (SELECT DISTINCT k FROM win), unnest(range(1, len(w) - k + 2)) AS t(i)),
occ AS (SELECT DISTINCT doc_id, i, k, item FROM place JOIN win USING (k, words)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = language.fit_languages(documents, ~held_out)
    scored = documents.select("doc_id", held_out.alias("held_out"), language.language_of(model, documents).alias("found"))
    return scored.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    encoded = documents.select("doc_id", pieces.encode_pieces(documents, tokenizer_model()).alias("found"))
    return encoded.select(
        "doc_id",
        F.floor(F.octet_length("found.ids") / 4).alias("n_tokens"),
        F.sha2("found.ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("found.decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "keeper", "n_links", "n_text_links")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", html_text.extract_text(pages).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("kept_text").alias("text"), "n_dropped")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one that says control strings; all figures are read back from the formatted text."""
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    formatted = chat.format_chats(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more))
    read = formatted.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(told, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP11_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) AS t(n)),
placed AS (
  SELECT *, coalesce(lag(role) OVER w = role, false) AS goes_on, coalesce(lead(role) OVER w = role, false) AS stays,
         CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 5 ELSE 16 + 2 * strlen(role) END AS marks,
         CASE role WHEN 'user' THEN 7 WHEN 'system' THEN 6 WHEN 'assistant' THEN 1 ELSE 8 + 2 * strlen(role) END AS opening,
         len(text) + len(regexp_extract_all(text, '[\[<]\\*(/?INST\]|/?SYS\]|NEXT\]|ROLE:[0-9A-F]*\]|/ROLE\]|/s>)')) AS escaped
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(escaped + CASE WHEN goes_on THEN 6 ELSE opening END + CASE WHEN stays THEN 0 ELSE marks - opening END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
word AS (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM words),
run AS (
  SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4, lead(w1, 4) OVER p AS w5
  FROM word WINDOW p AS (PARTITION BY id ORDER BY i)),
often AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS p, a::HUGEINT AS a FROM (
    SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM run GROUP BY ALL
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM run WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM run WHERE w3 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM run WHERE w4 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, count(*) FROM run WHERE w5 IS NOT NULL GROUP BY ALL)
  WHERE a >= 100),
part AS (
  SELECT lang, phrase, a, j, array_to_string(p[1:j], ' ') AS head, array_to_string(p[j + 1:k], ' ') AS tail
  FROM often, unnest(range(1, k)) AS t(j)),
cut AS (
  SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r, n, 1000 * c.a * n // (x.a * y.a) AS score
  FROM part c JOIN often x ON x.lang = c.lang AND x.phrase = c.head JOIN often y ON y.lang = c.lang AND y.phrase = c.tail JOIN total ON total.lang = c.lang),
weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_part AS (
  SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS outer_a
  FROM often, unnest(range(2, k)) AS s(m), unnest(range(1, k - m + 2)) AS t(i) GROUP BY ALL),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weakest w LEFT JOIN inner_part USING (lang, phrase) WHERE outer_a IS NULL OR outer_a < a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
token AS (SELECT row, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS all_n FROM token GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
language AS (SELECT lang, count(*) AS v, sum(all_n) AS all_total FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM token SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, any_value(all_total) AS all_total, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN language USING (lang) LEFT JOIN counted USING (lang, source) GROUP BY lang, source),
share AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (all_n + 2)) // (all_total + 2 * v) AS q
  FROM grp JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM share WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pair UNION ALL FROM term))
WHERE part = 'pair' OR rank <= 10
"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_quality, op3_url_filters, op4_fingerprints, op5_decontaminate,
        op6_language, op7_sentencepiece, op8_jaccard_join, op9_html_extraction, op10_line_dedup,
        op11_chat_format, op12_collocations, op13_source_divergence,
    )
}
SQL = {
    "op3_url_filters": OP3_SQL,
    "op5_decontaminate": OP5_SQL,
    "op11_chat_format": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
