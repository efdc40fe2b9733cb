"""Audit of candidate SQL statements held in a table.

A statement passes if it is one SELECT (or WITH) that uses no forbidden word and
reads only allowed tables; a passing statement without a limit gets one. Rules
apply in that order and the first one broken is the reason. The check works on
the text alone, with these known limits: only the first table after FROM or JOIN
is seen, words inside literals count, ``extract(hour from c)`` reads as table
``c``, and a LIMIT behind a line break is not recognised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_CAP = 200

# Words that reject a statement.
FORBIDDEN = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "DROP",
    "ALTER",
    "CREATE",
    "TRUNCATE",
    "REPLACE",
    "MERGE",
    "GRANT",
    "REVOKE",
    "ATTACH",
    "DETACH",
    "COPY",
    "EXPORT",
    "IMPORT",
    "PRAGMA",
    "SET",
    "RESET",
    "CALL",
    "VACUUM",
    "INSTALL",
    "LOAD",
    "READ_CSV",
    "READ_CSV_AUTO",
    "READ_JSON",
    "READ_JSON_AUTO",
    "READ_PARQUET",
    "READ_NDJSON",
    "GLOB",
    "SQLITE_SCAN",
    "POSTGRES_SCAN",
    "MYSQL_SCAN",
    "HTTPFS",
)

#: White space of any script, as a part of a character class; Java's own class knows ASCII only.
SPACE_CHARACTERS = r"\x09-\x0d\x1c-\x20\x85\xa0  -     　"
_SPACE = f"[{SPACE_CHARACTERS}]"

# Patterns for table references, names of common table expressions and fenced code.
TABLE_REFERENCE = rf"(?iU)\b(?:FROM|JOIN){_SPACE}+([a-zA-Z_][a-zA-Z0-9_\.]*)"
CTE_NAME = rf"(?iU)\b(\w+){_SPACE}+AS{_SPACE}*\("
FENCED_SQL = rf"(?is)```(?:sql)?{_SPACE}*(.*?)```"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{_SPACE}+|{_SPACE}+$", "")


def audit_sql(df: DataFrame, sql_col: str, allowed: list[str]) -> DataFrame:
    """Add ``verdict`` (allowed or rejected), ``reason`` and ``safe_sql``."""
    trimmed = _strip(F.col(sql_col))
    statement = F.when(trimmed.endswith(";"), _strip(F.expr("substring(_t, 1, length(_t) - 1)"))).otherwise(F.col("_t"))
    words = F.col("_upper")
    word = F.regexp_extract(words, rf"(?U)\b({'|'.join(FORBIDDEN)})\b", 1)
    read = F.array_distinct(F.transform(F.regexp_extract_all("_s", F.lit(TABLE_REFERENCE), 1), F.lower))
    named = F.transform(F.regexp_extract_all("_s", F.lit(CTE_NAME), 1), F.lower)
    unknown = F.array_except(F.array_except(read, F.array(*[F.lit(a.lower()) for a in allowed])), named)
    reason = (
        F.when(F.col(sql_col).isNull(), F.lit("no statement"))
        .when(F.col("_s").contains(";"), F.lit("multiple statements are not allowed"))
        .when(
            ~F.regexp_extract(words, rf"^([^{SPACE_CHARACTERS}]*)", 1).isin("SELECT", "WITH"),
            F.lit("only SELECT / WITH queries are allowed"),
        )
        .when(F.col("_word") != "", F.concat(F.lit("forbidden keyword or function: "), F.col("_word")))
        .when(
            F.size("_unknown") > 0,
            F.concat(F.lit("query references a table outside the allowed schema: "), F.get("_unknown", F.lit(0))),
        )
    )
    has_limit = F.concat(F.lit(" "), words, F.lit(" ")).contains(" LIMIT ")
    capped = F.when(has_limit, F.col("_s")).otherwise(F.concat(F.col("_s"), F.lit(f"\nLIMIT {ROW_CAP}")))
    return (
        df.withColumn("_t", trimmed)
        .withColumn("_s", statement)
        .withColumn("_upper", F.upper("_s"))
        .withColumns({"_word": word, "_unknown": unknown})
        .withColumn("reason", reason)
        .withColumn("verdict", F.when(F.col("reason").isNull(), "allowed").otherwise("rejected"))
        .withColumn("safe_sql", F.when(F.col("reason").isNull(), capped))
        .drop("_t", "_s", "_upper", "_word", "_unknown")
    )


def extract_sql(df: DataFrame, reply_col: str) -> DataFrame:
    """Add ``sql``, ``explanation`` and ``parsed`` from text replies.

    A reply that is one strict JSON object whose ``sql`` is text counts first,
    then the first fenced block; anything else is not parsed.
    """
    # In brackets, a reply is valid JSON of one element only if it is one JSON text as a whole.
    whole = F.try_parse_json(F.concat(F.lit("["), F.col(reply_col), F.lit("]")))
    kind = F.schema_of_variant(F.try_variant_get(whole, "$[0].sql", "variant"))
    strict = F.try_variant_get(whole, "$[1]", "variant").isNull() & (kind == "STRING")
    said = F.when(strict, F.try_variant_get(whole, "$[0].sql", "string"))
    block = F.when(F.col(reply_col).rlike(FENCED_SQL), _strip(F.regexp_extract(reply_col, FENCED_SQL, 1)))
    explained = F.when(said.isNotNull(), F.try_variant_get(whole, "$[0].explanation", "string"))
    sql = F.coalesce(said, block)
    return df.withColumns(
        {
            "sql": sql,
            "explanation": F.when(sql.isNotNull(), F.coalesce(explained, F.lit(""))),
            "parsed": sql.isNotNull(),
        }
    )
