"""Statement audit: the fixed cases and the known limits of a text check."""

import pytest

from tidewatch.operators import statements

ALLOWED = [p + t for t in ("fct_vessel_positions", "fct_ais_anomalies", "dim_vessels", "dim_ports") for p in ("", "gold.")]

# (statement, None if allowed else start of the reason)
CASES = [
    ("SELECT vessel_key, count(*) FROM gold.fct_vessel_positions GROUP BY 1", None),
    ("WITH risky AS (SELECT * FROM gold.fct_ais_anomalies WHERE risk_score > 80) SELECT * FROM risky", None),
    ("select port_name from gold.dim_ports where harbor_size = 'Large'", None),
    ("SELECT 1 FROM gold.dim_ports; DROP TABLE gold.dim_ports;", "multiple"),
    ("SELECT 1 FROM gold.dim_vessels WHERE 1=1; DELETE FROM gold.dim_vessels", "multiple"),
    ("UPDATE gold.dim_vessels SET vessel_name = 'x'", "only SELECT"),
    ("INSERT INTO gold.dim_ports VALUES (1)", "only SELECT"),
    ("ATTACH '/tmp/file' AS other", "only SELECT"),
    ("PRAGMA database_list", "only SELECT"),
    ("SELECT * FROM read_csv('/tmp/file')", "forbidden keyword or function: READ_CSV"),
    ("SELECT * FROM read_json_auto('https://host.example/x')", "forbidden keyword or function: READ_JSON_AUTO"),
    ("SELECT * FROM glob('/tmp/**')", "forbidden keyword or function: GLOB"),
    ("COPY (SELECT * FROM gold.dim_ports) TO '/tmp/out.csv'", "only SELECT"),
    ("SELECT * FROM bronze.raw_vessel_positions", "query references a table outside"),
    ("SELECT * FROM information_schema.tables", "query references a table outside"),
    ("SELECT * FROM main.other.secrets", "query references a table outside"),
    # known limits
    ("SELECT * FROM gold.dim_ports, hidden", None),
    ('SELECT * FROM "hidden"', None),
    ("SELECT extract(hour from position_ts) FROM gold.fct_vessel_positions", "query references a table outside"),
    ("SELECT 'drop it' AS note FROM gold.dim_ports", "forbidden keyword or function: DROP"),
    ("SELECT dropped, offset_m FROM gold.dim_ports", None),
    # edges
    ("", "only SELECT"),
    ("   ;  ", "only SELECT"),
    ("  SELECT * FROM dim_ports ;  ", None),
    ("select * from DIM_PORTS join GOLD.dim_vessels on true", None),
    (None, "no statement"),
]


def test_audit(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    rows = statements.audit_sql(df, "s", ALLOWED).orderBy("i").collect()
    for (text, reason), row in zip(CASES, rows):
        if reason is None:
            assert row.verdict == "allowed" and row.reason is None, text
        else:
            assert row.verdict == "rejected" and row.reason.startswith(reason), (text, row.reason)
            assert row.safe_sql is None


@pytest.mark.parametrize(
    "text, safe",
    [
        ("SELECT * FROM gold.dim_ports", "SELECT * FROM gold.dim_ports\nLIMIT 200"),
        ("select * from gold.dim_ports limit 5;", "select * from gold.dim_ports limit 5"),
        ("select * from gold.dim_ports\nlimit 5", "select * from gold.dim_ports\nlimit 5\nLIMIT 200"),
    ],
)
def test_row_cap(spark, text, safe):
    df = spark.createDataFrame([(text,)], "s string")
    assert statements.audit_sql(df, "s", ALLOWED).first().safe_sql == safe


def test_forbidden_words_are_complete():
    assert len(statements.FORBIDDEN) == len(set(statements.FORBIDDEN)) == 34


def test_extract(spark):
    replies = [
        '{"sql": "select 1", "explanation": "one"}',
        '{"sql": "select 2"}',
        "Sure:\n```sql\nselect 3\n```",
        "```\nselect 4```",
        '{"explanation": "none"}',
        "no statement here",
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string")
    rows = statements.extract_sql(df, "r").orderBy("i").collect()
    assert [r.sql for r in rows] == ["select 1", "select 2", "select 3", "select 4", None, None]
    assert [r.parsed for r in rows] == [True] * 4 + [False] * 2
    assert rows[0].explanation == "one" and rows[2].explanation == ""
