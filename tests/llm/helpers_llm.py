"""Rows that every text operator must survive."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, h long"
LONG = "word salad of very many words " * 4000


def awkward(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows and clashing column names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog, twice a day.\nSecond line here", "en", "a", 5, 0.1, "k", 1),
        (1, "The quick brown fox jumps over the lazy dog, twice a day.\nSecond line here", "en", "a", 5, 0.1, "k", 1),
        (2, "The quick brown fox jumps over the lazy dog, twice a day.\nSecond line here", None, None, None, None, None, None),
        (3, None, "en", "a", None, None, None, 0),
        (4, "", "de", "a", 0, None, None, 0),
        (5, " \n\t\n ", None, "b", 5, None, None, 0),
        (6, "¿¡!! ... ---", None, "b", 5, None, None, 0),
        (7, LONG, "en", "b", len(LONG), 9.0, "", -1),
        (8, "Ärger über Öl 😀 straße\x00end ▁▁ mark", "de", "c", 3, None, "x", 2),
        (None, "no id at all but some words in a row", None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
        (9, "a", "fr", "c", 1, 1.0, "y", 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
