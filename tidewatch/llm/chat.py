"""Chat formatting: the turns of a conversation as one marked text with its loss mask, by Spark expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What opens and what closes the turns of a role; any other role is ``[ROLE:hex of its name] text [/ROLE]``.
ROLE_MARKS = {
    "system": ("[SYS] ", " [/SYS]"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", "</s>"),
}
#: Between two texts of adjacent turns of one role.
NEXT_MARK = "[NEXT]"
_NAMES = r"/?INST\]|/?SYS\]|NEXT\]|ROLE:[0-9A-F]*\]|/ROLE\]|/s>"
#: A control string with any number of backslashes after its first character.
_PLAIN = rf"([\[<])(\\*)({_NAMES})"
_ESCAPED = rf"([\[<])\\(\\*)({_NAMES})"
_BLOCK = r"(?s)\G(?:\[INST\] .*? \[/INST\]|\[SYS\] .*? \[/SYS\]|\[ROLE:[0-9A-F]*\] .*? \[/ROLE\]| .*?</s>)"


def escape(text: Column) -> Column:
    """A text without control strings: each one, backslashes or not, gets one more backslash after its first character."""
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _opening(role: Column) -> Column:
    out = F.concat(F.lit("[ROLE:"), F.hex(F.encode(role, "UTF-8")), F.lit("] "))
    for name, (mark, _) in ROLE_MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(" [/ROLE]")
    for name, (_, mark) in ROLE_MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _sums_before(numbers: Column) -> Column:
    """For every number the sum of those before it, by doubling steps: n log n, without arrays that grow by one."""

    def step(sums: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k).cast("int")
        return F.transform(sums, lambda x, i: x + F.when(i >= back, F.get(sums, i - back)).otherwise(F.lit(0).cast("long")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int"))
    return F.transform(F.aggregate(steps, numbers, step), lambda x, i: x - F.get(numbers, i))


def format_chats(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant"
) -> DataFrame:
    """(conv, messages, formatted, loss_spans), one row per conversation id.

    Turns are sorted by number (nulls last), then role and text; repeated rows
    are turns of their own. A null role counts as an empty one, a null text as
    empty. Rows without an id form one conversation with a null id. Other
    columns are not read; an empty table gives no rows.

    ``messages`` has one (role, texts) for every run of adjacent turns of one
    role, its texts escaped. In ``formatted`` a message stands between the marks
    of its role, its texts parted by ``[NEXT]``, so that single turns can be
    read back. ``loss_spans`` says where the texts of ``learn`` are, without
    marks: start and n_chars in code points, byte_start and n_bytes in UTF-8.

    Texts move once, to their conversation. A conversation is one value and has
    to fit in one, that is in 2 GB; time grows with its length.
    """
    number = F.struct(F.col(turn).isNull().alias("none"), F.col(turn).alias("turn"))
    row = F.struct(number.alias("number"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = conversations.select(F.col(conv).alias("conv"), row.alias("row")).groupBy("conv").agg(F.array_sort(F.collect_list("row")).alias("turns"))

    def opens(i: Column) -> Column:
        return (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])

    starts = turns.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), opens))

    def message(start: Column, k: Column) -> Column:
        many = F.coalesce(F.get("starts", k + 1), F.size("turns")) - start
        texts = F.transform(F.slice("turns", start + 1, many), lambda t: escape(t["text"]))
        return F.struct(F.get("turns", start)["role"].alias("role"), texts.alias("texts"))

    merged = starts.select("conv", F.transform("starts", message).alias("messages"))
    blocks = F.transform("messages", lambda m: F.concat(_opening(m["role"]), F.array_join(m["texts"], NEXT_MARK), _closing(m["role"])))
    merged = merged.withColumn("blocks", blocks)
    merged = merged.select(
        "conv",
        "messages",
        F.array_join("blocks", "").alias("formatted"),
        _sums_before(F.transform("blocks", lambda b: F.length(b).cast("long"))).alias("chars"),
        _sums_before(F.transform("blocks", lambda b: F.octet_length(b).cast("long"))).alias("bytes"),
    )

    def spans(m: Column, i: Column) -> Column:
        opening, mark = _opening(m["role"]), len(NEXT_MARK)
        n_chars = F.transform(m["texts"], lambda t: F.length(t).cast("long"))
        n_bytes = F.transform(m["texts"], lambda t: F.octet_length(t).cast("long"))
        places = F.arrays_zip(
            _sums_before(F.transform(n_chars, lambda n: n + mark)).alias("a"), n_chars.alias("b"), _sums_before(F.transform(n_bytes, lambda n: n + mark)).alias("c"), n_bytes.alias("d")
        )
        return F.transform(
            places,
            lambda p: F.struct(
                (F.get("chars", i) + F.length(opening) + p["a"]).alias("start"),
                p["b"].alias("n_chars"),
                (F.get("bytes", i) + F.octet_length(opening) + p["c"]).alias("byte_start"),
                p["d"].alias("n_bytes"),
            ),
        )

    nothing = F.slice(spans(F.get("messages", F.lit(0)), F.lit(0)), 1, 0)
    found = F.flatten(F.transform("messages", lambda m, i: F.when(m["role"] == learn, spans(m, i)).otherwise(nothing)))
    return merged.select(F.col("conv").alias(conv), "messages", "formatted", found.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of every turn in a formatted conversation, as they were before: the inverse of ``format_chats``."""

    def turns(block: Column) -> Column:
        name = F.regexp_extract(block, r"^\[ROLE:([0-9A-F]*)\] ", 1)
        role, opening, closing = F.decode(F.unhex(name), "UTF-8"), F.length(name) + len("[ROLE:] "), F.lit(len(" [/ROLE]"))
        for known, (first, last) in ROLE_MARKS.items():
            here = F.startswith(block, F.lit(first))
            role = F.when(here, F.lit(known)).otherwise(role)
            opening = F.when(here, F.lit(len(first))).otherwise(opening)
            closing = F.when(here, F.lit(len(last))).otherwise(closing)
        texts = F.split(F.substr(block, opening + 1, F.length(block) - opening - closing), r"\[NEXT\]", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0)), turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""

    def cut(whole: Column) -> Column:
        return F.transform(spans, lambda s: unescape(F.decode(F.substring(whole, (s["byte_start"] + 1).cast("int"), s["n_bytes"].cast("int")), "UTF-8")))

    # The whole text is bound once and not encoded again for every span.
    return F.get(F.transform(F.array(F.encode(formatted, "UTF-8")), cut), F.lit(0))
