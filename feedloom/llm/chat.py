"""Conversations to one training text each, with a loss mask, in Spark expressions only.

Template: each run of turns of one role is a message, ``<|im_start|>role``, a line break, the texts, ``<|im_end|>`` and a
line break; the texts of a message are parted by ``<|im_sep|>``, so every turn can be read back. A text never holds a
control string: each ``<`` followed by backslashes and ``|`` gets one backslash more, which is undone on reading.

Turns are ordered by turn, role and text. Null text or role: empty. A null conversation id is a conversation of its own.
Repeated rows are turns like any other. The loss mask covers the texts of assistant turns, without any template. No
rows: no rows out. A conversation is one value, so its turns have to fit one row; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, SEP, END, BREAK = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _split(text: Column, mark: str) -> Column:
    return F.split(text, mark.replace("|", r"\|"), -1)


def format_conversations(
    rows: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: str = LEARNED,
) -> DataFrame:
    """(conversation, formatted, loss): ``loss`` has (begin, end) of the learned texts in code points of ``formatted``."""
    texts = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    flat = rows.select(F.col(f"`{conversation}`").alias("id"), F.struct(
        F.col(f"`{turn}`").alias("turn"), texts(role).alias("role"), texts(text).alias("text")).alias("t"))
    grouped = flat.groupBy("id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    # every turn with whether its message begins and ends with it
    n = F.size("turns")
    roles = grouped.withColumn("roles", F.transform("turns", lambda t: t["role"]))
    marked = roles.select("id", F.transform("turns", lambda t, i: F.struct(
        (t["role"] == F.lit(learned)).alias("learn"),
        F.when((i > 0) & (F.get("roles", i - 1) == t["role"]), F.lit(SEP))
        .otherwise(F.concat(F.lit(START), F.replace(escape(t["role"]), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))).alias("head"),
        escape(t["text"]).alias("body"),
        F.when((i < n - 1) & (F.get("roles", i + 1) == t["role"]), F.lit("")).otherwise(F.lit(END)).alias("tail"),
    )).alias("parts"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans"))

    def place(got: Column, p: Column) -> Column:
        begin = got["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        here = F.array(F.struct(begin.cast("long").alias("begin"), end.cast("long").alias("end")))
        spans = F.when(p["learn"], F.concat(got["spans"], here)).otherwise(got["spans"])
        return F.struct((end + F.length(p["tail"])).cast("long").alias("at"), spans.alias("spans"))

    return marked.select(
        F.col("id").alias(conversation),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.aggregate("parts", start, place)["spans"].alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) of the turns that ``formatted`` was made of."""
    messages = F.filter(_split(formatted, END), lambda m: m != "")

    def turns(m: Column) -> Column:
        body = F.substring(m, F.lit(len(START) + 1), F.length(m))
        role = F.substring_index(body, "\n", 1)
        rest = F.substring(body, F.length(role) + 2, F.length(body))
        name = unescape(F.replace(role, F.lit(BREAK), F.lit("\n")))
        return F.transform(_split(rest, SEP), lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(messages, turns))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the mask, unescaped, nothing between its parts."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")))), "")
