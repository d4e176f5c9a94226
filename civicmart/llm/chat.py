"""Chat formatting with Spark expressions only.

A conversation becomes one text: its turn structs are collected and sorted, adjacent turns of
one role are merged by an array aggregation, and the pieces are concatenated.

    <s>[INST]role[/INST]text[SEP]text of the next turn of that role</s><s>[INST]...

Control strings inside roles and texts are escaped: a backslash goes behind the bracket that
opens one, and where backslashes stand there already, one more. ``loss_spans`` says which
characters (code points) of the text are the assistant's.

Defined results. Null texts and roles count as empty. Turns are ordered by (turn, role, text),
null turns first; a repeated row is a turn of its own. A null ``conv_id`` is a conversation of
its own. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings hold no bracket but the one that opens them, so none can arise where a text
# meets a control string.
BEGIN, END, ROLE_END, NEXT = "<s>[INST]", "</s>", "[/INST]", "[SEP]"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|SEP\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\]|SEP\])"
# Turns whose offsets are summed up at a time, see ``_offsets``.
BLOCK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _running(values: Column, start: Column) -> Column:
    """For each value ``start`` and the sum of those before it."""
    empty = F.struct(start.cast("bigint").alias("off"), F.array().cast("array<bigint>").alias("sums"))
    add = lambda s, x: F.struct((s["off"] + x).alias("off"), F.concat(s["sums"], F.array(s["off"])).alias("sums"))
    return F.aggregate(values, empty, add, lambda s: s["sums"])


def _offsets(lengths: Column) -> Column:
    """Where each piece begins. Sums run over blocks of pieces first and then inside each block: an
    array that grows by one element a step is copied as often, and is never long here."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(starts, lambda i: F.slice(lengths, i, BLOCK))
    zero = F.lit(0).cast("bigint")
    totals = F.transform(blocks, lambda block: F.aggregate(block, zero, lambda s, x: s + x))
    bases = _running(totals, zero)
    return F.flatten(F.zip_with(blocks, bases, _running))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): spans of (start, n), start counted from 0.

    Turns are ordered as they came and escaped after. Each piece depends on its own turn and the
    role before it, so pieces are one ``transform`` over the sorted turns.
    """
    known = lambda name: F.coalesce(name, F.lit("")).alias(name)
    rows = turns.select("conv_id", F.struct("turn", known("role"), known("text")).alias("turn"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))

    def piece(turn: Column, i: Column) -> Column:
        opened = F.concat(F.lit(BEGIN), escape(turn["role"]), F.lit(ROLE_END))
        # Only looked at where there is one before.
        last = F.get("turns", i - 1)["role"]
        before = F.when(i == 0, opened).when(last == turn["role"], F.lit(NEXT)).otherwise(F.concat(F.lit(END), opened))
        text = escape(turn["text"])
        return F.struct(
            F.concat(before, text).alias("piece"),
            F.length(before).cast("bigint").alias("lead"),
            F.length(text).cast("bigint").alias("n"),
            (turn["role"] == "assistant").alias("masked"),
        )

    chats = chats.select("conv_id", F.transform("turns", piece).alias("pieces"))
    chats = chats.withColumn("lengths", F.transform("pieces", lambda p: p["lead"] + p["n"]))
    chats = chats.withColumn("offsets", _offsets(F.col("lengths")))
    span = lambda p, off: F.struct((off + p["lead"]).alias("start"), p["n"].alias("n"), p["masked"].alias("masked"))
    spans = F.filter(F.zip_with("pieces", "offsets", span), lambda s: s["masked"])
    return chats.select(
        "conv_id",
        F.concat(F.array_join(F.transform("pieces", lambda p: p["piece"]), ""), F.lit(END)).alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["n"].alias("n"))).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs of a formatted conversation, as they went in."""
    blocks = F.filter(F.split(formatted, END), lambda block: block != "")
    parted = F.transform(blocks, lambda block: F.split(block, r"\[/INST\]"))
    return F.flatten(
        F.transform(
            parted,
            lambda part: F.transform(
                F.split(part[1], r"\[SEP\]"),
                lambda text: F.struct(
                    unescape(F.substr(part[0], F.lit(len(BEGIN) + 1))).alias("role"), unescape(text).alias("text")
                ),
            ),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    cut = lambda span: unescape(F.substr(formatted, (span["start"] + 1).cast("int"), span["n"].cast("int")))
    return F.array_join(F.transform(spans, cut), "")


def chat_report(turns: DataFrame) -> DataFrame:
    """Digests of what is read back from the formatted conversations."""
    chats = format_chats(turns)
    back = chats.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
