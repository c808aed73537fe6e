"""Chat formatting by Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings. Every one starts with OPEN, which no escaped text contains.
OPEN = "<|"
ROLE, TEXT, TURN, END = "<|role|>", "<|text|>", "<|turn|>", "<|end|>"


#: Parts of a conversation that are placed in one fold.
CHUNK = 512


def escape(text: Column) -> Column:
    """`text` without control strings: backslash becomes \\0, then <| becomes \\1."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit(OPEN), F.lit("\\1"))


def unescape(text: Column) -> Column:
    """The inverse of `escape`: every backslash of an escaped text stands before 0 or 1."""
    return F.replace(F.replace(text, F.lit("\\1"), F.lit(OPEN)), F.lit("\\0"), F.lit("\\"))


def _literally(control: str) -> str:
    return f"\\Q{control}\\E"


def format_chats(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): one row for each conv_id of `turns` (conv_id, turn, role, text).

    The turns of a conversation are collected as structs and sorted; adjacent turns of one role merge
    into one block, `<|role|>ROLE<|text|>TEXT<|turn|>TEXT<|end|>`, in which <|turn|> keeps their bounds.
    Control strings inside roles and texts are escaped reversibly. `loss_spans` are the stretches
    (start from 0, length, in code points of `formatted`; start_byte and bytes, in its UTF-8) that hold a text of
    the role `learned`. Work is about linear in the turns: a hundred thousand take seconds.

    Null text or role: empty. Turns with equal numbers are ordered by role, then text; equal rows are
    turns of their own. A null turn number stands first. Null conv_id: a conversation of its own.
    Empty table: no rows. Other columns are ignored. A conversation is one string in the result, so
    it has to fit into a row.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    told = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text")))).alias("turns")
    )
    last = F.size("turns") - 1

    def part(turn: Column, i: Column) -> Column:
        """Control strings before the text, the text, and those after it."""
        same = (i > 0) & (F.get("turns", i - 1)["role"] == turn["role"])
        ends = (i == last) | (F.get("turns", i + 1)["role"] != turn["role"])
        opening = F.concat(F.lit(ROLE), escape(turn["role"]), F.lit(TEXT))
        return F.struct(
            F.when(same, F.lit(TURN)).otherwise(opening).alias("before"),
            escape(turn["text"]).alias("text"),
            F.when(ends, F.lit(END)).otherwise(F.lit("")).alias("after"),
            (turn["role"] == learned).alias("learned"),
        )

    parts = told.select("conv_id", F.transform("turns", part).alias("parts"))
    joined = F.transform("parts", lambda x: F.concat(x["before"], x["text"], x["after"]))
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("parts") - 1) / CHUNK).cast("int")),
        lambda k: _spans(F.slice("parts", k * CHUNK + 1, F.lit(CHUNK))),
    )
    spanned = parts.select("conv_id", F.array_join(joined, "").alias("formatted"), chunks.alias("chunks"))
    return spanned.select("conv_id", "formatted", _absolute(F.col("chunks")).alias("loss_spans"))


def _spans(parts: Column) -> Column:
    """(spans, at, byte) of some parts: their learned texts, placed from the first part on, and where they end.

    A fold that appends copies what it has each time, so it is kept to CHUNK parts.
    """
    span = "struct<start:int,length:int,start_byte:int,bytes:int>"
    nothing = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("byte"), F.expr(f"cast(array() as array<{span}>)").alias("spans")
    )

    def onward(done: Column, x: Column) -> Column:
        start, size = done["at"] + F.char_length(x["before"]), F.char_length(x["text"])
        first, width = done["byte"] + F.octet_length(x["before"]), F.octet_length(x["text"])
        own = F.struct(start.alias("start"), size.alias("length"), first.alias("start_byte"), width.alias("bytes"))
        return F.struct(
            (start + size + F.char_length(x["after"])).alias("at"),
            (first + width + F.octet_length(x["after"])).alias("byte"),
            F.when(x["learned"], F.concat(done["spans"], F.array(own))).otherwise(done["spans"]).alias("spans"),
        )

    return F.aggregate(parts, nothing, onward)


def _absolute(chunks: Column) -> Column:
    """The spans of all chunks, each placed behind the chunks before it."""
    place = "struct<at:int,byte:int>"
    nothing = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("byte"), F.expr(f"cast(array() as array<{place}>)").alias("places")
    )

    def onward(done: Column, chunk: Column) -> Column:
        return F.struct(
            (done["at"] + chunk["at"]).alias("at"),
            (done["byte"] + chunk["byte"]).alias("byte"),
            F.concat(done["places"], F.array(F.struct(done["at"].alias("at"), done["byte"].alias("byte")))).alias("places"),
        )

    places = F.aggregate(chunks, nothing, onward, lambda done: done["places"])

    def moved(chunk: Column, by: Column) -> Column:
        return F.transform(
            chunk["spans"],
            lambda s: F.struct(
                (s["start"] + by["at"]).alias("start"),
                s["length"].alias("length"),
                (s["start_byte"] + by["byte"]).alias("start_byte"),
                s["bytes"].alias("bytes"),
            ),
        )

    return F.flatten(F.zip_with(chunks, places, moved))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they were before blocks were merged."""
    blocks = F.filter(F.split(formatted, _literally(END)), lambda b: b != "")

    def block(text: Column) -> Column:
        head = F.split(text, _literally(TEXT), 2)
        return F.struct(
            unescape(F.substring(F.get(head, F.lit(0)), len(ROLE) + 1, 2**31 - 1)).alias("role"),
            F.split(F.get(head, F.lit(1)), _literally(TURN)).alias("texts"),
        )

    def turns(told: Column) -> Column:
        return F.transform(told["texts"], lambda t: F.struct(told["role"].alias("role"), unescape(t).alias("text")))

    # A block is taken apart once, before its turns are.
    return F.flatten(F.transform(F.transform(blocks, block), turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between. Texts are cut by bytes: a place in a string of
    characters is counted from its start each time."""

    def cut(whole: Column) -> Column:
        return F.transform(spans, lambda s: unescape(F.decode(F.substr(whole, s["start_byte"] + 1, s["bytes"]), "UTF-8")))

    # The bytes are the variable of a function, so they are made once and not for each span.
    return F.array_join(F.get(F.transform(F.array(F.encode(formatted, "UTF-8")), cut), F.lit(0)), "")


def chats_digest(formatted: DataFrame) -> DataFrame:
    """Checksums of what is read back from the formatted conversations."""
    back = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def planted_turns(turns: DataFrame) -> DataFrame:
    """Conversation -7 of the contract: a text that looks like control strings, from both roles."""
    return turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
