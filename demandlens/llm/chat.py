"""Chat formatting with typed content parts, in DataFrame functions only.

A visitor turns each part of a message into template text: text parts are escaped,
image, audio and document parts become placeholders in their order, with the reference
and the number of tokens that the placeholder stands for recorded beside. The
template is

    <|im_start|>role
    body<|im_end|>

and no escaped text holds a ``<``, so markers and placeholders are the template's own.
Escaping is reversible: a backslash is doubled, ``<`` becomes backslash and ``l``, and in
roles a line end becomes backslash and ``n``.

Null texts, roles and references count as empty, null sizes as 0, a null list of parts as no
part. A part of an unknown kind becomes ``<|other|>`` with 0 tokens. Turns are ordered by
number, nulls last; equal numbers by role and body. Rows with a null conversation id are
one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandlens.llm.rows import pick

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"
PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Pixels along a patch, tokens of a second of sound, tokens of a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    plain = lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit("\\n"))


def text_parts(text: Column) -> Column:
    """One text part."""
    none = [F.lit(None).cast(k).alias(n) for n, k in (
        ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), *none))


def visit(part: Column) -> Column:
    """Template text, reference and expanded tokens of a part."""
    known = lambda name: F.coalesce(part[name], F.lit(0))
    patches = lambda name: F.greatest(F.ceil(known(name) / PATCH), F.lit(1))
    kind = F.coalesce(part["kind"], F.lit(""))
    body, tokens = F.lit("<|other|>"), F.lit(0).cast("bigint")
    for name, count in (
        ("image", patches("width") * patches("height")), ("audio", F.ceil(known("seconds") * PER_SECOND)),
        ("document", known("pages") * PER_PAGE),
    ):
        body = F.when(kind == name, F.lit(f"<|{name}|>")).otherwise(body)
        tokens = F.when(kind == name, count.cast("bigint")).otherwise(tokens)
    return F.struct(
        F.when(kind == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(body).alias("body"),
        (kind != "text").alias("attached"), kind.alias("kind"), F.coalesce(part["ref"], F.lit("")).alias("ref"),
        tokens.alias("tokens"),
    )


def format_chat(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: ``conv_id``, formatted, mask and attachments.

    ``mask`` holds the spans that are learned, as the number of the turn (from 0), the place in
    the turn and the length, both in bytes of UTF-8. ``attachments`` holds turn, place among the
    turn's parts, kind, reference and expanded tokens of every placeholder, in order.
    """
    rows = pick(turns, conv_id, turn, role, parts).toDF("conv", "turn", "role", "parts")
    rows = rows.withColumn("parts", F.coalesce(F.col("parts").cast(PARTS), F.array().cast(PARTS)))
    rows = rows.select(
        "conv", "turn", (F.coalesce("role", F.lit("")) == LEARNED).alias("learned"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.transform("parts", visit).alias("seen"),
    )
    rows = rows.withColumn("body", F.array_join(F.transform("seen", lambda p: p["body"]), ""))
    found = F.filter(F.transform("seen", lambda p, i: F.struct(
        i.alias("part"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"), p["attached"].alias("attached"),
    )), lambda a: a["attached"])
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), "head", "body")
    rows = rows.select(
        "conv", (F.row_number().over(order) - 1).alias("at"), "head", "body", "learned", found.alias("found"),
    )
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "head", "body", "learned", "found"))).alias("rows"))
    learned = F.filter("rows", lambda r: r["learned"])
    attached = F.transform("rows", lambda r: F.transform(r["found"], lambda a: F.struct(
        r["at"].alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"),
    )))
    return grouped.select(
        F.col("conv").alias(conv_id),
        F.array_join(F.transform("rows", lambda r: F.concat(r["head"], r["body"], F.lit(END))), "").alias("formatted"),
        F.transform(learned, lambda r: F.struct(
            r["at"].alias("turn"), F.octet_length(r["head"]).alias("start"), F.octet_length(r["body"]).alias("length"),
        )).alias("mask"),
        F.flatten(attached).alias("attachments"),
    )


def read_back(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """turns (role and text) and learned, the text under the mask, read from ``formatted`` and ``mask`` alone."""
    split = formatted.select(conv_id, "formatted", "mask", F.split("formatted", r"<\|im_end\|>\n").alias("pieces"))
    read = split.withColumn("pieces", F.slice("pieces", 1, F.size("pieces") - 1))

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, F.lit(len(START) + 1), F.char_length(piece))
        head = F.substring_index(rest, "\n", 1)
        return F.struct(
            unescape(head).alias("role"), unescape(F.substring(rest, F.char_length(head) + 2, F.char_length(rest))).alias("text"),
        )

    under = F.transform("mask", lambda m: F.substring(
        F.get("pieces", m["turn"]).cast("binary"), m["start"] + 1, m["length"],
    ).cast("string"))
    return read.select(
        conv_id, "formatted", F.transform("pieces", turn).alias("turns"), F.size("pieces").alias("n"),
        F.array_join(F.transform(under, unescape), "").alias("learned"),
    )


def digest(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    read = read_back(formatted, conv_id)
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        conv_id, F.col("n").cast("bigint").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
