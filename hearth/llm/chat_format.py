"""Chat formatting with a reversible template, in DataFrame expressions only.

Turn structs of a conversation are collected, sorted and written as one string::

    <|role|>user<|text|>first text<|next|>second text<|end|><|role|>assistant<|text|>reply<|end|>

Adjacent turns of one role share a header and are joined by ``<|next|>``.  In roles and texts a backslash
follows every ``<``, ``[`` and backslash, so no control string of this or of the common instruction templates
(``</s>``, ``[INST]``, ``<|im_start|>``) can occur inside a text; dropping these backslashes restores it.

The loss mask is run-length coded: ``mask`` holds ``struct(n, loss)`` runs that cover the formatted string, in
code points; exactly the escaped assistant texts are under it.

Defined cases: null text or role counts as empty; turns are ordered by (turn, role, text) with null turns first, so
ties and repeated rows give a stable result and repeated rows stay; a null ``conv_id`` is a conversation of its
own; an empty table gives an empty result; further input columns are ignored.  A conversation is one output value and
must fit one row (2 GB), which is a bound of the format itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, TEXT, NEXT, END = "<|role|>", "<|text|>", "<|next|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def format_chats(turns: DataFrame, train_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, mask, n_groups`` from rows of ``conv_id, turn, role, text``."""
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1)["role"], F.get("turns", i + 1)["role"]
        opens = before.isNull() | (before != t["role"])
        closes = after.isNull() | (after != t["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit(ROLE), escape(t["role"]), F.lit(TEXT))).otherwise(F.lit(NEXT)).alias("head"),
            escape(t["text"]).alias("body"),
            F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("tail"),
            (t["role"] == train_role).alias("loss"),
            opens.alias("opens"),
        )

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))

    def runs(p: Column) -> Column:
        return F.array(
            F.struct(F.length(p["head"]).alias("n"), F.lit(False).alias("loss")),
            F.struct(F.length(p["body"]).alias("n"), p["loss"].alias("loss")),
            F.struct(F.length(p["tail"]).alias("n"), F.lit(False).alias("loss")),
        )

    return pieces.select(
        "conv_id",
        F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"]))).alias("formatted"),
        F.filter(F.flatten(F.transform("pieces", runs)), lambda r: r["n"] > 0).alias("mask"),
        F.size(F.filter("pieces", lambda p: p["opens"])).cast("long").alias("n_groups"),
    )


def parse_turns(formatted: Column) -> Column:
    """The ``array<struct<role, text>>`` that a formatted string holds; inverse of the template."""

    def quoted(control: str) -> str:
        return "".join("\\" + c if c in "<|>" else c for c in control)

    groups = F.filter(F.split(formatted, quoted(END)), lambda g: g != "")

    def turns(group: Column) -> Column:
        halves = F.split(group, quoted(TEXT))
        role = unescape(F.substring(halves[0], len(ROLE) + 1, 2**31 - 1))
        return F.transform(F.split(halves[1], quoted(NEXT)), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(groups, turns))


def _parts(piece: Column, size: int) -> Column:
    """A piece (text ``s`` and the runs ``m`` that cover it) cut into pieces of ``size`` runs."""
    runs = piece["m"]
    numbers = F.sequence(F.lit(0), F.ceil(F.size(runs) / size).cast("int") - 1)
    blocks = F.transform(numbers, lambda i: F.slice(runs, i * size + 1, size))
    sized = F.transform(blocks, lambda b: F.struct(F.aggregate(b, F.lit(0), lambda n, r: n + r["n"]).alias("n"), b.alias("m")))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("begins"))
    begins = F.aggregate(sized, start, lambda acc, b: F.struct((acc["at"] + b["n"]).alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins")))["begins"]
    return F.zip_with(begins, sized, lambda at, b: F.struct(F.substring(piece["s"], at, b["n"]).alias("s"), b["m"].alias("m")))


def under_mask(formatted: Column, mask: Column) -> Column:
    """The unescaped texts of the masked runs, in order.

    Characters are found by reading a string from its start.  So the string is cut into pieces of 4,096 runs, these into pieces of 64, and
    only then into runs: no run is looked for from further away than the begin of a small piece.
    """
    pieces = F.array(F.struct(formatted.alias("s"), mask.alias("m")))
    cut = lambda size: lambda p: _parts(p, size)
    for size in (4096, 64, 1):
        pieces = F.flatten(F.transform(pieces, cut(size)))
    found = F.when(F.size(mask) > 0, F.filter(pieces, lambda p: p["m"][0]["loss"]))
    return F.coalesce(F.transform(found, lambda p: unescape(p["s"])), F.array().cast("array<string>"))
