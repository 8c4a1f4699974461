"""Chat formatting into budgeted windows of whole turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfeat.llm.common import WORD, col, kept

#: Tokens of a window, and how many turns before it a window repeats at most.
BUDGET, HISTORY = 512, 2
#: Turn numbers that share a block of prefix sums.
BLOCK = 64

#: Roles with a meaning: kept in front of every window, learned from.
SYSTEM, TARGET = "system", "assistant"

#: The template: ``<|role|>`` text ``<|end|>``. Its marks, and those of other templates, all hold one of these.
OPEN, SHUT, END = "<|", "|>", "<|end|>"
#: Characters that are written as escapes inside roles and texts; the escape character comes first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))


def escape(text: Column) -> Column:
    """The text without any character that control strings are made of."""
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def turn_cost(role: Column, text: Column) -> Column:
    """Tokens of a formatted turn: the words of its text, one for the role mark and one for the end mark."""
    return (F.regexp_count(text, F.lit(WORD)) + 2).cast("bigint")


def turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, at, role, text, cost, before``: turns in order with the tokens before each.

    ``at`` numbers a conversation's turns from 0. Sums run within blocks of turn numbers and
    go on from the blocks before, so a very long conversation is not summed in one task.
    """
    body = F.coalesce(col(text), F.lit(""))
    who = F.coalesce(col(role), F.lit(""))
    rows = conversations.select(
        col(conv).alias("conv"),
        col(turn).alias("turn"),
        who.alias("role"),
        body.alias("text"),
        turn_cost(who, body).alias("cost"),
        F.floor(col(turn) / BLOCK).alias("block"),
    )
    sums = rows.groupBy("conv", "block").agg(F.sum("cost").alias("c"), F.count("*").alias("n"))
    back = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("conv").alias("conv_"),
        F.col("block").alias("block_"),
        F.coalesce(F.sum("c").over(back), F.lit(0)).alias("c_"),
        F.coalesce(F.sum("n").over(back), F.lit(0)).alias("n_"),
    )
    order = ["turn", "role", "text"]
    inside = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(
        "*",
        F.coalesce(F.sum("cost").over(inside), F.lit(0)).alias("c"),
        (F.row_number().over(Window.partitionBy("conv", "block").orderBy(*order)) - 1).alias("k"),
    )
    joined = local.join(starts, F.col("conv").eqNullSafe(F.col("conv_")) & F.col("block").eqNullSafe(F.col("block_")))
    return joined.select(
        "conv", "turn", (F.col("k") + F.col("n_")).alias("at"), "role", "text", "cost", (F.col("c") + F.col("c_")).alias("before")
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of the named columns, null being equal to null."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n + "_"])
    return out


def _placed(rows: DataFrame, budget: int) -> DataFrame:
    """Turns with the window they are new in: ``first`` (its first turn), ``new_cost``, ``system_cost``.

    Windows follow the prefix sums: turns that begin in the same stretch of ``budget`` less
    system turn share a window, but the last one gets its own if it does not end in reach. So
    a window is within the budget unless a single turn is longer.
    """
    system = rows.filter((F.col("at") == 0) & (F.col("role") == SYSTEM)).select(
        F.col("conv").alias("conv_"), F.col("cost").alias("system_cost")
    )
    rows = rows.join(system, rows["conv"].eqNullSafe(system["conv_"]), "left").drop("conv_")
    rows = rows.withColumn("system_cost", F.coalesce("system_cost", F.lit(0)))
    is_system = (F.col("at") == 0) & (F.col("system_cost") > 0)
    room = F.greatest(F.lit(1), F.lit(budget) - F.col("system_cost"))
    start = F.when(is_system, 0).otherwise(F.col("before") - F.col("system_cost"))
    rows = rows.select(
        "*",
        is_system.alias("is_system"),
        start.alias("start"),
        F.when(is_system, 0).otherwise(F.col("cost")).alias("own"),
        F.floor(start / room).alias("stretch"),
        room.alias("room"),
    )
    group = Window.partitionBy("conv", "stretch")
    begins = F.min("start").over(group)
    leads = F.min(F.when(~F.col("is_system"), F.col("at"))).over(group)
    rows = rows.withColumn("late", (F.col("at") > leads) & (F.col("start") + F.col("own") - begins > F.col("room")))
    first = F.when(F.col("late"), F.col("at")).otherwise(F.min("at").over(group))
    total = F.when(F.col("late"), F.col("own")).otherwise(F.sum(F.when(~F.col("late"), F.col("own")).otherwise(0)).over(group))
    return rows.select(
        "conv", "at", "role", "text", "start", "own", "is_system", "system_cost", "room", first.alias("first"), total.alias("new_cost")
    )


def format_windows(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """Training windows ``conv_id, first_turn, text, loss, n_repeated, n_new, tokens, over_budget``.

    A window is a span of whole turns whose tokens fit ``budget`` together with the system
    turn, which every window of its conversation keeps in front. Up to ``history`` turns before
    the span are repeated as far as the budget allows. ``loss`` lists the ranges (start, end
    in code points of ``text``) of assistant texts that are new in the window: repeated ones
    are masked, so each assistant text is learned once. ``over_budget`` marks a window whose
    single turn is too long; it is kept whole.

    Turns are ordered by number; equal numbers by role and text, missing ones first. A null
    text or role counts as empty, rows without a conversation id form one conversation,
    repeated rows are turns of their own, an empty table gives no windows. Other columns are
    ignored.
    """
    rows = kept(_placed(turns(conversations, conv_col, turn_col, role_col, text_col), budget))
    heads = rows.filter(F.col("at") == F.col("first")).select(
        "conv", "first", "system_cost", "new_cost", "start", (F.col("room") - F.col("new_cost")).alias("spare")
    )
    back = heads.select(
        F.col("conv").alias("conv_"),
        "first",
        "spare",
        F.col("start").alias("head_start"),
        F.explode(F.sequence(F.lit(1), F.lit(history))).alias("d") if history else F.explode(F.expr("array_repeat(1, 0)")).alias("d"),
    ).withColumn("at_", F.col("first") - F.col("d"))
    source = rows.drop("first")
    repeated = source.join(back, _same(source, back, "conv", "at")).filter(
        ~F.col("is_system") & (F.col("head_start") - F.col("start") <= F.col("spare"))
    )
    fronts = heads.filter("first > 0 and system_cost > 0").select(F.col("conv").alias("conv_"), "first")
    system = source.filter("is_system")
    system = system.join(fronts, _same(system, fronts, "conv"))
    columns = ["conv", "first", "at", "role", "text"]
    members = rows.select(*columns, F.lit(True).alias("new")).unionByName(
        repeated.select(*columns, F.lit(False).alias("new")).unionByName(system.select(*columns, F.lit(False).alias("new")))
    )
    mark = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SHUT))
    body = escape(F.col("text"))
    parts = members.select(
        "conv",
        "first",
        F.struct(
            "at",
            "new",
            (F.col("new") & (F.col("role") == TARGET)).alias("target"),
            F.length(mark).alias("head"),
            F.length(body).alias("size"),
            turn_cost(F.col("role"), F.col("text")).alias("cost"),
            F.concat(mark, body, F.lit(END)).alias("full"),
        ).alias("m"),
    )
    grouped = parts.groupBy("conv", "first").agg(F.array_sort(F.collect_list("m")).alias("m"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    walk = F.aggregate(
        "m",
        F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("loss")),
        lambda a, m: F.struct(
            (a["at"] + F.length(m["full"])).alias("at"),
            F.when(
                m["target"],
                F.concat(
                    a["loss"],
                    F.array(
                        F.struct(
                            (a["at"] + m["head"]).alias("start"), (a["at"] + m["head"] + m["size"]).alias("end")
                        )
                    ),
                ),
            )
            .otherwise(a["loss"])
            .alias("loss"),
        ),
    )
    tokens = F.aggregate("m", F.lit(0).cast("bigint"), lambda s, m: s + m["cost"])
    return grouped.select(
        F.col("conv").alias("conv_id"),
        F.col("first").alias("first_turn"),
        F.array_join(F.transform("m", lambda m: m["full"]), "").alias("text"),
        walk["loss"].alias("loss"),
        F.size(F.filter("m", lambda m: ~m["new"])).alias("n_repeated"),
        F.size(F.filter("m", lambda m: m["new"])).alias("n_new"),
        tokens.alias("tokens"),
        (tokens > budget).alias("over_budget"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Per window what it says: ``turns`` (role and text of its new turns), ``learned`` (texts under the loss mask)."""
    pieces = F.split("text", r"<\|end\|>", -1)
    new = F.slice(pieces, F.col("n_repeated") + 1, F.col("n_new"))
    mark = lambda p: F.substring_index(p, SHUT, 1)
    turn = lambda p: F.struct(
        unescape(F.substr(mark(p), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(p, F.length(mark(p)) + len(SHUT) + 1)).alias("text"),
    )
    learned = F.transform(
        "loss", lambda s: unescape(F.substr("text", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return windows.select(
        "conv_id", "first_turn", F.transform(new, turn).alias("turns"), learned.alias("learned"), F.length("text").alias("chars")
    )
