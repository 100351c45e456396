"""Chat formatting in budgeted windows, with a loss mask that covers each target once.

A conversation becomes one or more windows of whole turns. A window repeats the latest
system turn and a limited stretch of the turns before it as context without loss, then
brings new turns; assistant texts among the new turns are under the loss mask. Everything
is DataFrame functions: one sort per conversation serves all prefix sums.

Defined cases. Null text or role: empty. Null `conv_id`: a conversation of its own. Null
`turn`: after all others. Rows with one (`conv_id`, `turn`): ordered by role, then text;
repeated rows are turns of their own. A turn larger than the room for new turns: a window
of its own, whole. Other columns are ignored. No rows: no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The turn marks, and the strings that a text may not hold raw.
OPEN, CLOSE = "<s>", "</s>"
CONTROL = ["</s>", "<s>", "[INST]", "[/INST]"]
ESCAPE = "␛"
CODES = {"<": "l", "[": "b"}

#: Tokens that the marks of a turn count for.
TURN_COST = 4
BUDGET, HISTORY = 512, 128


def escape(text: Column) -> Column:
    """`text` without raw control strings; `unescape` gives it back."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e"))
    for word in CONTROL:
        text = F.replace(text, F.lit(word), F.lit(ESCAPE + CODES[word[0]] + word[1:]))
    return text


def unescape(text: Column) -> Column:
    for mark, code in CODES.items():
        text = F.replace(text, F.lit(ESCAPE + code), F.lit(mark))
    text = F.replace(text, F.lit(ESCAPE + "n"), F.lit("\n"))
    return F.replace(text, F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def _piece(role: Column, text: Column) -> Column:
    """Head and body of a formatted turn; a role stays on one line."""
    label = F.replace(escape(role), F.lit("\n"), F.lit(ESCAPE + "n"))
    return F.struct(
        F.concat(F.lit(OPEN), label, F.lit("\n")).alias("head"),
        escape(text).alias("body"),
    )


def spans(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Turns with their number, prefix sum of tokens and window.

    The room for new turns is the budget less history and system turn. Half of it is the
    step: turns whose prefix sums start in one step share a window, and a turn larger than a
    step stands alone, so a window never holds more than its room unless one turn does.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tokens", (F.regexp_count("text", F.lit(r"\S+")) + TURN_COST).cast("long"))
    conversation = Window.partitionBy("conv_id")
    by_turn = conversation.orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = rows.withColumn("number", F.row_number().over(by_turn))
    ordered = conversation.orderBy("number")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    system = F.when(F.col("role") == "system", F.col("tokens"))
    rows = rows.select(
        "*",
        (F.sum("tokens").over(so_far) - F.col("tokens")).alias("start"),
        F.greatest(
            F.floor((F.lit(budget - history) - F.coalesce(F.max(system).over(conversation), F.lit(0))) / 2),
            F.lit(16),
        ).alias("step"),
    )
    rows = rows.withColumn("alone", F.col("tokens") > F.col("step"))
    rows = rows.select(
        "*",
        F.sum(F.col("alone").cast("long")).over(so_far).alias("large_ones"),
        F.floor(F.col("start") / F.col("step")).alias("at_step"),
    )
    place = F.struct("large_ones", "at_step")
    follows = (place == F.lag(place).over(ordered)) & ~F.lag("alone").over(ordered)
    rows = rows.withColumn("opens", ~F.coalesce(follows, F.lit(False)))
    return rows.withColumn("window", F.sum(F.col("opens").cast("long")).over(so_far))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: `formatted`, `n_context` (repeated turns at its head), `n_turns`
    (new ones) and `loss`, the spans (start, length in code points) under the loss mask."""
    rows = spans(conversations, budget, history)
    conversation = Window.partitionBy("conv_id")
    before = conversation.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    recent = conversation.orderBy("start").rangeBetween(-history, -1)
    piece = _piece(F.col("role"), F.col("text"))
    is_system = F.col("role") == "system"
    rows = rows.select(
        "conv_id",
        "number",
        "window",
        "opens",
        F.struct("number", "role", piece.alias("piece")).alias("new"),
        F.last(F.when(is_system, piece), ignorenulls=True).over(before).alias("system"),
        F.collect_list(F.when(~is_system, F.struct("number", piece.alias("piece")))).over(recent).alias("recent"),
    )
    grouped = rows.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list("new")).alias("new"),
        F.first(F.when(F.col("opens"), F.col("system")), ignorenulls=True).alias("system"),
        F.first(F.when(F.col("opens"), F.col("recent")), ignorenulls=True).alias("recent"),
    )
    context = F.concat(
        F.filter(F.array("system"), lambda p: p.isNotNull()),
        F.transform(F.array_sort("recent"), lambda t: t["piece"]),
    )
    plain = lambda p, target: F.struct(
        p["head"].alias("head"), p["body"].alias("body"), target.alias("target")
    )
    pieces = F.concat(
        F.transform(context, lambda p: plain(p, F.lit(False))),
        F.transform("new", lambda t: plain(t["piece"], t["role"] == "assistant")),
    )
    grouped = grouped.select(
        "conv_id",
        "window",
        F.size(context).alias("n_context"),
        F.size("new").alias("n_turns"),
        pieces.alias("pieces"),
    )
    empty = F.array().cast("array<struct<start:int,length:int>>")

    def add(state: Column, p: Column) -> Column:
        at = state["at"] + F.length(p["head"])
        span = F.struct(at.alias("start"), F.length(p["body"]).alias("length"))
        return F.struct(
            (at + F.length(p["body"]) + len(CLOSE)).alias("at"),
            F.when(p["target"], F.concat(state["loss"], F.array(span))).otherwise(state["loss"]).alias("loss"),
        )

    first = F.struct(F.lit(0).alias("at"), empty.alias("loss"))
    return grouped.select(
        "conv_id",
        "window",
        "n_context",
        "n_turns",
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), ""
        ).alias("formatted"),
        F.aggregate("pieces", first, add, lambda s: s["loss"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """New turns (role, text) and target texts of each window, from its formatted text."""
    parts = F.split("formatted", CLOSE, -1)
    new = F.slice(parts, F.col("n_context") + 1, F.col("n_turns"))
    head = lambda p: F.substring_index(p, "\n", 1)
    return formatted.select(
        "*",
        F.transform(
            new,
            lambda p: F.struct(
                unescape(F.substr(head(p), F.lit(len(OPEN) + 1))).alias("role"),
                unescape(F.substr(p, F.length(head(p)) + 2)).alias("text"),
            ),
        ).alias("turns"),
        F.transform(
            "loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
        ).alias("targets"),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, what `read_back` finds in its windows."""
    found = read_back(formatted).select(
        "conv_id",
        "n_turns",
        F.length("formatted").cast("long").alias("chars"),
        F.struct(
            "window",
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
            ).alias("turns"),
            F.array_join("targets", "").alias("targets"),
        ).alias("part"),
    )
    joined = lambda field: F.array_join(F.transform("parts", lambda p: p[field]), "")
    return (
        found.groupBy("conv_id")
        .agg(
            F.sum("n_turns").cast("long").alias("n_turns"),
            F.sum("chars").alias("formatted_chars"),
            F.array_sort(F.collect_list("part")).alias("parts"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2(joined("turns"), 256).alias("turns_sha256"),
            F.length(joined("targets")).cast("long").alias("loss_chars"),
            F.sha2(joined("targets"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
