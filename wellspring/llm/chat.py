"""Chat formatting in budgeted windows.

A turn is written as ``### role: text</turn>`` and a line break. Backslashes, ``###``
and ``</turn>`` inside texts and roles, and colons inside roles, are written as two
characters that begin with a backslash, so what the template writes never occurs
inside a turn and reading the format back is plain replacement.

A conversation is cut into windows at turn boundaries: prefix sums of the turns' token
counts, the system turn aside, deal the turns to spans of ``budget`` less the system
turn less ``history`` tokens; a turn belongs to the span it begins in. Each window
repeats the system turn, then as many of the turns just before its span as fit in
``history`` and in what the span leaves of the budget, then holds the span. Loss spans
mark the texts of assistant turns of the span itself: repeated turns are masked, so
every assistant text is a target once. No turn is cut: a window goes over the budget,
and says so, only where the last turn of its span does not fit.

Windows are found with window functions over a conversation and a group by window; a
group holds one window. All is built-in functions.

Odd rows: null roles and texts count as empty; rows are ordered by turn (null first),
role and text, and repeated rows are turns of their own; a null ``conv_id`` is a
conversation. A system turn is a first turn with role ``system``; later ones are
ordinary turns. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
END = "</turn>\n"
# What stands for what inside a turn, in the order of escaping.
ESCAPES = (("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
#: Tokens as counted here: runs of ASCII letters, and any other visible character.
TOKEN = r"[A-Za-z]+|[^A-Za-z\x20\x09-\x0D]"


def escaped(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def unescaped(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[1]), F.lit(p[0])), reversed(pairs), text)


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, loss_spans (start and length in code points), n_turns,
    n_repeated (leading turns of the text that an earlier window has too), n_tokens,
    over_budget."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    opening = F.concat(F.lit("### "), escaped(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    turns = turns.select("conv_id", "turn", "role", "text", opening.alias("opening"), escaped(F.col("text")).alias("body"))
    turns = turns.withColumn("line", F.concat("opening", "body", F.lit(END)))
    turns = turns.withColumn("tokens", F.regexp_count("line", F.lit(TOKEN)).cast("bigint")).withColumn("pos", F.row_number().over(order))
    turns = turns.withColumn("system", (F.col("pos") == 1) & (F.col("role") == "system"))
    whole = W.partitionBy("conv_id")
    before = whole.orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    own = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    turns = turns.select(
        "conv_id", "pos", "role", "system", "opening", "body", "line", own.alias("tokens"),
        F.coalesce(F.sum(own).over(before), F.lit(0)).alias("start"),
        F.max(F.when(F.col("system"), F.col("line"))).over(whole).alias("system_line"),
        F.coalesce(F.max(F.when(F.col("system"), F.col("tokens"))).over(whole), F.lit(0)).alias("system_tokens"),
    )
    span = F.greatest(F.lit(budget - history) - F.col("system_tokens"), F.lit(1))
    turns = turns.withColumns({"span": F.floor(F.col("start") / span), "back": F.least(F.lit(history), span)})
    # A turn is in its own window, and may be repeated in the next: history is no longer than a span.
    own_window = F.struct(F.col("span").alias("window"), F.lit(False).alias("again"))
    next_window = F.struct((F.col("span") + 1).alias("window"), F.lit(True).alias("again"))
    rows = turns.withColumn("at", F.explode(F.when(F.col("system"), F.array(own_window)).otherwise(F.array(own_window, next_window))))
    rows = rows.select("*", "at.window", "at.again").drop("at")
    window = W.partitionBy("conv_id", "window")
    new = F.when(~F.col("again"), F.col("start"))
    rows = rows.withColumns({
        "from": F.min(new).over(window),
        "new_tokens": F.sum(F.when(~F.col("again"), F.col("tokens"))).over(window),
    })
    room = F.least(F.col("back"), F.lit(budget) - F.col("system_tokens") - F.col("new_tokens"))
    rows = rows.where(~F.col("again") | (F.col("from") - F.col("start") <= room))
    # The system turn heads every window; in the first it is a turn of its own.
    head = F.when(F.col("window") > 0, F.coalesce("system_line", F.lit(""))).otherwise(F.lit(""))
    so_far = window.orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    begins = F.length(head) + F.coalesce(F.sum(F.length("line")).over(so_far), F.lit(0)) + F.length("opening")
    target = (F.col("role") == "assistant") & ~F.col("again")
    rows = rows.withColumn(
        "loss", F.when(target, F.struct(begins.cast("int").alias("start"), F.length("body").alias("length")))
    )
    lines = F.array_sort(F.collect_list(F.struct("pos", "line", "loss")))
    grouped = rows.groupBy("conv_id", "window").agg(
        lines.alias("lines"),
        F.first(head).alias("head"),
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("again"), 1)).alias("again"),
        F.sum("tokens").alias("tokens"),
        F.first("system_tokens").alias("system_tokens"),
    )
    headed = (F.col("head") != "").cast("int")
    spans = F.filter(F.transform("lines", lambda x: x["loss"]), lambda x: x.isNotNull())
    tokens = F.col("tokens") + F.col("system_tokens")
    return grouped.select(
        "conv_id", "window",
        F.concat("head", F.array_join(F.transform("lines", lambda x: x["line"]), "")).alias("text"),
        spans.alias("loss_spans"),
        (F.col("n") + headed).cast("int").alias("n_turns"),
        (F.col("again") + headed).cast("int").alias("n_repeated"),
        tokens.alias("n_tokens"),
        (tokens > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns as (role, text), loss) of formatted windows: the turns
    that are not repeated, and the text under the loss spans, both unescaped."""
    lines = F.split("text", END)
    lines = F.slice(lines, F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    turn = lambda x: F.struct(
        unescaped(F.substring_index(F.substr(x, F.lit(5)), ": ", 1), ROLE_ESCAPES).alias("role"),
        unescaped(F.substr(x, F.locate(": ", x) + 2)).alias("text"),
    )
    loss = F.transform("loss_spans", lambda s: F.substr(F.col("text"), s["start"] + 1, s["length"]))
    return formatted.select(
        "conv_id", "window", F.transform(lines, turn).alias("turns"), unescaped(F.array_join(loss, "")).alias("loss"),
        F.length("text").alias("chars"),
    )
