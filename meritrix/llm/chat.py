"""Chat formatting in budgeted windows, DataFrame functions only.

Prefix sums of the turns' token costs cut a conversation into windows of whole
turns. Each window repeats the system turn and a limited history in front; only
assistant texts that are new in a window are under its loss mask, so that each is
a target exactly once.

Escaping: wherever a text has ``<``, any number of backslashes and ``|``, one more
backslash goes before the bar. No control string is left in it, and taking one
backslash away at each such place restores it. Roles are URL-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meritrix.session import stored

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens of new turns and of repeated history in a window. A window's new turns
#: start within BUDGET tokens of each other, so only the last one may go beyond.
BUDGET = 1_024
HISTORY = 256
#: Turn numbers in one block of the two-level prefix sums.
BLOCK = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def token_cost(piece: Column) -> Column:
    """Tokens of a formatted turn: a quarter of its bytes, rounded up."""
    return F.ceil(F.octet_length(piece) / 4).cast("bigint")


def _placed(conversations: DataFrame, budget: int) -> DataFrame:
    """One row per turn: its piece, the tokens before it, and its window. The
    prefix sums have two levels, so that a conversation of any length is summed in
    blocks: inside a block of turn numbers, and over the blocks' totals."""
    turns = conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "conv_id",
        F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    header = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    turns = turns.select(
        "conv", "conv_id", "turn", "role", F.length(header).alias("header_chars"),
        F.length(escape(F.col("text"))).alias("text_chars"),
        F.concat(header, escape(F.col("text")), F.lit(END)).alias("piece"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-2 ** 62)).cast("bigint").alias("block"),
    ).withColumn("cost", token_cost(F.col("piece")))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (turns.groupBy("conv", "block").agg(F.sum("cost").alias("cost"))
              .select("conv", "block", F.coalesce(F.sum("cost").over(earlier), F.lit(0)).alias("offset")))
    text = unescape(F.substr("piece", F.col("header_chars") + 1, F.col("text_chars")))
    inside = (Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "role", text)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (turns.join(blocks, ["conv", "block"])
            .withColumn("before", F.col("offset") + F.sum("cost").over(inside) - F.col("cost"))
            .withColumn("window", F.floor(F.col("before") / budget).cast("bigint"))
            .drop("block", "offset", "turn", "cost"))


def windows(conversations: DataFrame, *, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, n_repeated, loss_spans): one row per window.

    ``n_repeated`` turns in front are repeated; ``loss_spans`` are the (start, end)
    of the texts under the loss mask, in code points of ``formatted``. A turn is
    repeated in the next window when it and all turns after it fit ``history``;
    the system turn is the conversation's first turn if its role is ``system``.

    Turns of equal number are ordered by role and text, a null number comes first,
    null roles and texts are empty, and rows with a null conv_id are one
    conversation. Repeated rows are turns of their own; other columns are ignored; an
    empty table gives no rows. A turn stays whole in the window that it starts in, and a
    value cannot exceed 2 GB. A conversation may have any number of windows, while
    ``digests`` puts all its text into one value. Turns that share a block of numbers
    (equal or null ones, say) are ordered in one task.
    """
    if not 0 <= history <= budget:
        raise ValueError("history must fit the budget")
    placed = stored(_placed(conversations, budget))  # read four times, mostly in narrow columns
    by_conv = Window.partitionBy("conv").orderBy("window")
    spans = (placed.groupBy("conv", "window").agg(F.min("before").alias("first"))
             .withColumn("next_window", F.lead("window").over(by_conv))
             .withColumn("next_first", F.lead("first").over(by_conv)))
    fields = ("conv", "conv_id", "before", "role", "piece", "header_chars", "text_chars")
    located = placed.join(spans, ["conv", "window"])
    new = located.select(*fields, "window", F.lit(False).alias("repeated"))
    repeats = (F.col("next_first") - F.col("before") <= history) & ~(
        (F.col("before") == 0) & (F.col("role") == "system"))
    old = located.where(repeats).select(*fields, F.col("next_window").alias("window"), F.lit(True).alias("repeated"))
    system = placed.where("before = 0 AND role = 'system'").select(*fields)
    # the first window holds the system turn itself
    kept = system.join(spans.where("window > 0").select("conv", "window"), "conv").select(
        *fields, "window", F.lit(True).alias("repeated"))
    order = Window.partitionBy("conv", "window").orderBy("before")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece")).over(upto), F.lit(0)) + F.col("header_chars")
    target = ~F.col("repeated") & (F.col("role") == "assistant") & (F.col("text_chars") > 0)
    pieces = (new.unionByName(old).unionByName(kept).withColumn("start", start)
              .withColumn("span", F.when(target, F.struct(
                  F.col("start").cast("int").alias("start"),
                  (F.col("start") + F.col("text_chars")).cast("int").alias("end")))))
    return (pieces.groupBy("conv", "window")  # bounded by the budget
            .agg(F.first("conv_id").alias("conv_id"), F.count_if("repeated").cast("int").alias("n_repeated"),
                 F.array_sort(F.collect_list(F.struct("before", "piece"))).alias("pieces"),
                 F.array_sort(F.collect_list("span")).alias("loss_spans"))
            .select("conv_id", "window", F.array_join(F.col("pieces.piece"), "").alias("formatted"),
                    "n_repeated", "loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss_texts): the new turns (role, text) of each
    window and the texts under its mask, parsed from the formatted string."""
    parts = F.split("formatted", r"<\|im_end\|>\n")
    bodies = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))
    turns = F.transform(bodies, lambda b: F.struct(
        F.url_decode(F.substring_index(F.substr(b, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(b, F.instr(b, "\n") + 1)).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(
        F.substr("formatted", s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", "window", turns.alias("turns"), masked.alias("loss_texts"),
                            F.length("formatted").cast("bigint").alias("formatted_chars"))


def digests(read: DataFrame) -> DataFrame:
    """One row per conversation. A digest covers the whole conversation, so its
    text has to meet in one row here, and only here."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per_window = read.select("conv_id", "formatted_chars", F.size("turns").alias("n"), F.struct(
        "window", turns.alias("turns"), F.array_join("loss_texts", "").alias("loss")).alias("w"))
    whole = per_window.groupBy("conv_id").agg(
        F.sum("n").cast("bigint").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("w")).alias("w"))
    loss = F.array_join(F.col("w.loss"), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("w.turns"), "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")
