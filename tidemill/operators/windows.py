"""Order-dependent operators on conversations: history, running size, pages, caps.

A message has a conversation and an integer turn; its place is by turn, role and text. A conversation
may be arbitrarily long, so nothing here gathers a whole one in a row: page ``p`` of a conversation
holds the messages at places ``64 p`` to ``64 p + 63``, whatever the conversation's size, and history is
one row per message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.skew import positions, totals_before

PAGE = 64

# How each role is announced in a transcript.
SPEAKERS = {"system": "System", "user": "Human", "assistant": "AI Assistant"}


def placed(messages: DataFrame) -> DataFrame:
    """Add ``position``, the 0-based place of a message in its conversation."""
    return positions(messages, ["conv_id"], "turn", "role", "text")


def paged(messages: DataFrame, page: int = PAGE) -> DataFrame:
    """Add ``position`` and ``page``; the messages before a page number ``page * 64``."""
    return placed(messages).withColumn("page", F.floor(F.col("position") / F.lit(page)).cast("long"))


def chat_history(messages: DataFrame, asked: DataFrame) -> DataFrame:
    """The whole history that goes with each asked (``conv_id, turn``), that turn included.

    One row per message: ``conv_id, asked_turn, position, role, text``.
    """
    wanted = asked.select("conv_id", F.col("turn").alias("asked_turn")).distinct()
    said = placed(messages.select("conv_id", "turn", "role", "text"))
    return said.join(wanted, "conv_id").where(F.col("turn") <= F.col("asked_turn")).select(
        "conv_id", "asked_turn", "position", "role", "text"
    )


def last_turns(messages: DataFrame) -> DataFrame:
    return messages.groupBy("conv_id").agg(F.max("turn").alias("turn"))


def history_length(messages: DataFrame) -> DataFrame:
    """``n_messages`` of the history at each turn, the turn included."""
    per_turn = messages.groupBy("conv_id", "turn").agg(F.count("*").alias("n"))
    return totals_before(per_turn, ["conv_id"], "turn", "n", "before").select(
        "conv_id", "turn", (F.col("before") + F.col("n")).alias("n_messages")
    )


def running_size(messages: DataFrame, size: Column) -> DataFrame:
    """Size of the prompt sent at each turn: the sum of ``size`` over the turns so far."""
    per_turn = messages.groupBy("conv_id", "turn").agg(F.sum(size).alias("size"))
    return totals_before(per_turn, ["conv_id"], "turn", "size", "before").select(
        "conv_id", "turn", "size", (F.col("before") + F.col("size")).alias("running_size")
    )


def cap_turns(messages: DataFrame, max_turns: int) -> DataFrame:
    """The first ``max_turns`` messages of each conversation.

    Spark applies the rank limit inside each input partition before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return messages.select("*", rank.alias("__rank")).where(F.col("__rank") <= max_turns).drop("__rank")


def speaker(role: Column) -> Column:
    out = role
    for key, name in SPEAKERS.items():
        out = F.when(role == key, F.lit(name)).otherwise(out)
    return out


def transcript_pages(messages: DataFrame, page: int = PAGE) -> DataFrame:
    """``Speaker: text`` lines in turn order, one row per page of a conversation.

    The pages of a conversation, in order, joined by a newline, are its transcript.
    """
    lines = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    said = F.transform(lines, lambda m: F.concat(speaker(m["role"]), F.lit(": "), m["text"]))
    return paged(messages, page).groupBy("conv_id", "page").agg(
        F.count("*").alias("n_messages"), F.array_join(said, "\n").alias("transcript")
    )


def history_json(messages: DataFrame, page: int = PAGE) -> DataFrame:
    """Messages as a JSON array of ``{role, content}``, one row per page."""
    items = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    plain = F.transform(items, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")))
    return paged(messages, page).groupBy("conv_id", "page").agg(F.to_json(plain).alias("messages"))


def usage_totals(messages: DataFrame, size: Column) -> DataFrame:
    """Prompt and completion sizes per conversation: what users and the system sent, and replies."""
    reply = F.col("role") == "assistant"
    return messages.groupBy("conv_id").agg(
        F.sum(F.when(~reply, size).otherwise(0)).alias("prompt_tokens"),
        F.sum(F.when(reply, size).otherwise(0)).alias("completion_tokens"),
        F.sum(size).alias("total_tokens"),
    )


def context_budget(passages: DataFrame, budget: int, query: str = "query_id") -> DataFrame:
    """Per query, the passages in falling ``score`` whose running ``tokens`` stay in the budget.

    Empty passages say nothing: they rank last and are left out, so at most ``budget`` passages of
    one token or more can fit, and ranking keeps that many per query before anything is summed.
    """
    order = Window.partitionBy(query).orderBy(F.col("tokens") <= 0, F.desc("score"), F.asc("passage_id"))
    used = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        passages.select("*", F.row_number().over(order).alias("rank"))
        # After the rank, as a test on tokens alone would be run on every text before the join.
        .where((F.col("rank") <= budget) & (F.col("tokens") > 0))
        .select("*", used.alias("used"))
        .where(F.col("used") <= budget)
    )
