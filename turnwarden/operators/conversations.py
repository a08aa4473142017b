"""Turns in the context of their conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators.ordered import GROUP_ROWS, over_neighbours


def history_context(turns: DataFrame, runs: int = fixed.HISTORY_RUNS, session: str = "session_id",
                    order: str = "turn_id", content: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``history``: the texts of the last ``runs`` runs of the session, oldest first."""
    def columns(window):
        return {"history": F.collect_list(content).over(window.rowsBetween(-runs, W.currentRow - 1))}
    return over_neighbours(turns, session, order, columns, before=runs, group_rows=group_rows)


def conversation_pairs(messages: DataFrame, conversation: str = "conv_id", order: str = "turn",
                       group_rows: int = GROUP_ROWS) -> DataFrame:
    """(conversation, order, question, answer): each user message with the assistant message right after it."""
    def columns(window):
        return {"_role": F.lead("role").over(window), "answer": F.lead("text").over(window)}
    paired = over_neighbours(messages, conversation, order, columns, after=1, group_rows=group_rows)
    return (paired.filter((F.col("role") == "user") & (F.col("_role") == "assistant"))
            .select(conversation, order, F.col("text").alias("question"), "answer"))
