"""Dialogues seen from every participant.

A participant is a role of the conversation other than ``system``. For each one the
whole dialogue is rendered with that speaker as ``assistant``, the others as named
users, and a loss mask that covers exactly what that speaker says.

A rendered dialogue is kept as its segments, one row per message and perspective,
with their places in the whole: a conversation of any length is never gathered in
one row. Joined in the order of ``start``, the segments are the dialogue.

Only DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
#: The speaker of a message without a role.
NOBODY = "unknown"
#: Turns whose places are added up together.
BLOCK = 64


def rotate(messages: DataFrame) -> DataFrame:
    """``conv_id, perspective, turn, n, speaker, rendered, start, mask_start, mask_end``.

    ``messages`` has conv_id, turn, role and text. ``n`` numbers messages of the same
    turn, in the order of role and text; repeated rows stay repeated. Places are in
    characters, ends exclusive; mask places are null in segments of others. Null text
    is empty, a null role is the speaker ``unknown``, a null turn comes first, a null
    conv_id is a conversation of its own, a conversation without participants gives
    no row, and other columns are not kept.

    Places come from two sums: of whole blocks of turns within a perspective, and of
    the segments within a block, so that no task needs a conversation as a whole.
    """
    said = messages.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit(NOBODY)).alias("speaker"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).alias("block"),
    )
    people = (
        said.where(F.col("speaker") != SYSTEM)
        .select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective"))
        .distinct()
    )
    seen = said.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("speaker") == F.col("perspective")
    head = F.concat(
        F.lit(OPEN),
        F.when(own, F.lit("assistant"))
        .when(F.col("speaker") == SYSTEM, F.lit("system"))
        .otherwise(F.concat(F.lit("user name="), F.col("speaker"))),
        F.lit("\n"),
    )
    segments = seen.select(
        "*",
        own.alias("own"),
        F.length(head).cast("bigint").alias("head"),
        F.concat(head, F.col("text"), F.lit(CLOSE)).alias("rendered"),
    )
    segments = segments.withColumn("size", F.length("rendered").cast("bigint"))
    # Narrow rows for the sums over blocks.
    key = ["conv_id", "perspective"]
    blocks = segments.groupBy(*key, "block").agg(F.sum("size").alias("size"))
    before = F.sum("size").over(W.partitionBy(*key).orderBy("block")) - F.col("size")
    blocks = blocks.select(
        F.col("conv_id").alias("c"),
        F.col("perspective").alias("p"),
        F.col("block").alias("b"),
        before.alias("before"),
    )
    order = W.partitionBy(*key, "block").orderBy("turn", "speaker", "text")
    same = W.partitionBy(*key, "block", "turn").orderBy("speaker", "text")
    inside = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    placed = segments.select(
        "*", inside.alias("inside"), (F.row_number().over(same) - 1).alias("n")
    ).join(
        blocks,
        F.col("conv_id").eqNullSafe(F.col("c"))
        & (F.col("perspective") == F.col("p"))
        & (F.col("block") == F.col("b")),
    )
    start = F.col("before") + F.col("inside")
    body = start + F.col("head")
    # The mask also covers the end mark: the speaker has to learn to stop.
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "n",
        "speaker",
        "rendered",
        start.alias("start"),
        F.when(F.col("own"), body).alias("mask_start"),
        F.when(F.col("own"), start + F.col("size")).alias("mask_end"),
    )


ROTATE_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '{NOBODY}') AS speaker, coalesce(text, '') AS text
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> '{SYSTEM}'
), seen AS (
  SELECT s.*, perspective, speaker = perspective AS own,
    '{OPEN}' || CASE WHEN speaker = perspective THEN 'assistant'
      WHEN speaker = '{SYSTEM}' THEN 'system' ELSE 'user name=' || speaker END
      || chr(10) AS head
  FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), sized AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM seen
), placed AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY conv_id, perspective, turn
      ORDER BY speaker, text) - 1 AS INTEGER) AS n,
    CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective
      ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING) AS BIGINT)
      - length(rendered) AS start
  FROM sized
)
SELECT conv_id, perspective, turn, n, speaker, rendered, start,
  CASE WHEN own THEN start + length(head) END AS mask_start,
  CASE WHEN own THEN start + length(rendered) END AS mask_end
FROM placed
"""
