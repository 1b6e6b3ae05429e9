"""Operator 3: perspective rotation of dialogues with several parties.

Every speaker of a conversation but those of `never` (the system) is once the assistant: the dialogue is rendered
with that speaker's turns as the assistant's and all others as users with their names, and the mask covers what the
assistant says, with its end mark. Result: a row per conversation, perspective and turn, with the rendered part,
its place in the rendered dialogue and the masked span in characters of the whole dialogue (null where nothing is
masked). Parts in order of `place` make up the dialogue.

Order: turn (null first), then role, then text. Null text is empty, a null or empty role is the speaker `unknown`;
rows without conv_id are left out. Repeated rows stay, each with its own place. A conversation of `never` alone has
no perspective. Marks in texts and roles are broken up, and line ends in roles are spaces, so that neither can pose as
structure; roles that are equal then are one speaker. Very long turns are one row's work. Empty tables give empty
ones; other columns, whatever their names, are ignored.

Places are running sums in two steps, within blocks of turns and over blocks' totals, so that a very long
conversation is not one task's work; no conversation is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 1024


def rotate(turns: DataFrame, never: tuple[str, ...] = ("system",)) -> DataFrame:
    role = F.when(F.coalesce(F.length("role"), F.lit(0)) > 0, F.col("role")).otherwise(F.lit("unknown"))
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("<\u200b|"))
    name = F.replace(clean(F.translate(role, "\r\n", "  ")), F.lit("|>"), F.lit("|\u200b>"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", name.alias("speaker"), F.concat(clean(F.coalesce(F.col("text"), F.lit(""))), F.lit("<|end|>")).alias("said")
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**60))))
    who = rows.where(~F.col("speaker").isin(*never)).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    head = F.when(own, F.lit("<|assistant|>\n")).when(F.col("speaker").isin(*never), F.concat(F.lit("<|"), F.col("speaker"), F.lit("|>\n"))).otherwise(F.concat(F.lit("<|user name="), F.col("speaker"), F.lit("|>\n")))
    parts = rows.join(who, "conv_id").select("conv_id", "perspective", "turn", "speaker", "block", own.alias("own"), F.length(head).alias("head"), F.concat(head, "said", F.lit("\n")).alias("part")).withColumn("n", F.length("part").cast("long"))
    key = ["conv_id", "perspective"]
    inside = Window.partitionBy(*key, "block").orderBy("turn", "speaker", "part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(*key, "block").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = totals.select(*key, "block", F.coalesce(F.sum("n").over(before), zero).alias("n0"), F.coalesce(F.sum("k").over(before), zero).alias("k0"))
    placed = parts.withColumn("n1", F.coalesce(F.sum("n").over(inside), zero)).withColumn("k1", F.count(F.lit(1)).over(inside)).join(offsets, [*key, "block"])
    start = F.col("n0") + F.col("n1")
    return placed.select(
        "conv_id", "perspective", "turn", "speaker", (F.col("k0") + F.col("k1")).alias("place"), "part", start.alias("start"), (start + F.col("n")).alias("end"),
        F.when(F.col("own"), start + F.col("head")).alias("mask_start"), F.when(F.col("own"), start + F.col("n") - 1).alias("mask_end"),
    )


def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {"op3_chat_perspectives": op3_chat_perspectives}
SQL = {
    "op3_chat_perspectives": """
WITH r AS (
  SELECT conv_id, turn, replace(replace(translate(CASE WHEN coalesce(length(role), 0) > 0 THEN role ELSE 'unknown' END, chr(13) || chr(10), '  '),
                                '<|', '<' || chr(8203) || '|'), '|>', '|' || chr(8203) || '>') AS speaker,
         replace(coalesce(text, ''), '<|', '<' || chr(8203) || '|') || '<|end|>' AS said
  FROM conversations WHERE conv_id IS NOT NULL),
w AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
p AS (
  SELECT conv_id, perspective, turn, speaker, speaker = perspective AS own, said,
         CASE WHEN speaker = perspective THEN '<|assistant|>' || chr(10) WHEN speaker = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user name=' || speaker || '|>' || chr(10) END AS head
  FROM r JOIN w USING (conv_id)),
q AS (SELECT *, head || said || chr(10) AS part FROM p),
o AS (
  SELECT *, row_number() OVER v - 1 AS place, CAST(sum(length(part)) OVER v AS BIGINT) - length(part) AS start
  FROM q WINDOW v AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, part ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, turn, speaker, CAST(place AS BIGINT) AS place, part, start, start + length(part) AS "end",
       CASE WHEN own THEN start + length(head) END AS mask_start, CASE WHEN own THEN start + length(part) - 1 END AS mask_end
FROM o"""
}
