"""Chat logs: collapse cumulative snapshots to maximal conversations, then render them.

A log holds a conversation again after every turn.  A rolling hash of its first i turns identifies a
prefix; conversations with equal full hashes are copies, and one whose full hash is a proper prefix of
another is a snapshot.  Hashes of 128 bits stand for the turns, so no text is compared or shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers of one stretch; rolling hashes are added up within stretches, then over stretches, so
#: that a conversation of any length is spread over tasks.
STRETCH = 256


def steps(conversations: DataFrame) -> DataFrame:
    """One row per conversation and turn number with a hash of its rows, in any order, repeats once."""
    row = [F.col("turn"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    hashed = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.xxhash64(*row).alias("a"), F.xxhash64(F.lit("b"), *row).alias("b")
    )
    return hashed.distinct().groupBy("conv_id", "turn").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def prefixes(turns: DataFrame) -> DataFrame:
    """Rolling hashes: for each conversation and each i, the hash of its first i turns."""
    stretch = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(2**62))).alias("stretch")
    turns = turns.withColumn("stretch", stretch)
    inside = Window.partitionBy("conv_id", "stretch").orderBy("turn")
    local = turns.select(
        "conv_id", "stretch", F.row_number().over(inside).alias("i"),
        F.bit_xor("a").over(inside).alias("a"), F.bit_xor("b").over(inside).alias("b"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        turns.groupBy("conv_id", "stretch")
        .agg(F.count("*").alias("i"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        .select("conv_id", "stretch", *[
            F.coalesce(f("%s" % c).over(earlier), F.lit(0)).alias(f"{c}0")
            for c, f in (("i", F.sum), ("a", F.bit_xor), ("b", F.bit_xor))
        ])
    )
    return local.join(before, ["conv_id", "stretch"]).select(
        "conv_id", (F.col("i") + F.col("i0")).alias("length"),
        F.col("a").bitwiseXOR(F.col("a0")).alias("a"), F.col("b").bitwiseXOR(F.col("b0")).alias("b"),
    )


def collapse(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, class_id (the smallest conv_id with the same turns),
    is_prefix (a longer conversation starts with all its turns), kept (the class's own id, no prefix).

    A turn is its number with all rows of that number: repeated rows count once, rows that share a number
    form one turn whatever their order, a null number comes first, null roles and texts are values of
    their own.  Rows without conv_id belong to no conversation.  An empty table gives no row; other
    columns are ignored.
    """
    turns = steps(conversations)
    key = ["length", "a", "b"]
    whole = turns.groupBy("conv_id").agg(
        F.count("*").alias("length"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")
    )
    classes = whole.groupBy(*key).agg(F.min("conv_id").alias("class_id"))
    ends = whole.select("conv_id", F.col("length").alias("n_turns"))
    extended = prefixes(turns).join(ends, "conv_id").where("length < n_turns").select(*key).distinct()
    maximal = classes.join(extended, key, "left_anti").withColumn("is_prefix", F.lit(False))
    snapshots = classes.join(extended, key, "left_semi").withColumn("is_prefix", F.lit(True))
    return whole.join(maximal.unionByName(snapshots), key).select(
        "conv_id", F.col("length").alias("n_turns"), "class_id", "is_prefix",
        (~F.col("is_prefix") & (F.col("conv_id") == F.col("class_id"))).alias("kept"),
    )


def render(conversations: DataFrame, collapsed: DataFrame) -> DataFrame:
    """``collapsed`` with ``text``: the kept conversations as one text of marked turns, null for others.

    Marks inside a message are broken up, so no message can forge a turn.  A null role is ``unknown``, a
    null message is empty.  A text is one value, so it is built in one task per conversation.
    """
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    turn = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), plain, F.lit("\n"))
    kept = collapsed.where("kept").select("conv_id")
    texts = (
        conversations.select("conv_id", "turn", "role", "text").join(kept, "conv_id", "left_semi").distinct()
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct(
            F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("message"),
            turn.alias("marked"),
        ))).alias("turns"))
        .select("conv_id", F.array_join(F.col("turns.marked"), "").alias("text"))
    )
    return collapsed.join(texts, "conv_id", "left")


#: The same in plain SQL, comparing lists of turns instead of hashes.
ORACLE = """
WITH turns AS (
  SELECT conv_id, turn, list_sort(list(DISTINCT {'r': role, 't': text})) AS said
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id, turn),
whole AS (
  SELECT conv_id, count(*) AS n_turns, list({'n': turn, 's': said} ORDER BY turn NULLS FIRST) AS said
  FROM turns GROUP BY conv_id),
starts AS (
  SELECT DISTINCT list_slice(said, 1, i) AS said
  FROM (SELECT said, unnest(range(1, n_turns)) AS i FROM whole)),
classes AS (
  SELECT said, min(conv_id) AS class_id, said IN (SELECT said FROM starts) AS is_prefix FROM whole GROUP BY said),
judged AS (
  SELECT conv_id, n_turns, class_id, is_prefix, NOT is_prefix AND conv_id = class_id AS kept
  FROM whole JOIN classes USING (said)),
texts AS (
  SELECT conv_id, string_agg(
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || replace(coalesce(text, ''), '<|', '< |') || chr(10), ''
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS text
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
  GROUP BY conv_id)
SELECT conv_id, n_turns, class_id, is_prefix, kept, CASE WHEN kept THEN text END AS text
FROM judged LEFT JOIN texts USING (conv_id)
"""
