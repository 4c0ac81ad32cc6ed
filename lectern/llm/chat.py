"""Preference formatting: the longest common turn prefix once as prompt, the two rests as masked completions.

One shuffle by pair; the comparison and the rendering are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(BEGIN), t["role"], F.lit("\n"), t["text"], F.lit(END))), "")


def _mask(turns: Column, learnt: str) -> Column:
    """Runs of characters, ``0*n`` without and ``1*n`` with loss: the text and end mark of the learnt role's turns."""
    head = lambda t: F.length(t["role"]) + len(BEGIN) + 1
    body = lambda t: F.length(t["text"]) + len(END)
    return F.array_join(F.transform(turns, lambda t: F.when(t["role"] == learnt, F.concat(F.lit("0*"), head(t).cast("string"), F.lit(",1*"), body(t).cast("string"))).otherwise(F.concat(F.lit("0*"), (head(t) + body(t)).cast("string")))), ",")


def preference_pairs(turns: DataFrame, *, pair: Column, chosen: Column, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learnt: str = "assistant") -> DataFrame:
    """(pair_id, chosen_id, rejected_id, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask) per pair.

    ``pair`` names a conversation's pair, ``chosen`` is true for the preferred one. Turns go by number, then role,
    then text; repeated rows are turns of their own. A null number sorts first, null role and text are empty. Rows
    of a null conversation belong to no pair. A missing side has a null id and no turns; equal conversations
    leave empty completions. Several conversations of one side of a pair follow each other by id. Empty table: no rows.
    """
    t = turns.select(F.col(f"`{conv}`").cast("long").alias("conv"), pair.alias("pair_id"), chosen.alias("side"), F.coalesce(F.col(f"`{turn}`").cast("long"), F.lit(-(2**63))).alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    t = t.where("conv is not null and pair_id is not null")
    row = F.struct("conv", "turn", "role", "text")
    g = t.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("side"), row))).alias("c"),
        F.sort_array(F.collect_list(F.when(~F.col("side"), row))).alias("r"),
    )
    both = F.least(F.size("c"), F.size("r"))
    differs = F.transform(F.arrays_zip(F.slice("c", 1, both).alias("c"), F.slice("r", 1, both).alias("r")), lambda x: (x["c"]["role"] == x["r"]["role"]) & (x["c"]["text"] == x["r"]["text"]))
    first = F.array_position(differs, False)
    g = g.withColumn("n", F.when(first > 0, first - 1).otherwise(both).cast("int"))
    rest = lambda a: F.slice(a, F.col("n") + 1, F.size(a))
    return g.select(
        "pair_id",
        F.try_element_at("c", F.lit(1))["conv"].alias("chosen_id"),
        F.try_element_at("r", F.lit(1))["conv"].alias("rejected_id"),
        F.col("n").alias("n_prefix"),
        _text(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _text(rest("c")).alias("chosen"),
        _text(rest("r")).alias("rejected"),
        _mask(rest("c"), learnt).alias("chosen_mask"),
        _mask(rest("r"), learnt).alias("rejected_mask"),
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id AS conv, CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS side,
         coalesce(turn, -9223372036854775808) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
g AS (
  SELECT pair_id,
         coalesce(list({'conv': conv, 'role': role, 'text': text} ORDER BY conv, turn, role, text) FILTER (WHERE side), []) AS c,
         coalesce(list({'conv': conv, 'role': role, 'text': text} ORDER BY conv, turn, role, text) FILTER (WHERE NOT side), []) AS r
  FROM t GROUP BY pair_id),
p AS (
  SELECT *, least(len(c), len(r)) AS shorter,
         list_position(list_transform(range(1, least(len(c), len(r)) + 1), lambda i: c[i].role = r[i].role AND c[i].text = r[i].text), false) AS bad
  FROM g),
n AS (SELECT *, CAST(CASE WHEN coalesce(bad, 0) > 0 THEN bad - 1 ELSE shorter END AS INTEGER) AS n FROM p)
SELECT pair_id, c[1].conv AS chosen_id, r[1].conv AS rejected_id, n AS n_prefix,
  coalesce(list_aggregate(list_transform(c[1:n], lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), 'string_agg', ''), '') AS prompt,
  coalesce(list_aggregate(list_transform(c[n + 1:], lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), 'string_agg', ''), '') AS chosen,
  coalesce(list_aggregate(list_transform(r[n + 1:], lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), 'string_agg', ''), '') AS rejected,
  coalesce(list_aggregate(list_transform(c[n + 1:], lambda x: CASE WHEN x.role = 'assistant' THEN '0*' || (length(x.role) + 13) || ',1*' || (length(x.text) + 11) ELSE '0*' || (length(x.role) + length(x.text) + 24) END), 'string_agg', ','), '') AS chosen_mask,
  coalesce(list_aggregate(list_transform(r[n + 1:], lambda x: CASE WHEN x.role = 'assistant' THEN '0*' || (length(x.role) + 13) || ',1*' || (length(x.text) + 11) ELSE '0*' || (length(x.role) + length(x.text) + 24) END), 'string_agg', ','), '') AS rejected_mask
FROM n
"""
