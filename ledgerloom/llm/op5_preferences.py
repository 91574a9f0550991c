"""Operator 5: preference formatting of chosen and rejected conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Turns of this role are trained on; all else is masked.
TRAINED = "assistant"


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))), "")


def _trained(turns: Column) -> Column:
    """(start, end) in the rendered turns of what is trained on: text and end mark of each turn of that role."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done: Column, t: Column) -> Column:
        start = done["at"] + F.length(t["role"]) + len("<||>\n")
        end = start + F.length(t["text"]) + len("<|end|>\n")
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED, F.concat(done["spans"], own)).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), add, lambda x: x["spans"])


def pairs(turns: DataFrame, chosen: Column, pair: Column, turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(pair, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask), one row for each pair.

    turns holds the turns of all conversations, `pair` names the pair of a turn and `chosen` says on which side it is.
    The longest prefix of equal turns (role and text) is rendered once, as the prompt; the rest of each side is its
    completion. mask: (start, end), in code points of a completion, of what its loss counts; all else is masked.
    Turns are ordered by turn, role and text, so ties and repeated rows have one order; null roles become `none`, null
    texts empty; turns without a pair or side are left out; a side without turns gives an empty completion. `<|` within a
    text becomes `< |`, so no text can forge a head. Other columns are not read.
    """
    clean = lambda c, empty: F.replace(F.coalesce(F.col(c).cast("string"), F.lit(empty)), F.lit("<|"), F.lit("< |"))
    rows = turns.select(pair.alias("pair"), chosen.alias("chosen"), F.struct(F.col(turn_col).alias("turn"), clean(role_col, "none").alias("role"), clean(text_col, "").alias("text")).alias("t"))
    rows = rows.where("pair is not null and chosen is not null")
    side = lambda is_chosen: F.sort_array(F.collect_list(F.when(F.col("chosen") == is_chosen, F.col("t"))))
    both = rows.groupBy("pair").agg(side(True).alias("c"), side(False).alias("r"))
    short = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(F.slice("c", F.lit(1), short), F.slice("r", F.lit(1), short), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    first = F.array_position(same, False)
    both = both.withColumn("n_prefix", F.when(first > 0, first - 1).otherwise(short).cast("long"))
    n = F.col("n_prefix").cast("int")
    rest = lambda c: F.slice(c, n + 1, F.size(c))
    return both.select(
        "pair", "n_prefix", _rendered(F.slice("c", F.lit(1), n)).alias("prompt"), _rendered(rest("c")).alias("chosen"), _rendered(rest("r")).alias("rejected"),
        _trained(rest("c")).alias("chosen_mask"), _trained(rest("r")).alias("rejected_mask"),
    )


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no preferences: of each two conversations 2k and 2k + 1 the even one counts as chosen. Masks are start:end, comma-joined."""
    out = pairs(common.table(spark, sf_dir, "conversations"), F.col("conv_id") % 2 == 0, F.shiftright("conv_id", 1))
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return out.select(F.col("pair").alias("pair_id"), "n_prefix", "prompt", "chosen", "rejected", written("chosen_mask"), written("rejected_mask"))


OP5_SQL = """
WITH t AS (
  SELECT conv_id >> 1 AS pair_id, conv_id & 1 AS side, replace(coalesce(role, 'none'), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT pair_id, n, max(CASE WHEN side = 0 THEN role END) AS cr, max(CASE WHEN side = 0 THEN text END) AS ct, max(CASE WHEN side = 1 THEN role END) AS rr, max(CASE WHEN side = 1 THEN text END) AS rt
  FROM t GROUP BY pair_id, n),
f AS (SELECT pair_id, coalesce(min(CASE WHEN cr = rr AND ct = rt THEN NULL ELSE n END), max(n) + 1) - 1 AS n_prefix FROM p GROUP BY pair_id),
r AS (
  SELECT p.*, f.n_prefix, '<|' || cr || '|>' || chr(10) || ct || '<|end|>' || chr(10) AS c, '<|' || rr || '|>' || chr(10) || rt || '<|end|>' || chr(10) AS j
  FROM p JOIN f USING (pair_id)),
m AS (
  SELECT *, sum(length(c)) FILTER (WHERE n > n_prefix) OVER w AS c_end, sum(length(j)) FILTER (WHERE n > n_prefix) OVER w AS j_end FROM r
  WINDOW w AS (PARTITION BY pair_id ORDER BY n))
SELECT pair_id, CAST(any_value(n_prefix) AS BIGINT) AS n_prefix,
  coalesce(string_agg(c, '' ORDER BY n) FILTER (WHERE n <= n_prefix), '') AS prompt,
  coalesce(string_agg(c, '' ORDER BY n) FILTER (WHERE n > n_prefix), '') AS chosen,
  coalesce(string_agg(j, '' ORDER BY n) FILTER (WHERE n > n_prefix), '') AS rejected,
  coalesce(string_agg(CAST(c_end - length(ct) - 8 AS BIGINT) || ':' || CAST(c_end AS BIGINT), ',' ORDER BY n) FILTER (WHERE n > n_prefix AND cr = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(CAST(j_end - length(rt) - 8 AS BIGINT) || ':' || CAST(j_end AS BIGINT), ',' ORDER BY n) FILTER (WHERE n > n_prefix AND rr = 'assistant'), '') AS rejected_mask
FROM m GROUP BY pair_id
"""
