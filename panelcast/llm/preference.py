"""Preference formatting (DataFrame operations only): two conversations that share their first turns
become one prompt, rendered once, and two completions with loss masks.

The prompt is the longest common prefix of turns (role and text equal), found with array functions.
A completion is everything after it. Its mask is a run-length list over the characters of the
completion: the text of an assistant turn with its end mark is trained on, all else is not.

Grouping is by pair, with turns as small rows; a conversation is one output row however it is
computed, so no group is larger than the row it makes.

Defined cases: turns without a conversation id are left out; null roles and texts are empty; turns
are ordered by number (null last), role and text; rows that repeat a whole turn count once; a pair
with one side missing or without a difference is kept and says so in ``status`` (``unpaired``,
``identical``), its completions being what is left after the prompt, possibly nothing. An empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import table

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"


def adjacent_pairs(turns: DataFrame) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) form pair k."""
    side = F.pmod(F.col("conv_id"), F.lit(2))
    return (turns.where("conv_id IS NOT NULL")
            .select(((F.col("conv_id") - side) / 2).cast("long").alias("pair_id"),
                    F.when(side == 0, "chosen").otherwise("rejected").alias("side"), "conv_id", "turn", "role", "text"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), turn["role"], F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """``array<struct<chars, train>>``: runs over the characters of ``render(turns)``."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.char_length(_header(t)).alias("chars"), F.lit(False).alias("train")),
        F.struct(F.char_length(_body(t)).alias("chars"), (t["role"] == TRAINED).alias("train")))))


def mask_text(runs: Column) -> Column:
    """Runs as text: ``18-,120+``."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["chars"].cast("string"),
                                                             F.when(r["train"], "+").otherwise("-"))), ",")


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    shorter = F.least(F.size(a), F.size(b))
    differs = F.filter(F.sequence(F.lit(0), shorter - 1), lambda i: (a[i]["role"] != b[i]["role"]) | (a[i]["text"] != b[i]["text"]))
    return F.when(shorter > 0, F.coalesce(F.array_min(differs), shorter)).otherwise(0)


def preference_rows(sided: DataFrame) -> DataFrame:
    """``pair_id, chosen_id, rejected_id, status, n_prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask`` of turns with ``pair_id, side, conv_id, turn, role, text``."""
    turn = F.struct(F.col("turn").isNull().alias("unnumbered"), F.col("turn").alias("turn"),
                    F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def side(name: str) -> list[Column]:
        mine = F.col("side") == name
        return [F.min(F.when(mine, F.col("conv_id"))).alias(f"{name}_id"),
                F.array_distinct(F.array_sort(F.collect_list(F.when(mine, turn)))).alias(f"{name}_turns")]

    rows = sided.groupBy("pair_id").agg(*side("chosen"), *side("rejected"))
    rows = rows.withColumn("n", common_turns(F.col("chosen_turns"), F.col("rejected_turns")))

    def rest(name: str) -> Column:
        turns = F.col(f"{name}_turns")
        return F.slice(turns, F.col("n") + 1, F.size(turns))

    status = (F.when(F.col("chosen_id").isNull() | F.col("rejected_id").isNull(), "unpaired")
              .when((F.col("n") == F.size("chosen_turns")) & (F.col("n") == F.size("rejected_turns")), "identical")
              .otherwise("pair"))
    return rows.select("pair_id", "chosen_id", "rejected_id", status.alias("status"), F.col("n").cast("long").alias("n_prompt_turns"),
                       render(F.slice("chosen_turns", F.lit(1), F.col("n"))).alias("prompt"),
                       render(rest("chosen")).alias("chosen"), render(rest("rejected")).alias("rejected"),
                       mask(rest("chosen")).alias("chosen_mask"), mask(rest("rejected")).alias("rejected_mask"))


def op1_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preference_rows(adjacent_pairs(table(spark, sf_dir, "conversations")))
    return rows.withColumns({c: mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, ((conv_id % 2) + 2) % 2 AS side, conv_id, role, text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS i,
             '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body FROM t),
p AS (SELECT pair_id, min(conv_id) FILTER (side = 0) AS chosen_id, min(conv_id) FILTER (side = 1) AS rejected_id,
             count(*) FILTER (side = 0) AS nc, count(*) FILTER (side = 1) AS nr FROM n GROUP BY pair_id),
d AS (SELECT a.pair_id, min(a.i) AS i FROM n a JOIN n b ON a.pair_id = b.pair_id AND a.i = b.i AND a.side = 0 AND b.side = 1
      WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair_id),
l AS (SELECT p.*, coalesce(d.i, least(nc, nr)) AS k FROM p LEFT JOIN d USING (pair_id)),
r AS (SELECT n.pair_id,
        string_agg(head || body, '' ORDER BY i) FILTER (i < k AND side = 0) AS prompt,
        string_agg(head || body, '' ORDER BY i) FILTER (i >= k AND side = 0) AS chosen,
        string_agg(head || body, '' ORDER BY i) FILTER (i >= k AND side = 1) AS rejected,
        string_agg(length(head) || '-,' || length(body) || CASE WHEN role = 'assistant' THEN '+' ELSE '-' END, ',' ORDER BY i)
          FILTER (i >= k AND side = 0) AS chosen_mask,
        string_agg(length(head) || '-,' || length(body) || CASE WHEN role = 'assistant' THEN '+' ELSE '-' END, ',' ORDER BY i)
          FILTER (i >= k AND side = 1) AS rejected_mask
      FROM n JOIN l USING (pair_id) GROUP BY n.pair_id)
SELECT pair_id, chosen_id, rejected_id,
       CASE WHEN chosen_id IS NULL OR rejected_id IS NULL THEN 'unpaired' WHEN k = nc AND k = nr THEN 'identical' ELSE 'pair' END AS status,
       k::BIGINT AS n_prompt_turns, coalesce(prompt, '') AS prompt, coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
       coalesce(chosen_mask, '') AS chosen_mask, coalesce(rejected_mask, '') AS rejected_mask
FROM l JOIN r USING (pair_id)
"""
