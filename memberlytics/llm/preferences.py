"""Preference formatting: prompt and paired completions of chosen and rejected conversations.

The longest common turn prefix of both conversations is rendered once as the prompt; what follows are the two completions, in
which only the assistant's words are trained on.  All of it stays on the level of turns: turns are aligned by a join on (pair,
turn) and the prefix ends at the smallest turn that differs, so no conversation is gathered in one task, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.registry import query, table
from memberlytics.session import stage

TRAINED = "assistant"


def render(role: Column, text: Column) -> Column:
    """A turn in the training text; the header and the end mark are not trained on."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def _turns(conversations: DataFrame, side: str) -> DataFrame:
    """One row per (pair, turn); of repeated turns the one with the smallest role and text stays, null counts as empty."""
    c = conversations.filter("pair_id IS NOT NULL AND turn IS NOT NULL")
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return c.groupBy("pair_id", "turn").agg(F.min(said).alias(side))


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Segments of the pairs in (pair_id, turn, role, text) tables: pair_id, part, turn, role, rendered, train_start, train_end.

    ``part`` is prompt, chosen or rejected; the parts of a pair, in the order of their turns, are its training texts.
    ``train_start`` to ``train_end`` (code points of ``rendered``) is what the loss counts; both are 0 if nothing is.
    Pairs that lack a side, rows without pair or turn, and pairs without a difference give nothing.
    """
    both = _turns(chosen, "chosen").join(_turns(rejected, "rejected"), ["pair_id", "turn"], "full")
    both = stage(both, "aligned")
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    split = both.groupBy("pair_id").agg(
        F.min(F.when(differs, F.col("turn"))).alias("split"), F.max(F.col("chosen").isNotNull()).alias("has_chosen"),
        F.max(F.col("rejected").isNotNull()).alias("has_rejected"),
    )
    split = stage(split.filter("split IS NOT NULL AND has_chosen AND has_rejected").select("pair_id", "split"), "splits")
    rows = both.join(split, "pair_id")
    before = F.col("turn") < F.col("split")

    def part(name: str, side: str, when: Column) -> Column:
        return F.when(when & F.col(side).isNotNull(), F.struct(F.lit(name).alias("part"), F.col(side).alias("said")))

    parts = F.array(part("prompt", "chosen", before), part("chosen", "chosen", ~before), part("rejected", "rejected", ~before))
    rows = rows.select("pair_id", "turn", F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("p"))
    rows = rows.select("pair_id", "p.part", "turn", "p.said.role", "p.said.text")
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED)
    head = F.when(trained, F.length("role") + 5).otherwise(0).cast("long")
    return rows.select(
        "pair_id", "part", "turn", "role", render(F.col("role"), F.col("text")).alias("rendered"), head.alias("train_start"),
        (head + F.when(trained, F.length("text")).otherwise(0)).cast("long").alias("train_end"),
    )


def last_answers(conversations: DataFrame) -> DataFrame:
    """(conv_id, last, answer): the last assistant turn of each conversation."""
    said = conversations.filter((F.col("role") == TRAINED) & F.col("turn").isNotNull())
    return said.groupBy("conv_id").agg(F.max(F.struct(F.col("turn").alias("last"), F.col("text").alias("answer"))).alias("x")).select("conv_id", "x.*")


ORACLE = """WITH a AS (SELECT conv_id, max(turn) AS last, arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY 1),
w AS (SELECT a.conv_id, a.last, b.answer FROM a JOIN a b ON b.conv_id = a.conv_id + 1),
x AS (SELECT c.conv_id AS pair_id, c.turn, c.role, coalesce(c.text, '') AS text FROM conversations c JOIN w ON c.conv_id = w.conv_id),
y AS (SELECT c.conv_id AS pair_id, c.turn, c.role, coalesce(c.text, '') AS text FROM conversations c JOIN w ON c.conv_id = w.conv_id
  AND c.turn < w.last UNION ALL SELECT conv_id, last, 'assistant', coalesce(answer, '') FROM w),
j AS (SELECT coalesce(x.pair_id, y.pair_id) AS pair_id, coalesce(x.turn, y.turn) AS turn, x.role AS cr, x.text AS ct, y.role AS rr, y.text AS rt
  FROM x FULL JOIN y ON x.pair_id = y.pair_id AND x.turn = y.turn),
s AS (SELECT pair_id, min(turn) AS split FROM j WHERE cr IS DISTINCT FROM rr OR ct IS DISTINCT FROM rt GROUP BY 1),
p AS (SELECT j.pair_id, 'prompt' AS part, turn, cr AS role, ct AS text FROM j JOIN s ON j.pair_id = s.pair_id WHERE turn < split
  UNION ALL SELECT j.pair_id, 'chosen', turn, cr, ct FROM j JOIN s ON j.pair_id = s.pair_id WHERE turn >= split AND cr IS NOT NULL
  UNION ALL SELECT j.pair_id, 'rejected', turn, rr, rt FROM j JOIN s ON j.pair_id = s.pair_id WHERE turn >= split AND rr IS NOT NULL)
SELECT pair_id, part, turn, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
  CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 ELSE 0 END::BIGINT AS train_start,
  CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5 + length(text) ELSE 0 END::BIGINT AS train_end FROM p"""


@query("op5_preferences", ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with the last answer of the conversation with the next id in place of its own."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    answers = stage(last_answers(talks), "answers")
    other = answers.select((F.col("conv_id") - 1).alias("conv_id"), F.col("answer").alias("other"))
    swap = stage(answers.join(other, "conv_id").select("conv_id", "last", "other"), "swaps")
    mine = talks.join(swap, "conv_id")
    chosen = mine.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    end = swap.select(F.col("conv_id").alias("pair_id"), F.col("last").alias("turn"), F.lit(TRAINED).alias("role"), F.col("other").alias("text"))
    kept = mine.filter("turn < last").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    return format_pairs(chosen, kept.union(end))
