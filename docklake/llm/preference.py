"""Preference pairs as text: the turns two conversations share are rendered once, the rest as masked completions.

Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END_OF_TURN = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def _opening(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _content(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END_OF_TURN))


def rendered(turns: Column) -> Column:
    """Turns ``(turn, role, text)`` as one text."""
    return F.array_join(F.transform(turns, lambda turn: F.concat(_opening(turn), _content(turn))), "")


def trained_spans(turns: Column) -> Column:
    """``start:end`` of what is trained on, in characters of the rendered text, joined by commas.

    That is what the assistant says and the mark that ends it.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        first = state["at"] + F.length(_opening(turn))
        last = first + F.length(_content(turn))
        span = F.concat(first.cast("string"), F.lit(":"), last.cast("string"))
        own = F.when(turn["role"] == TRAINED_ROLE, F.array(span)).otherwise(F.array().cast("array<string>"))
        return F.struct(last.alias("at"), F.concat(state["spans"], own).alias("spans"))

    return F.aggregate(turns, start, step, lambda state: F.array_join(state["spans"], ","))


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two conversations share from the start, by role and text."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first_other = F.array_position(same, False).cast("int")
    return F.when(first_other > 0, first_other - 1).otherwise(F.size(same))


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """One row per pair of ``turns(turn, role, text)``: what both conversations begin with, and how each goes on.

    ``pair`` numbers the pair of a row's conversation, ``chosen`` says which of the two it is; rows for which either is
    null are in no pair. The columns are ``pair_id, complete, prompt_turns, prompt, chosen, rejected, chosen_spans,
    rejected_spans``; the prompt is not trained on. Turns go by ``turn`` (null first), role and text; a repeated row counts once.
    Null roles and texts count as empty, and a text's own turn marks are broken by a space. With one conversation
    only, a pair is not ``complete``, nothing is shared and the other side is empty. An empty table gives none.

    One shuffle by pair brings the turns of two conversations together. A conversation becomes one training example,
    so like a document's text it must fit in a row.
    """
    plain = lambda name: F.replace(F.coalesce(F.col(name), F.lit("")), F.lit(OPEN), F.lit("< |"))
    turn = F.struct("turn", plain("role").alias("role"), plain("text").alias("text"))
    own = turns.select(pair.alias("pair_id"), chosen.alias("is_chosen"), turn.alias("own")).where("pair_id is not null and is_chosen is not null")
    sides = own.groupBy("pair_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("is_chosen"), F.col("own")))).alias("a"),
        F.array_sort(F.collect_set(F.when(~F.col("is_chosen"), F.col("own")))).alias("b"),
    )
    counted = sides.withColumn("n", common_turns(F.col("a"), F.col("b")))
    prompt = F.slice("a", F.lit(1), F.col("n"))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    return counted.select(
        "pair_id", ((F.size("a") > 0) & (F.size("b") > 0)).alias("complete"), F.col("n").alias("prompt_turns"),
        rendered(prompt).alias("prompt"), rendered(rest("a")).alias("chosen"), rendered(rest("b")).alias("rejected"),
        trained_spans(rest("a")).alias("chosen_spans"), trained_spans(rest("b")).alias("rejected_spans"),
    )


ORACLE = r"""
WITH own AS (
    SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS is_chosen, turn, replace(coalesce(role, ''), '<|', '< |') AS role,
        replace(coalesce(text, ''), '<|', '< |') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY pair_id, is_chosen ORDER BY turn NULLS FIRST, role, text) AS pos FROM own
), sizes AS (
    SELECT pair_id, count(*) FILTER (is_chosen) AS size_a, count(*) FILTER (NOT is_chosen) AS size_b FROM placed GROUP BY pair_id
), differing AS (
    SELECT a.pair_id, min(a.pos) AS pos FROM placed a JOIN placed b
    ON a.pair_id = b.pair_id AND a.pos = b.pos AND a.is_chosen AND NOT b.is_chosen
    WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair_id
), common AS (
    SELECT pair_id, size_a > 0 AND size_b > 0 AS complete, coalesce(pos - 1, least(size_a, size_b))::INTEGER AS n
    FROM sizes LEFT JOIN differing USING (pair_id)
), segments AS (
    SELECT pair_id, is_chosen, pos, n, role = 'assistant' AS trained, pos <= n AS shared, '<|' || role || '|>' || chr(10) AS opening,
        text || '<|end|>' || chr(10) AS content
    FROM placed JOIN common USING (pair_id)
), ended AS (
    SELECT *, sum(length(opening) + length(content)) OVER (PARTITION BY pair_id, is_chosen, shared ORDER BY pos) AS ends FROM segments
), texts AS (
    SELECT pair_id, coalesce(string_agg(opening || content, '' ORDER BY pos) FILTER (is_chosen AND shared), '') AS prompt,
        coalesce(string_agg(opening || content, '' ORDER BY pos) FILTER (is_chosen AND NOT shared), '') AS chosen,
        coalesce(string_agg(opening || content, '' ORDER BY pos) FILTER (NOT is_chosen AND NOT shared), '') AS rejected,
        coalesce(string_agg((ends - length(content))::BIGINT || ':' || ends::BIGINT, ',' ORDER BY pos) FILTER (is_chosen AND NOT shared AND trained), '') AS chosen_spans,
        coalesce(string_agg((ends - length(content))::BIGINT || ':' || ends::BIGINT, ',' ORDER BY pos) FILTER (NOT is_chosen AND NOT shared AND trained), '') AS rejected_spans
    FROM ended GROUP BY pair_id
)
SELECT pair_id, complete, n AS prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans FROM texts JOIN common USING (pair_id)
"""
