"""Operator 8 [native]: preference formatting, in DataFrame functions only.

A pair has a chosen and a rejected conversation, each an array of turns. Their longest common
prefix of turns is rendered once as the prompt; the rest of each is its completion. A
completion comes with a mask: the spans of characters on which to train, which are the
assistant's turns (text and end mark, not the header); everything else is masked.

A turn is rendered as a header line ``<|role|>``, its text and a line ``<|end|>``. In roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can forge a mark and the
turns can be read back.

The query pairs every conversation with what its partner (the conv_id that differs in the
lowest bit) would have answered: chosen is the conversation, rejected is the same with the
last assistant turn's text replaced by the partner's last assistant text. Without a partner,
or an assistant turn on either side, both are the same and the completions are empty.

Defined results: null roles and texts are empty; a turn is ordered by turn (null first), role,
text, and repeated rows are turns of their own; a row with a null conv_id belongs to no
other and is a conversation of its own, without a partner; if one side is a prefix of the other its completion is
empty; an empty table gives no rows. Extra columns are ignored. A conversation is one row of
the result, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import running_sum, table

TRAINED_ROLE = "assistant"
END = "\n<|end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), escaped(role), F.lit("|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t["role"]), escaped(t["text"]), F.lit(END))), "")


def mask(turns: Column) -> Column:
    """``start:length`` of the trained spans in the rendered turns, in characters."""
    bodies = F.transform(turns, lambda t: F.char_length(escaped(t["text"])) + len(END))
    ends = running_sum(F.zip_with(bodies, turns, lambda body, t: body + F.char_length(header(t["role"]))))
    spans = F.zip_with(F.zip_with(ends, bodies, lambda end, body: F.concat((end - body).cast("string"), F.lit(":"), body.cast("string"))),
                       turns, lambda span, t: F.when(t["role"] == TRAINED_ROLE, span))
    return F.array_join(spans, ",")  # without the nulls


def common_turns(a: Column, b: Column) -> Column:
    """The number of leading turns that are equal in role and text."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    first = F.array_position(same, False)
    return F.when(first == 0, n).otherwise(first - 1).cast("int")


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as an array of (turn, role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    return rows.withColumn("__own", own).groupBy("conv_id", "__own").agg(F.sort_array(F.collect_list(turn)).alias("turns")).drop("__own")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (pair_id, chosen, rejected: arrays of turns) as prompt and masked completions."""
    rows = pairs.select("pair_id", "chosen", "rejected", common_turns(F.col("chosen"), F.col("rejected")).alias("n"))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.size(side))
    rows = rows.select("pair_id", "n", F.slice("chosen", 1, F.col("n")).alias("prompt"), rest(F.col("chosen")).alias("chosen"),
                       rest(F.col("rejected")).alias("rejected"))
    return rows.select("pair_id", F.col("n").alias("n_prompt_turns"), F.size("chosen").alias("n_chosen_turns"),
                       F.size("rejected").alias("n_rejected_turns"), rendered(F.col("prompt")).alias("prompt"),
                       rendered(F.col("chosen")).alias("chosen"), mask(F.col("chosen")).alias("chosen_mask"),
                       rendered(F.col("rejected")).alias("rejected"), mask(F.col("rejected")).alias("rejected_mask"))


def partner_pairs(rows: DataFrame) -> DataFrame:
    """Each conversation against itself with its partner's last answer."""
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i)))
    convs = conversations(rows).withColumn("last", last)
    answers = convs.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.get("turns", F.col("last"))["text"].alias("answer"))
    both = convs.join(answers, "conv_id", "left")
    swapped = F.transform("turns", lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"),
                                                         F.when(i == F.col("last"), F.col("answer")).otherwise(t["text"]).alias("text")))
    rejected = F.when(F.col("last").isNotNull() & F.col("answer").isNotNull(), swapped).otherwise(F.col("turns"))
    return both.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def op8_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_pairs(partner_pairs(table(spark, sf_dir, "conversations")))


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id, own ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos, own
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM conversations)),
l AS (SELECT conv_id, max(pos) AS pos FROM t WHERE role = 'assistant' GROUP BY conv_id),
a AS (SELECT t.conv_id, t.pos, t.text FROM t JOIN l ON t.conv_id = l.conv_id AND t.pos = l.pos),
s AS (
  SELECT t.conv_id, t.own, t.pos, t.role, t.text, CASE WHEN own.pos IS NOT NULL AND other.text IS NOT NULL THEN other.text ELSE t.text END AS swapped
  FROM t LEFT JOIN a own ON own.conv_id = t.conv_id AND own.pos = t.pos
  LEFT JOIN a other ON other.conv_id = xor(t.conv_id, 1::BIGINT)),
r AS (
  SELECT *, '<|' || replace(replace(role, '\', '\\'), '<|', '<\|') || '|>' || chr(10) AS head,
    replace(replace(text, '\', '\\'), '<|', '<\|') || chr(10) || '<|end|>' || chr(10) AS body,
    replace(replace(swapped, '\', '\\'), '<|', '<\|') || chr(10) || '<|end|>' || chr(10) AS other_body,
    coalesce(min(CASE WHEN text <> swapped THEN pos END) OVER (PARTITION BY conv_id, own) - 1, count(*) OVER (PARTITION BY conv_id, own)) AS n
  FROM s),
o AS (
  SELECT *, coalesce(sum(CASE WHEN pos > n THEN length(head || body) END) OVER w, 0) AS start_at,
    coalesce(sum(CASE WHEN pos > n THEN length(head || other_body) END) OVER w, 0) AS other_start
  FROM r WINDOW w AS (PARTITION BY conv_id, own ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id AS pair_id, max(n) AS n_prompt_turns, count(*) FILTER (pos > n) AS n_chosen_turns, count(*) FILTER (pos > n) AS n_rejected_turns,
  coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (pos <= n), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (pos > n), '') AS chosen,
  coalesce(string_agg((start_at + length(head))::BIGINT || ':' || length(body), ',' ORDER BY pos) FILTER (pos > n AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(head || other_body, '' ORDER BY pos) FILTER (pos > n), '') AS rejected,
  coalesce(string_agg((other_start + length(head))::BIGINT || ':' || length(other_body), ',' ORDER BY pos) FILTER (pos > n AND role = 'assistant'), '') AS rejected_mask
FROM o GROUP BY conv_id, own
"""
