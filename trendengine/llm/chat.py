"""Conversations as one text each, by relational means: sorted turn structs, arrays, concatenation.

Template: ``<turn:ROLE>TEXT</turn>`` and a line feed; adjacent turns of one role share a block, with ``<next/>`` between
their texts. Inside texts and roles ``&`` becomes ``&amp;`` and ``<`` becomes ``&lt;`` (in roles ``>`` becomes ``&gt;``), so
control strings occur only as control strings and the texts come back exactly. The loss mask is a list of runs
(length in code points, loss or not): loss covers the escaped texts of assistant turns and nothing else.

What the mask covers is read from ``formatted`` and ``loss_runs`` alone (`loss_text`): a wrong mask gives a wrong text.

Only Spark expressions run here. A conversation is one row of the result, so its turns meet in one task; that is the feature,
and work per conversation is linear in its length. Turns are ordered by turn, then role, then text; a null text or role is
empty, a null turn comes first, rows with a null conv_id form a conversation of their own. Repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendengine.llm.common import table

OPEN, MIDDLE, NEXT, CLOSE = "<turn:", ">", "<next/>", "</turn>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("&gt;"))


def unescape(text: Column) -> Column:
    for seen, meant in (("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(seen), F.lit(meant))
    return text


def unescape_text(text: Column) -> Column:
    """Texts keep ``>`` as it is, so ``&gt;`` cannot come from the escape: only the other two are undone."""
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_runs) from rows (conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # beside each turn the roles of its neighbours, so that merging looks at one element at a time
    turns = turns.withColumn("n", F.size("turns")).select(
        "conv_id",
        "turns",
        F.concat(F.array(F.lit(None).cast("string")), F.slice("turns.role", F.lit(1), F.col("n") - 1)).alias("before"),
        F.concat(F.slice("turns.role", F.lit(2), F.col("n") - 1), F.array(F.lit(None).cast("string"))).alias("after"),
    )
    pieces = F.transform(
        F.arrays_zip("turns", "before", "after"),
        lambda x: F.struct(
            F.when(x["before"].eqNullSafe(x["turns"]["role"]), F.lit(NEXT))
            .otherwise(F.concat(F.lit(OPEN), escape_role(x["turns"]["role"]), F.lit(MIDDLE)))
            .alias("head"),
            escape(x["turns"]["text"]).alias("body"),
            F.when(x["after"].eqNullSafe(x["turns"]["role"]), F.lit("")).otherwise(F.lit(CLOSE)).alias("tail"),
            (x["turns"]["role"] == LOSS_ROLE).alias("loss"),
        ),
    )
    run = lambda text, loss: F.struct(F.length(text).cast("long").alias("length"), loss.alias("loss"))
    no = F.lit(False)
    return turns.select("conv_id", pieces.alias("pieces")).select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.flatten(
            F.transform("pieces", lambda p: F.array(run(p["head"], no), run(p["body"], p["loss"]), run(p["tail"], no)))
        ).alias("loss_runs"),
    )


def read_conversations(formatted: DataFrame) -> DataFrame:
    """``formatted`` and its turns (role, text), read back from the text alone."""
    blocks = F.split("formatted", CLOSE, -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)  # nothing follows the last mark

    def read(block):
        role = F.substring_index(F.substring(block, len(OPEN) + 1, 1 << 30), MIDDLE, 1)
        body = F.substr(block, F.length(role) + F.lit(len(OPEN) + len(MIDDLE) + 1))
        return F.transform(
            F.split(body, NEXT, -1), lambda t: F.struct(unescape(role).alias("role"), unescape_text(t).alias("text"))
        )

    return formatted.withColumn("turns", F.flatten(F.transform(blocks, read)))


def loss_text(formatted: Column, runs: Column) -> Column:
    """The text under the mask, unescaped. Each code point is looked at once, so this is linear in the text, whatever the runs."""
    mask = F.flatten(F.transform(runs, lambda r: F.array_repeat(r["loss"], r["length"].cast("int"))))
    marked = F.arrays_zip(F.split(formatted, "").alias("c"), mask.alias("loss"))
    return unescape_text(F.array_join(F.transform(F.filter(marked, lambda x: x["loss"]), lambda x: x["c"]), ""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    back = read_conversations(format_conversations(rows.unionByName(hard)))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = back.withColumn("loss", loss_text(F.col("formatted"), F.col("loss_runs")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS joined FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
p AS (
  SELECT *, length(text) + 4 * (length(text) - length(replace(text, '&', ''))) + 3 * (length(text) - length(replace(text, '<', '')))
    + CASE WHEN joined THEN 7 ELSE length('<turn:') + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) + 1 + 8 END AS n
  FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
