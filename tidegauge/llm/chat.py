"""Chat formatting: one training example per assistant turn, all turns before it as context, only the reply trainable.

A conversation is formatted once. Each turn becomes `<|start|>role<|says|>text<|end|>`; in roles and texts `~`, `<` and `[`
are written `~0`, `~1` and `~2`, so no control string (these marks, `</s>`, `[INST]`, ...) can stand inside them, and the
way back is exact. An example is a prefix of the formatted conversation: the prompt, and behind it the reply under the
loss mask. Prompts are cut from the one formatted text row by row as they are read, so a long conversation needs memory in
proportion to its length; only a table of written prompts grows with the square of the turns, as the expansion means.
Turns behind the last reply form one more example with an empty trainable part.

Defined cases: a null text or role is empty; rows without a conversation id form one conversation; turns go in ascending
order, null first, ties by role and text; repeated rows are repeated turns; an empty table gives no rows; extra columns
are ignored. A formatted conversation is one value, so it must fit a string (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SAYS, END = "<|start|>", "<|says|>", "<|end|>"
# Written in this order and read back in the reverse one: the escape sign goes first.
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))
REPLY = "assistant"


def escaped(text: Column) -> Column:
    for plain, mark in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: `conv_id`, `formatted` and `spans`, an array of (example, prompt, reply) in characters.

    One shuffle: numbering, running lengths and gathering all go by conversation.
    """
    plain = turns.select(
        "conv_id",
        F.col("turn").alias("_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("_role"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )
    pieces = plain.select(
        "*",
        F.concat(F.lit(START), escaped(F.col("_role")), F.lit(SAYS)).alias("_head"),
        escaped(F.col("_text")).alias("_body"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    size = F.length("_head") + F.length("_body") + F.lit(len(END))
    placed = pieces.select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        F.sum(size.cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("stop"),
        F.concat("_head", "_body", F.lit(END)).alias("piece"),
        F.when(F.col("_role") == REPLY, F.length("_body")).otherwise(-1).cast("bigint").alias("reply"),
    )
    gathered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "stop", "piece", "reply"))).alias("_all")
    )
    replies = F.transform(
        F.filter("_all", lambda t: t["reply"] >= 0),
        lambda t, i: F.struct(
            (i + 1).alias("example"), (t["stop"] - t["reply"] - len(END)).alias("prompt"), t["reply"].alias("reply")
        ),
    )
    last = F.element_at("_all", -1)
    tail = F.struct(F.size("_replies") + 1, last["stop"], F.lit(0).cast("bigint"))
    return gathered.withColumn("_replies", replies).select(
        "conv_id",
        F.size("_all").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("_all", lambda t: t["piece"]), "").alias("formatted"),
        F.when(last["reply"] >= 0, F.col("_replies"))
        .otherwise(F.concat("_replies", F.array(tail).cast("array<struct<example:int,prompt:bigint,reply:bigint>>")))
        .alias("spans"),
    )


def examples(conversations: DataFrame) -> DataFrame:
    """Explode to one row per training example: `conv_id`, `example`, `prompt`, `reply`, `close`, `chars`, `is_last`.

    `prompt` is the context as the model sees it, `reply` the text under the loss mask (still escaped), `close` the mark
    behind it, `chars` the length of the three.
    """
    opened = conversations.select("conv_id", "formatted", F.size("spans").alias("_n"), F.explode("spans").alias("_s"))
    cut = lambda begin, size: F.substring(F.col("formatted"), begin.cast("int"), size.cast("int"))
    prompt, reply = F.col("_s")["prompt"], F.col("_s")["reply"]
    # a span at the very end belongs to turns without a reply: nothing closes it
    closed = prompt + reply < F.length("formatted")
    return opened.select(
        "conv_id",
        F.col("_s")["example"].alias("example"),
        cut(F.lit(1), prompt).alias("prompt"),
        cut(prompt + 1, reply).alias("reply"),
        F.when(closed, F.lit(END)).otherwise("").alias("close"),
        (prompt + reply + F.when(closed, len(END)).otherwise(0)).alias("chars"),
        (F.col("_s")["example"] == F.col("_n")).alias("is_last"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as an array of (role, text), unescaped."""
    parts = F.split(text, r"<\|end\|>")
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            unescaped(F.substring_index(F.substr(p, F.lit(len(START) + 1)), SAYS, 1)).alias("role"),
            unescaped(F.substring_index(p, SAYS, -1)).alias("text"),
        ),
    )


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations plus number -1, whose two turns consist of control strings."""
    spark, probe = turns.sparkSession, "</s>[INST] ok [/INST]"
    rows = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(REPLY).alias("role"),
        F.lit(probe).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(rows)


def chat_report(turns: DataFrame) -> DataFrame:
    """Query of the operator: digests of turns and of the loss text, read back from the examples."""
    made = examples(format_conversations(with_probe(turns)))
    whole = F.max(F.when(F.col("is_last"), F.concat("prompt", "reply", "close")))
    read = made.groupBy("conv_id").agg(
        whole.alias("_whole"),
        F.sort_array(F.collect_list(F.struct("example", "reply"))).alias("_replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    lines = F.transform(F.col("_turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("_replies", lambda r: unescaped(r["reply"])), "")
    return (
        read.withColumn("_turns", read_turns(F.col("_whole")))
        .withColumn("_loss", loss)
        .select(
            "conv_id",
            F.size("_turns").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.length("_loss").cast("bigint").alias("loss_chars"),
            F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(role) + length(text) + 24
            + length(regexp_replace(role || text, '[^~<\[]', '', 'g')) AS size
  FROM turns),
run AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS stop,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back
  FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR back = 1 THEN stop ELSE 0 END)::BIGINT AS formatted_chars
FROM run GROUP BY conv_id"""
