"""Operator 10: chat formatting with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import table

BEGIN, ROLE, TEXT, NEXT, END = "<s>", "[ROLE]", "[TEXT]", "[NEXT]", "</s>"
LOSS_ROLE = "assistant"
#: Control strings begin with `<` or `[`, so escaped text holds none, whole or in part.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))


def escape(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text






def format_chats(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_spans (code points from 0, end exclusive).

    Turns are collected as structs and sorted by turn (null first), role and text. Adjacent
    turns of one role become one block whose texts stay apart by a marker, so that each turn
    can be read back. The spans cover the text of every assistant turn, markers left out.

    Null role and null text count as empty; an empty text has an empty span. Repeated rows are
    turns of their own. Rows with null conv_id form one conversation. An empty table gives an
    empty result. Columns other than conv_id, turn, role and text are not read.

    A conversation is one value of the result and so is built in one task.
    """
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            )
        ).alias("turns")
    )
    escaped = collected.select(
        "conv_id",
        F.transform("turns", lambda t: escape(t.role)).alias("roles"),
        F.transform("turns", lambda t: escape(t.text)).alias("texts"),
    )
    # positions (from 1) at which a block begins
    starts = escaped.withColumn(
        "starts",
        F.filter(
            F.sequence(F.lit(1), F.size("roles")),
            lambda i: (i == 1) | (F.element_at("roles", i) != F.element_at("roles", F.greatest(i - 1, F.lit(1)))),
        ),
    )
    blocks = starts.withColumn(
        "blocks",
        F.transform(
            "starts",
            lambda start, k: F.struct(
                F.element_at("roles", start).alias("role"),
                F.slice(
                    F.col("texts"), start,
                    F.coalesce(F.get("starts", k + 1), F.size("roles") + 1) - start,
                ).alias("texts"),
            ),
        ),
    )
    formatted = F.concat(
        F.lit(BEGIN),
        F.array_join(
            F.transform(
                "blocks",
                lambda b: F.concat(F.lit(ROLE), b.role, F.lit(TEXT), F.array_join(b.texts, NEXT), F.lit(END)),
            ),
            "",
        ),
    )
    # per turn: what stands before its text, and whether it is under the mask
    marked = blocks.withColumn(
        "parts",
        F.transform(
            "texts",
            lambda text, i: F.struct(
                F.when(i == 0, F.length(F.element_at("roles", i + 1)) + len(BEGIN + ROLE + TEXT))
                .when(F.element_at("roles", i + 1) == F.get("roles", i - 1), F.lit(len(NEXT)))
                .otherwise(F.length(F.element_at("roles", i + 1)) + len(END + ROLE + TEXT))
                .alias("gap"),
                F.length(text).alias("length"),
                (F.element_at("roles", i + 1) == LOSS_ROLE).alias("loss"),
            ),
        ),
    )
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<struct<start int, end int>>)").alias("spans")),
        lambda seen, part: F.struct(
            (seen.at + part.gap + part.length).alias("at"),
            F.when(
                part.loss,
                F.array_append(
                    seen.spans,
                    F.struct((seen.at + part.gap).alias("start"), (seen.at + part.gap + part.length).alias("end")),
                ),
            ).otherwise(seen.spans).alias("spans"),
        ),
        lambda seen: seen.spans,
    )
    return marked.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, each as it went in."""
    blocks = F.filter(F.split(F.substring(formatted, len(BEGIN) + 1, 2**31 - 1), END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        halves = F.split(block, r"\[TEXT\]", -1)
        role = unescape(F.substring(F.element_at(halves, 1), len(ROLE) + 1, 2**31 - 1))
        texts = F.split(F.element_at(halves, 2), r"\[NEXT\]", -1)
        return F.transform(texts, lambda text: F.struct(role.alias("role"), unescape(text).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s.start + 1, s.end - s.start))), ""
    )


#: A conversation of control strings, formatted along with the table.
PROBE = """
    SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
    FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)
"""


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = format_chats(turns.unionByName(spark.sql(PROBE)))
    read = chats.select(
        "conv_id", "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP10_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)
), sized AS (
    SELECT *,
        length(role) + length(role) - length(translate(role, '\<[', '')) AS role_size,
        length(text) + length(text) - length(translate(text, '\<[', '')) AS text_size,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS opens
    FROM rows
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(3 + sum(text_size + CASE WHEN opens THEN role_size + 16 ELSE 6 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
