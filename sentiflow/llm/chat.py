"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only the
reply is trained on. A conversation that does not end with a reply adds one example without a target,
so that every turn is in the output.

The template marks each turn as ``<|role|>\\ntext<|end|>``. Texts and roles are escaped so that they
hold none of ``<``, ``[`` and ``|``, and so no control string of this or of other common templates;
reading the examples back undoes this exactly.

All turns of a conversation are gathered in one row, as an example needs them together. The formatted
text of its examples is made row by row from there and grows with the square of the turns, as the
method has it; nothing but the longest example is shuffled or gathered again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
END = "<|end|>"
#: Escapes, applied in this order and undone in the opposite one. Each leaves no bare backslash that
#: could be taken for another.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p"))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _opening(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def examples(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    Columns: ``conv_id``, ``turns`` (turns in the example), ``formatted``, ``mask_start`` and
    ``mask_chars`` (the trainable code points, from 0; no characters for an example without target)
    and ``last``, whether it holds the whole conversation.

    Turns go by ``turn`` (null first), equal ones by role and text. Null roles and texts are empty.
    Rows without ``conv_id`` make up one conversation. Without rows there are no examples. Other
    columns are ignored.
    """
    said = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    conversations = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("said"))
    marked = F.transform(
        "said",
        lambda t: F.struct(
            (t["role"] == TRAINED_ROLE).alias("trained"),
            F.concat(_opening(escape(t["role"])), escape(t["text"]), F.lit(END)).alias("block"),
            F.length(escape(t["text"])).alias("chars"),
        ),
    )
    size = F.size("marked")
    ends = F.filter(
        F.sequence(F.lit(1), size),
        lambda i: F.element_at("marked", i)["trained"] | (i == size),
    )
    target = F.element_at("marked", F.col("turns"))
    reply = F.when(target["trained"], target["chars"]).otherwise(0)
    formatted = F.array_join(F.transform(F.slice("marked", 1, F.col("turns")), lambda t: t["block"]), "")
    return (
        conversations.select("conv_id", marked.alias("marked"))
        .select("conv_id", "marked", F.explode(ends).alias("turns"))
        .select(
            "conv_id",
            "turns",
            formatted.alias("formatted"),
            reply.alias("mask_chars"),
            target["trained"].alias("trained"),
            (F.col("turns") == size).alias("last"),
        )
        .withColumn("mask_start", F.length("formatted") - F.col("mask_chars") - len(END))
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    blocks = F.split(formatted, r"<\|end\|>")
    turns = F.slice(blocks, 1, F.size(blocks) - 1)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring_index(F.substring(t, 3, 1 << 30), "|>\n", 1)).alias("role"),
            unescape(t.substr(F.instr(t, F.lit("|>\n")) + 3, F.length(t))).alias("text"),
        ),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from its examples alone: ``conv_id``, ``turns`` (role, text),
    ``trained``, all text under the masks in order, and ``formatted_chars`` of all examples."""
    masked = unescape(F.col("formatted").substr(F.col("mask_start") + 1, F.col("mask_chars")))
    reply = F.when(F.col("trained"), F.struct("turns", masked.alias("text")))
    whole = F.when(F.col("last"), F.col("formatted"))
    gathered = formatted.groupBy("conv_id").agg(
        F.max(whole).alias("whole"),
        F.array_sort(F.collect_list(reply)).alias("replies"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
    )
    return gathered.select(
        "conv_id",
        read_turns(F.col("whole")).alias("turns"),
        F.array_join(F.transform("replies", lambda r: r["text"]), "").alias("trained"),
        "formatted_chars",
    )
