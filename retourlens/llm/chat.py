"""Chat formatting by prefix-target expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Put a backslash into every ``<|``, also where there are some already; no mark can remain."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: its backslashes are doubled and its line ends written as ``\\n``."""
    doubled = F.replace(escape(role), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(F.replace(lines, F.lit("\\\\"), F.lit("\\")))


def _header(role: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"))


def expand(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    target: str = "assistant",
) -> DataFrame:
    """One example for every turn of the role ``target``.

    Returns (conv, example, formatted, loss_start, loss_end): the example's
    number from 1, all preceding turns and the reply in the template, and the
    span of the reply's escaped text in code points, end exclusive. Nothing
    else is trainable. Turns after the last reply, or a conversation without
    one, give a last example of all turns without a span, so no turn is lost.

    Rows go by turn; equal turns by role and text, null turns first. Null roles
    and texts are empty; a null conversation is one of its own. A conversation
    is one training record and meets in one task, its examples grow with the
    square of its turns. Other columns of ``turns`` are ignored.
    """
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    said = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))
    parts = F.transform(
        "said",
        lambda t: F.struct(
            t["role"].alias("role"), _header(t["role"]).alias("header"), escape(t["text"]).alias("body"),
            F.concat(_header(t["role"]), escape(t["text"]), F.lit(END + "\n")).alias("formatted"),
        ),
    )
    n = F.size("parts")
    ends = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (F.element_at("parts", i)["role"] == target) | (i == n),
    )
    each = (
        said.select("conv", parts.alias("parts"))
        .select("conv", "parts", F.posexplode(ends).alias("at", "i"))
        .withColumn("last", F.element_at("parts", F.col("i")))
        .withColumn("before", F.array_join(F.slice("parts.formatted", F.lit(1), F.col("i") - 1), ""))
    )
    start = F.when(F.col("last.role") == target, F.length("before") + F.length("last.header")).cast("long")
    return each.select(
        F.col("conv").alias(conv), (F.col("at") + 1).cast("long").alias("example"),
        F.concat("before", "last.formatted").alias("formatted"), start.alias("loss_start"),
        (start + F.length("last.body")).alias("loss_end"),
    )


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What ``expand`` was given, from its output alone.

    Returns (conv, turns, loss_text, formatted_chars): the turns as an array of
    (role, text), all text under the loss mask in order of the examples, and
    the code points of all examples.
    """
    span = F.expr("substring(formatted, int(loss_start) + 1, int(loss_end - loss_start))")
    trained = F.struct("example", unescape(F.coalesce(span, F.lit(""))).alias("text"))
    whole = examples.groupBy(conv).agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.sort_array(F.collect_list(trained)).alias("trained"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    )
    # Escaped texts hold no mark, so each one ends where the next mark begins.
    pieces = F.slice(F.split("formatted", r"<\|im_end\|>\n"), F.lit(1), F.size(F.split("formatted", r"<\|im_end\|>\n")) - 1)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(F.substring(p, len(START) + 1, 1 << 30), "\n", 1)).alias("role"),
            unescape(F.regexp_replace(p, r"\A[^\n]*\n", "")).alias("text"),
        ),
    )
    return whole.select(conv, turns.alias("turns"), F.array_join("trained.text", "").alias("loss_text"), "formatted_chars")
