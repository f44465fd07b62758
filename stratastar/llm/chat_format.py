"""Chat formatting by prefix-target expansion, in DataFrame functions alone.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
text is under the loss mask [loss_start, loss_end), in characters of `formatted`. A conversation
that ends with another role gets one more example that holds all of it, with an empty mask, so
that no turn is missing from the output.

A turn is written as <|im_start|>role, a line feed, its text, <|im_end|> and a line feed. Inside
texts and roles a backslash is doubled and the bar of "<|" gets a backslash before it, so that no
marker can stand there; a line feed in a role becomes "<\\n". One backslash alone never comes from
the text, so replacing back in the other order restores it.

Defined cases: a null text or role is empty. Rows without a conv_id belong to no conversation and
are left out. Turns go by (turn, role, text), a null turn first; rows that repeat are turns each.
Other columns are not read. An empty table gives an empty result. A conversation has to fit into
one row, as each of its examples has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BACKSLASH = "\\"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    return _replace(_replace(text, BACKSLASH, BACKSLASH * 2), "<|", "<\\|")


def unescaped(text: Column) -> Column:
    return _replace(_replace(text, "<\\|", "<|"), BACKSLASH * 2, BACKSLASH)


def escaped_role(role: Column) -> Column:
    return _replace(escaped(role), "\n", "<\\n")


def unescaped_role(role: Column) -> Column:
    return unescaped(_replace(role, "<\\n", "\n"))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, n_turns, formatted, loss_start, loss_end), one row per example, from 0."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text")), _earlier).alias("turns"))
    written = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(CLOSE)))
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (F.element_at("turns", i)["role"] == "assistant") | (i == F.size("turns")))
    each = whole.select("conv_id", "turns", written.alias("written"), F.posexplode(ends).alias("example", "n_turns"))
    target = F.element_at("turns", F.col("n_turns"))
    size = F.when(target["role"] == "assistant", F.length(escaped(target["text"]))).otherwise(0)
    formatted = each.select("conv_id", "example", "n_turns", F.array_join(F.slice("written", F.lit(1), F.col("n_turns")), "").alias("formatted"), size.alias("size"))
    end = F.length("formatted") - len(CLOSE)
    return formatted.select("conv_id", "example", "n_turns", "formatted", (end - F.col("size")).alias("loss_start"), end.alias("loss_end"))


def _earlier(a: Column, b: Column) -> Column:
    """-1, 0 or 1 by turn (null first), role and text."""
    order = F.lit(0)
    for name in ("text", "role", "turn"):
        x, y = a[name], b[name]
        less = (x < y) | (x.isNull() & y.isNotNull())
        more = (x > y) | (x.isNotNull() & y.isNull())
        order = F.when(less, -1).when(more, 1).otherwise(order)
    return order


def turns_of(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted example."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        body = F.substr(part, F.lit(len(OPEN) + 1))
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(F.substr(body, F.length(role) + 2)).alias("text"))

    return F.transform(parts, turn)


def masked(formatted: Column, start: Column, end: Column) -> Column:
    """Text under the mask, unescaped."""
    return unescaped(F.substr(formatted, start + 1, end - start))
