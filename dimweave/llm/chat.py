"""Chat formatting: a finite-state machine over roles and a declarative template.

``TEMPLATE`` gives each role the control strings around its text and whether the text counts for the
loss. ``MACHINE`` gives the roles that may follow a state; the state is the role of the turn before.
Every turn becomes segments (text, loss flag); a turn that the machine does not allow is kept and flagged.
Other roles are written out by name, so that every turn can be read back.

Control strings inside texts are escaped with a backslash after their first character, and
backslashes are doubled. Each control string has ``<`` or ``[`` as first character and nowhere else, so
none can arise at a seam, and a formatted turn is read back by cutting off its control strings.

DataFrame functions only. The state needs one sort of each conversation, which spills; segments are
rows, so a long conversation is never one value while it is formatted. Only the digests of a
conversation gather it whole, as a digest of one text must.

Nulls and ties: a null text or role is empty; turns of equal number are ordered by role and text; a null
turn comes first; null conv_ids form one conversation. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: role: (control string before, control string after, counts for the loss)
TEMPLATE = {
    "system": ("[SYS]", "[/SYS]", False),
    "user": ("[INST]", "[/INST]", False),
    "assistant": ("<s>", "</s>", True),
}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")  # around the name and the text of any other role
MACHINE = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
CONTROLS = [c for before, after, _ in TEMPLATE.values() for c in (before, after)] + list(OTHER)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROLS, doubled)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _by_role(role: Column, known, other) -> Column:
    """``known(before, after, loss)`` for the roles of the template, ``other`` for the rest."""
    out = None
    for name, parts in TEMPLATE.items():
        out = F.when(role == name, known(*parts)) if out is None else out.when(role == name, known(*parts))
    return out.otherwise(other)


def segment(text: Column, loss: Column | bool) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def format_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``number`` (from 1), ``allowed`` and ``segments`` of every turn."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.select("*", F.row_number().over(order).alias("number"), F.coalesce(F.lag("role").over(order), F.lit("")).alias("state"))
    allowed = reduce(Column.__or__, [(F.col("state") == s) & F.col("role").isin(*roles) for s, roles in MACHINE.items()])
    body = escaped(F.col("text"))
    named = F.array(segment(F.lit(OTHER[0]), False), segment(escaped(F.col("role")), False), segment(F.lit(OTHER[1]), False), segment(body, False), segment(F.lit(OTHER[2]), False))
    segments = _by_role(F.col("role"), lambda before, after, loss: F.array(segment(F.lit(before), False), segment(body, loss), segment(F.lit(after), False)), named)
    return turns.select("conv_id", "number", allowed.alias("allowed"), segments.alias("segments"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``number``, ``role``, ``text``, ``loss_text`` and ``chars`` parsed from the written segments."""
    whole = formatted.select("conv_id", "number", F.array_join("segments.text", "").alias("whole"),
                             F.array_join(F.filter("segments", lambda s: s["loss"])["text"], "").alias("loss_text"))
    role = None
    for name, (before, _, _) in TEMPLATE.items():
        role = F.when(F.startswith("whole", F.lit(before)), name) if role is None else role.when(F.startswith("whole", F.lit(before)), name)
    whole = whole.withColumn("known", role)
    chars = F.length("whole")

    def cut(before: str, after: str) -> Column:
        return F.substr("whole", F.lit(len(before) + 1), chars - len(before) - len(after))

    named = F.split(cut(OTHER[0], OTHER[2]), r"\[TEXT\]")
    body = _by_role(F.col("known"), lambda before, after, _: cut(before, after), F.get(named, F.lit(1)))
    return whole.select("conv_id", "number", F.coalesce("known", unescaped(F.get(named, F.lit(0)))).alias("role"), unescaped(body).alias("text"),
                        unescaped(F.col("loss_text")).alias("loss_text"), chars.alias("chars"))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Counts and digests of each conversation from its parsed turns."""
    line = F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("line")
    ordered = F.sort_array(F.collect_list(F.struct("number", line, "loss_text")))
    grouped = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), ordered.alias("turns"), F.sum(F.length("loss_text")).alias("loss_chars"),
                                           F.sum("chars").alias("formatted_chars"))
    return grouped.select("conv_id", "n_turns", F.sha2(F.array_join("turns.line", ""), 256).alias("turns_sha256"), "loss_chars",
                          F.sha2(F.array_join("turns.loss_text", ""), 256).alias("loss_sha256"), "formatted_chars")
