"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context and only
its text is trainable.  A conversation that does not end with an assistant turn gets one more
example without a trainable part, so that no turn is missing from the output.

Template of a turn: ``<turn>role`` newline ``text</turn>`` newline.  Roles and texts are
escaped: ``&`` to ``&amp;``, ``<`` to ``&lt;`` and ``[`` to ``&#91;`` (in roles also a newline
to ``&#10;``), so no text can hold a control string of this template or of the usual chat
templates, and ``unescape`` gives the text back exactly.

Defined results: a null text or role is empty; rows of one conversation are ordered by turn
(nulls first), then role, then text; repeated rows are turns of their own; rows with a null
conversation id form one conversation; an empty table gives no example.  Only the four named
columns are read, so further columns cannot clash.  A conversation is one row of the output's
longest example, hence its turns meet in one task, as the output itself demands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text: Column) -> Column:
    """Replace the first character of every control string and the escape character."""
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """Inverse of ``escape``; the escape character comes last."""
    for coded, plain in (("&#10;", "\n"), ("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def prefix_targets(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text",
                   trainable: str = "assistant") -> DataFrame:
    """One row per example: ``conv_id, example, formatted, loss_start, loss_chars``.

    ``formatted`` is the whole example; its trainable part is the ``loss_chars`` characters
    after the first ``loss_start`` ones (none in a closing example without a reply).
    """
    filled = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    head = F.concat(F.lit(OPEN), F.replace(escape(filled[0]), F.lit("\n"), F.lit("&#10;")),
                    F.lit("\n"))
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), filled[0].alias("role"), filled[1].alias("text"),
                 head.alias("head"), escape(filled[1]).alias("body")).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    ends = F.filter(F.sequence(F.lit(1), F.size("t")), lambda i: (
        (F.element_at("t", i)["role"] == trainable) | (i == F.size("t"))))
    # All turns before the example's last one, which is shown apart to place the mask.
    before = F.array_join(F.transform(
        F.slice("t", F.lit(1), F.col("end") - 1),
        lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    last = F.element_at("t", F.col("end"))
    trained = last["role"] == trainable
    return (
        grouped.select("conv_id", "t", F.posexplode(ends).alias("example", "end"))
        .select("conv_id", "example", before.alias("before"), last.alias("last"),
                trained.alias("trained"))
        .select(
            "conv_id", "example",
            F.concat("before", "last.head", "last.body", F.lit(CLOSE)).alias("formatted"),
            (F.length("before") + F.length("last.head")).alias("loss_start"),
            F.when(F.col("trained"), F.length("last.body")).otherwise(0).alias("loss_chars"),
        )
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digest per conversation, parsed from the formatted examples and their masks alone.

    ``n_turns, turns_sha256`` come from the longest example, which holds all turns;
    ``loss_chars, loss_sha256`` from the masked parts in order; ``formatted_chars`` is the
    length of all examples together.
    """
    loss = unescape(F.expr("substring(formatted, loss_start + 1, loss_chars)"))
    parsed = F.transform(
        F.slice(F.split("whole", "</turn>\n"), 1, F.size(F.split("whole", "</turn>\n")) - 1),
        lambda x: F.concat(
            unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), "\n", 1)), F.lit("\n"),
            unescape(F.substr(x, F.locate("\n", x) + 1)), F.lit("\n")))
    return (
        examples.select("conv_id", "example", "formatted", loss.alias("loss"))
        .groupBy("conv_id").agg(
            F.max_by("formatted", "example").alias("whole"),
            F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
            F.sum(F.length("formatted")).alias("formatted_chars"))
        .select("conv_id", parsed.alias("turns"),
                F.array_join(F.col("losses.loss"), "").alias("loss"), "formatted_chars")
        .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
                F.length("loss").cast("long").alias("loss_chars"),
                F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
    )
