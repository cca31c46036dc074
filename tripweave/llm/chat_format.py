"""Conversations as one marked-up text each, checked by reading it back.

Grammar of the output, turn after turn::

    turn := "### " role ": " body "\\n</turn>\\n"

A body holds no bare control string ("### " or "</turn>"); a control string inside a text
gets one backslash in front of the backslashes it already has, and the reader takes one
away. Roles escape colons and backslashes. Each run of turns is rendered as it is, read back by
``parse`` and compared with its source; what differs is rendered again with escapes. The
assembled conversation is read back once more and the job fails if it differs.

Turns are rendered in runs of ``RUN`` consecutive turn numbers, so that the rows of one
long conversation meet only as few, already joined pieces. Built-in functions only.

Defined results: null texts and roles are empty; a null turn number sorts first; equal turn
numbers sort by role and text and are all kept; null conversation ids are one conversation;
further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RUN = 32
OPEN, MID, CLOSE = "### ", ": ", "\n</turn>\n"
CONTROL = r"### |</turn>"
TRAINED = "assistant"
TURN = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+)({CONTROL})", r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+)({CONTROL})", "$1$2")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, r"([\\:])", r"\\$1"), "\n", r"\\n")


def unescape_role(role: Column) -> Column:
    plain = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*+)\\n", "$1\n")
    return F.regexp_replace(plain, r"\\([\\:])", "$1")


def render(turns: Column, escaped: bool) -> Column:
    """Texts of the turns, each with its markers."""
    role, text = (escape_role, escape) if escaped else (lambda c: c, lambda c: c)
    return F.transform(
        turns,
        lambda t: F.concat(
            F.lit(OPEN), role(t["role"]), F.lit(MID), text(t["text"]), F.lit(CLOSE)
        ),
    )


def parse(formatted: Column) -> Column:
    """The turns of a rendered text, or null if it breaks the grammar."""
    # possessive: the matcher takes repeated groups in a loop, so that roles may be of any length
    head = r"(?s)^### ((?:[^\\:\n]++|\\[\\:n])*+): (.*+)$"
    parts = F.split(formatted, CLOSE, -1)
    bodies = F.slice(parts, 1, F.size(parts) - 1)
    read = F.transform(
        bodies,
        lambda p: F.struct(
            unescape_role(F.regexp_extract(p, head, 1)).alias("role"),
            unescape(F.regexp_extract(p, head, 2)).alias("text"),
        ),
    )
    good = F.forall(
        bodies,
        lambda p: p.rlike(head)
        & ~F.regexp_extract(p, head, 2).rlike(rf"(?<!\\)(?:{CONTROL})"),
    )
    return F.when((F.element_at(parts, -1) == "") & good, read)


def _masked(pieces: Column, turns: Column) -> Column:
    """Spans (from 1) of the trained bodies inside one run of rendered turns."""
    body = lambda i: F.length(F.get(pieces, i))
    before = lambda i: F.aggregate(
        F.slice(pieces, 1, i), F.lit(0), lambda n, p: n + F.length(p)
    )
    order = F.sequence(F.lit(0), F.size(pieces) - 1)
    trained = F.filter(order, lambda i: F.get(turns, i)["role"] == TRAINED)
    frame = len(OPEN) + len(TRAINED) + len(MID)
    return F.transform(
        trained,
        lambda i: F.struct(
            (before(i) + frame + 1).alias("start"),
            (body(i) - frame - len(CLOSE)).alias("length"),
        ),
    )


def format_chats(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``loss_spans`` and ``runs``.

    ``loss_spans`` are start (from 1, in code points) and length of the bodies that a model
    is trained on, escapes included. ``runs`` holds the same text in pieces, with the spans
    relative to each piece; reading spans from a piece costs no walk through the whole text.
    """
    said = rows.select(
        F.col(f"`{conversation}`").alias("conversation"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    runs = (
        said.groupBy("conversation", F.floor(F.col("turn") / RUN).alias("run"))
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
        .withColumn("turns", F.transform("turns", lambda t: t.dropFields("turn")))
    )
    turns = F.col("turns")
    runs = (
        runs.withColumn("pieces", render(turns, escaped=False))
        .withColumn("same", parse(F.array_join("pieces", "")).eqNullSafe(turns))
        .withColumn("pieces", F.when(F.col("same"), F.col("pieces")).otherwise(render(turns, True)))
        .withColumn("piece", F.array_join("pieces", ""))
        .withColumn("spans", _masked(F.col("pieces"), turns))
        .withColumn("n_chars", F.length("piece").cast("long"))
    )
    earlier = W.partitionBy("conversation").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("offset", F.coalesce(F.sum("n_chars").over(earlier), F.lit(0)))
    whole = runs.groupBy("conversation").agg(
        F.sort_array(F.collect_list(F.struct("run", "offset", "piece", "spans", "turns"))).alias(
            "runs"
        )
    )
    formatted = F.array_join(F.transform("runs", lambda r: r["piece"]), "")
    spans = F.flatten(
        F.transform(
            "runs",
            lambda r: F.transform(
                r["spans"],
                lambda s: F.struct(
                    (s["start"] + r["offset"]).alias("start"),
                    s["length"].cast("long").alias("length"),
                ),
            ),
        )
    )
    source = F.flatten(F.transform("runs", lambda r: r["turns"]))
    whole = whole.withColumn("formatted", formatted).withColumn(
        "formatted",
        F.when(parse(F.col("formatted")).eqNullSafe(source), F.col("formatted")).otherwise(
            F.raise_error(F.lit("a conversation does not read back as it was")).cast("string")
        ),
    )
    pieces = F.transform("runs", lambda r: F.struct(r["piece"], r["spans"]))
    return whole.select(
        F.col("conversation").alias(conversation),
        "formatted",
        spans.alias("loss_spans"),
        pieces.alias("runs"),
    )


def trained_text(runs: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.flatten(
            F.transform(
                runs,
                lambda r: F.transform(
                    r["spans"], lambda s: unescape(F.substring(r["piece"], s["start"], s["length"]))
                ),
            )
        ),
        "",
    )
