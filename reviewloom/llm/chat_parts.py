"""Chat formatting of typed content parts, from DataFrame functions only.

A turn's content is a list of parts: text, image, audio or document. The visitor
turns each into its own form in order: text is escaped, every other part becomes a
placeholder, and its reference and its number of tokens are recorded. Between
control strings no raw angle or square bracket can stand, so that reading a
formatted conversation back needs nothing but the brackets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,text:string,reference:string,tokens:bigint>>"

BEGIN, END = "<s>", "</s>"
# A user's turn is asked, an assistant's is answered; any other role is named.
OPEN = {"user": "[INST]", "assistant": "[ANSW]"}
CLOSE = {"user": "[/INST]", "assistant": "[/ANSW]"}
NAMED, NAMED_END, NAMED_CLOSE = "[ROLE ", "]", "[/ROLE]"
PLACEHOLDERS = ("image", "audio", "document")
# Tokens of a part that tells none.
DEFAULT_TOKENS = {"image": 256, "audio": 128, "document": 512}
# What stands for the characters that control strings are made of.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("[", "\\o"), ("]", "\\c"))


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def text_parts(text: Column) -> Column:
    """A content of one text part; null is the empty text."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("reference"),
            F.lit(None).cast("bigint").alias("tokens"),
        )
    )


def _tokens(part: Column) -> Column:
    given = part["tokens"]
    for kind, tokens in DEFAULT_TOKENS.items():
        given = F.coalesce(given, F.when(part["kind"] == kind, F.lit(tokens)))
    return F.greatest(given, F.lit(0)).cast("bigint")


def visit(parts: Column) -> Column:
    """The visible form of parts, in order; a part of an unknown kind shows its text."""

    def form(part: Column) -> Column:
        tag = F.concat(F.lit("<"), part["kind"], F.lit(">"))
        return F.when(part["kind"].isin(*PLACEHOLDERS), tag).otherwise(
            escape(F.coalesce(part["text"], F.lit("")))
        )

    return F.array_join(F.transform(parts, form), "")


def attachments(parts: Column) -> Column:
    """Kind, reference and expanded tokens of every part with a placeholder, in order."""
    placed = F.filter(parts, lambda part: part["kind"].isin(*PLACEHOLDERS))
    return F.transform(
        placed,
        lambda part: F.struct(
            part["kind"].alias("kind"),
            part["reference"].alias("reference"),
            _tokens(part).alias("tokens"),
        ),
    )


def _marks(role: Column) -> tuple[Column, Column]:
    """What stands before and behind the body of a turn."""
    opened = F.concat(F.lit(NAMED), escape(role), F.lit(NAMED_END))
    closed = F.lit(NAMED_CLOSE)
    for known in OPEN:
        opened = F.when(role == known, F.lit(OPEN[known])).otherwise(opened)
        closed = F.when(role == known, F.lit(CLOSE[known])).otherwise(closed)
    return opened, closed


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments and
    expanded_tokens.

    ``turns`` has conv_id, turn, role and content (``PARTS``). Turns stand by turn,
    then role, then content; null turns come first, equal rows are all kept. A null
    role is the empty one, null content has no parts. ``loss_spans`` are the start
    (from 0) and length, in characters, of every assistant's body. A conversation is
    one value and is gathered as such. Other columns are not read; no rows give none.
    """
    parts = F.coalesce(F.col("content"), F.array().cast(PARTS))
    visited = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        visit(parts).alias("body"),
        attachments(parts).alias("attached"),
    )
    opened, closed = _marks(F.col("role"))
    marked = visited.withColumn("head", F.char_length(opened)).withColumn(
        "marked", F.concat(opened, "body", closed)
    )
    # Where each turn starts: the running length of those before it, over sorted rows that
    # can spill. No turn is empty, so that these places are an order, too.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", "attached")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.char_length("marked").cast("bigint")).over(before), F.lit(0))
    placed = marked.select(
        "conv_id",
        F.struct(
            (at + len(BEGIN)).alias("at"),
            "marked",
            F.col("head").cast("bigint").alias("head"),
            F.char_length("body").cast("bigint").alias("length"),
            (F.col("role") == "assistant").alias("answer"),
            "attached",
        ).alias("placed"),
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("placed")).alias("turns"))
    body = F.array_join(F.transform("turns", lambda t: t["marked"]), "")
    spans = F.transform(
        F.filter("turns", lambda t: t["answer"]),
        lambda t: F.struct((t["at"] + t["head"]).alias("start"), t["length"].alias("length")),
    )
    listed = gathered.select(
        "conv_id",
        F.concat(F.lit(BEGIN), body, F.lit(END)).alias("formatted"),
        spans.alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"])
    return listed.withColumn("expanded_tokens", total)


def read_bodies(formatted: Column) -> Column:
    """Role and visible parts (body) of every turn of a formatted conversation, in order."""
    inner = F.substring(
        formatted, len(BEGIN) + 1, F.char_length(formatted) - len(BEGIN) - len(END)
    )
    # Every turn ends in a control string that starts with [/, which no text contains.
    pieces = F.filter(F.split(inner, r"\[/[A-Z]+\]"), lambda piece: piece != "")

    def read(piece: Column) -> Column:
        tag = F.substring_index(piece, "]", 1)
        role = unescape(F.substr(tag, F.lit(len(NAMED) + 1)))
        for known, opening in OPEN.items():
            role = F.when(tag == opening[:-1], F.lit(known)).otherwise(role)
        return F.struct(
            role.alias("role"),
            F.substr(piece, F.char_length(tag) + 2).alias("body"),
        )

    return F.transform(pieces, read)


def read_turns(formatted: Column) -> Column:
    """Role and text of every turn, in order; placeholders stay in the text as they are,
    where ``read_parts`` of a body tells them from text that looks like them."""
    return F.transform(
        read_bodies(formatted),
        lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text")),
    )


def read_parts(body: Column) -> Column:
    """Kind and text of every part in the visible form of parts, in order. Texts that stood
    side by side are one, empty ones are none; placeholders have no text, and the n-th of a
    conversation belongs to its n-th attachment."""
    # Raw angle brackets stand around placeholders only.
    pieces = F.filter(F.split(body, "(?=<)|(?<=>)"), lambda piece: piece != "")

    def read(piece: Column) -> Column:
        kind = F.substr(piece, F.lit(2), F.char_length(piece) - 2)
        placed = piece.startswith("<")
        return F.struct(
            F.when(placed, kind).otherwise("text").alias("kind"),
            F.when(~placed, unescape(piece)).alias("text"),
        )

    return F.transform(pieces, read)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order with nothing between.

    Characters are found by their number: four bytes each, so that a span costs its own
    length only. A conversation has at most 2^29 of them.
    """

    def under(wide: Column) -> Column:
        def read(span: Column) -> Column:
            start, length = (4 * span[x] for x in ("start", "length"))
            part = F.substr(wide, (start + 1).cast("int"), length.cast("int"))
            return unescape(F.decode(part, "UTF-32"))

        return F.array_join(F.transform(spans, read), "")

    # An array of one, so that the wide form is made once and not for every span.
    return F.get(F.transform(F.array(F.encode(formatted, "UTF-32")), under), F.lit(0))
