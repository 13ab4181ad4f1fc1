"""Chat formatting: typed parts flattened into one string per conversation, and back.

All of it is DataFrame functions.  Template, per turn::

    <|im_start|>ROLE\\nCONTENT<|im_end|>\\n

``\\`` in a role or text is doubled, then ``<|`` becomes ``<\\|`` (and a line feed in
a role ``<\\/``), so a text can hold no marker and everything can be read back.  A ``<``
that ends a part with more parts after it becomes ``<\\.``, so neither do parts joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TEXT = "text"

#: Tokens an attachment expands to: so many for so many units, rounded up.  Units are
#: pixels of an image, milliseconds of audio and pages of a document.
EXPANSION = {"image": (1, 784), "audio": (1, 40), "document": (512, 1)}

PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
ATTACHMENTS = "array<struct<part:int,kind:string,ref:string,tokens:bigint,at:bigint>>"
SPANS = "array<struct<at:bigint,length:bigint>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    marks = F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("<\\."), F.lit("<"))
    return F.replace(marks, F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\/"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\/"), F.lit("\n")))


def _attachment_kind(part: Column) -> Column:
    return part["kind"].isin(list(EXPANSION))


def _tokens(part: Column) -> Column:
    units = F.greatest(F.coalesce(part["units"], F.lit(0)), F.lit(0))
    count = F.lit(0).cast("bigint")
    for kind, (tokens, per) in EXPANSION.items():
        count = F.when(part["kind"] == kind, F.ceil(units * tokens / per)).otherwise(count)
    return count


def _visit(part: Column, last: Column) -> Column:
    """What a part becomes in the string: a placeholder, or its escaped text."""
    marker = F.concat(F.lit("<|"), part["kind"], F.lit("|>"))
    text = escape(F.coalesce(part["text"], F.lit("")))
    text = F.when(F.endswith(text, F.lit("<")) & ~last, F.concat(text, F.lit("\\."))).otherwise(text)
    return F.when(_attachment_kind(part), marker).otherwise(text)


def _visited(parts: Column) -> Column:
    """What each part becomes; whether one is the last tells if a ``<`` at its end is left open."""
    return F.transform(parts, lambda part, i: _visit(part, i + 1 == F.size(parts)))


def _placed(parts: Column, visited: Column) -> Column:
    """Each part with the place and length of what it becomes in the turn's content."""
    empty = F.array().cast("array<struct<part:int,kind:string,ref:string,tokens:bigint,at:bigint,length:bigint>>")
    sized = F.zip_with(
        parts,
        visited,
        lambda part, string: F.struct(part.alias("part"), F.length(string).cast("bigint").alias("length")),
    )

    def add(state: Column, one: Column) -> Column:
        part, size = one["part"], one["length"]
        one = F.struct(
            F.size(state["done"]).alias("part"),
            part["kind"].alias("kind"),
            part["ref"].alias("ref"),
            _tokens(part).cast("bigint").alias("tokens"),
            state["at"].alias("at"),
            size.alias("length"),
        )
        return F.struct((state["at"] + size).alias("at"), F.array_append(state["done"], one).alias("done"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("done"))
    return F.aggregate(sized, start, add, lambda state: state["done"])


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    parts_col: str | None = None,
    learn_role: str = "assistant",
) -> DataFrame:
    """One row per conversation.

    Returns ``conv_id, formatted, n_turns, loss_spans, attachments, expanded_tokens``.
    ``loss_spans`` holds the text of ``learn_role`` as ``(turn, at, start, length)`` in
    code points: ``at`` in the turn's own string, ``start`` in ``formatted``.
    ``attachments`` holds ``(turn, part, kind, ref, tokens, start)`` in order.

    ``parts_col`` names typed parts (see ``PARTS``); where it is null or not given,
    ``text_col`` is the one text part.  Parts of other kinds count as text.  Null
    roles and texts are empty.  Rows are taken by turn (null first), then role, then
    text, so ties and repeated rows have one order.  Rows with a null id form one
    conversation.  Other columns are not read.  One window per conversation finds the
    places; its sort is by conversation, and a conversation ends as one string.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        text.alias("text"),
        (F.col(f"`{parts_col}`").cast(PARTS) if parts_col else F.lit(None).cast(PARTS)).alias("parts"),
    )
    learned = F.col("role") == learn_role
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    one_text = F.array(
        F.struct(
            F.lit(TEXT).alias("kind"),
            F.col("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("bigint").alias("units"),
        )
    ).cast(PARTS)
    placed = F.col("placed")
    shaped = (
        base.withColumn("parts", F.coalesce("parts", one_text))
        .withColumn("visited", _visited(F.col("parts")))
        .withColumn("content", F.array_join("visited", ""))
        .withColumn("placed", _placed(F.col("parts"), F.col("visited")))
        .withColumn(
            "files",
            F.transform(
                F.filter(placed, _attachment_kind),
                lambda p: F.struct(p["part"], p["kind"], p["ref"], p["tokens"], p["at"]),
            ).cast(ATTACHMENTS),
        )
        .withColumn(
            "learn",
            F.transform(
                F.filter(placed, lambda p: ~F.coalesce(_attachment_kind(p), F.lit(False))),
                lambda p: F.struct(p["at"], p["length"]),
            ).cast(SPANS),
        )
    )
    shaped = (
        shaped.withColumn("learn", F.when(learned, F.col("learn")).otherwise(F.array().cast(SPANS)))
        .withColumn("head", F.length(head).cast("bigint"))
        .withColumn("piece", F.concat(head, F.col("content"), F.lit(END)))
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "piece")
    before = F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = shaped.select(
        "conv_id",
        F.row_number().over(order).alias("ord"),
        F.coalesce(before, F.lit(0)).cast("bigint").alias("begin"),
        "piece",
        "head",
        "learn",
        "files",
    )
    spans = F.transform(
        "learn",
        lambda s: F.struct(
            F.col("ord").alias("turn"),
            (F.col("head") + s["at"]).alias("at"),
            (F.col("begin") + F.col("head") + s["at"]).alias("start"),
            s["length"].alias("length"),
        ),
    )
    files = F.transform(
        "files",
        lambda a: F.struct(
            F.col("ord").alias("turn"),
            a["part"].alias("part"),
            a["kind"].alias("kind"),
            a["ref"].alias("ref"),
            a["tokens"].alias("tokens"),
            (F.col("begin") + F.col("head") + a["at"]).alias("start"),
        ),
    )
    gathered = rows.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("ord", "piece", spans.alias("spans"), files.alias("files")))
        ).alias("turns")
    )
    attached = F.flatten(F.transform("turns", lambda t: t["files"]))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.flatten(F.transform("turns", lambda t: t["spans"])).alias("loss_spans"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """Read roles, texts and learned text back from the strings.

    Adds ``turns`` (``role, text`` in order; placeholders of attachments stay in the
    text as they are written) and ``loss_text``, the text under the mask, unescaped.
    """
    pieces = F.split("formatted", END.replace("|", r"\|"), -1)
    cut = formatted.withColumn("_pieces", F.slice(pieces, 1, F.size(pieces) - 1))

    def read(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = unescape_role(F.substr(head, F.lit(len(START) + 1)))
        text = unescape(F.substr(piece, F.length(head) + 2))
        return F.struct(role.alias("role"), text.alias("text"))

    def learned(span: Column) -> Column:
        piece = F.element_at(F.col("_pieces"), span["turn"])
        return unescape(F.substr(piece, (span["at"] + 1).cast("int"), span["length"].cast("int")))

    return (
        cut.withColumn("turns", F.transform("_pieces", read))
        .withColumn("loss_text", F.array_join(F.transform("loss_spans", learned), ""))
        .drop("_pieces")
    )
