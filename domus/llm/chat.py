"""Chat formatting: conversations as one training text each, with a loss mask and attachments.

A turn is ``<|turn|>`` role ``<|says|>`` content ``<|end|>`` and a line feed. Control strings begin
with ``<|``; in roles and texts every ``<`` that backslashes (or none) part from a ``|`` gets one
more backslash before that ``|``, so no text holds a control string and the step is undone by
taking one away. Other backslashes stay as they are.

Content is a text or an array of typed parts. A visitor (``Visitor``: one method for each kind of
part) turns each part into its rendered text and the number of tokens that it expands to;
attachments leave a placeholder, and the n-th placeholder of a conversation belongs to its n-th
attachment record. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domus.llm.common import free_name

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>\n"
#: Fields that a part may have; others are ignored, missing ones count as null.
PART_FIELDS = {"type": "string", "text": "string", "ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
TRAINED_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    """``text`` without control strings; null stays null."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


class Visitor:
    """How each kind of part is rendered: (text, tokens that a placeholder expands to).

    Images count their square patches (rounded up on each side), audio its frames, documents their
    pages. An unknown size counts as one patch, frame or page. Parts of other kinds, or of none, are
    attachments with a placeholder of no tokens."""

    patch, frames_per_second, tokens_per_page = 28, 25, 512
    KINDS = ("text", "image", "audio", "document")

    def text(self, part: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0).cast("long")

    def image(self, part: Column) -> tuple[Column, Column]:
        side = lambda c: F.ceil(F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) / self.patch)
        return F.lit("<|image|>"), (side(part["width"]) * side(part["height"])).cast("long")

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|audio|>"), F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.frames_per_second), F.lit(1)).cast("long")

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|document|>"), (F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * self.tokens_per_page).cast("long")

    def other(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|file|>"), F.lit(0).cast("long")

    def visit(self, part: Column) -> Column:
        """struct(kind, ref, rendered, tokens) of a part."""
        rendered, tokens = self.other(part)
        for kind in reversed(self.KINDS):
            r, t = getattr(self, kind)(part)
            rendered, tokens = F.when(part["type"] == kind, r).otherwise(rendered), F.when(part["type"] == kind, t).otherwise(tokens)
        kind = F.when(part["type"].isin(*self.KINDS), part["type"]).otherwise(F.lit("other"))
        return F.struct(kind.alias("kind"), part["ref"].alias("ref"), rendered.alias("rendered"), tokens.alias("tokens"))


def _parts(content: Column, kind: T.DataType) -> Column:
    """The content as an array of parts with all of ``PART_FIELDS``; null parts go."""
    if not isinstance(kind, T.ArrayType):
        alone = [F.lit("text") if f == "type" else content.cast("string") if f == "text" else F.lit(None).cast(t) for f, t in PART_FIELDS.items()]
        return F.array(F.struct(*[c.alias(f) for c, f in zip(alone, PART_FIELDS)]))
    has = set(kind.elementType.names)
    part = lambda p: F.struct(*[(p[f] if f in has else F.lit(None)).cast(t).alias(f) for f, t in PART_FIELDS.items()])
    return F.transform(F.filter(F.coalesce(content, F.array().cast(kind)), lambda p: p.isNotNull()), part)


def format_chats(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text",
                 visitor: Visitor | None = None, trained: tuple[str, ...] = TRAINED_ROLES) -> DataFrame:
    """One row for each conversation: its id, ``formatted``, ``n_turns``, ``turns`` (for each turn: begin,
    and loss_start and loss_end around the content of the trained roles, null for others),
    ``attachments`` (array of turn, start, kind, ref, tokens in order) and ``n_attachment_tokens``.
    Places are code points of ``formatted`` from 0, ends exclusive; turns count from 0.

    Turns are ordered by ``turn`` (nulls first); ties by role, then content, so reruns agree, and
    repeated rows are turns each. Null roles, texts and parts are empty. Rows without an id make one
    conversation. An empty table gives an empty result. A conversation is one value, whatever its
    number of turns, and so has to stay below 2 GB; its turns are laid out by a window that spills.
    Columns of other names are ignored."""
    kind = rows.schema[content].dataType
    seen = F.transform(_parts(F.col(content), kind), (visitor or Visitor()).visit)
    turns = rows.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), seen.alias("parts"))
    turns = turns.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)))
    turns = turns.withColumn("body", F.array_join(F.col("parts.rendered"), ""))
    ties = [F.to_json("parts")] if isinstance(kind, T.ArrayType) else []
    in_order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "body", *ties)
    chars = F.length("head") + F.length("body") + len(END)
    placed = turns.select("conv", "role", "parts", "head", "body", (F.row_number().over(in_order) - 1).alias("at"),
                          (F.sum(chars).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - chars).alias("begin"))
    start = F.col("begin") + F.length("head")
    inside = lambda i: F.aggregate(F.slice("parts.rendered", 1, i), F.lit(0).cast("long"), lambda n, r: n + F.length(r))
    held = F.filter(F.transform("parts", lambda p, i: F.struct(
        F.col("at").alias("turn"), (start + inside(i)).alias("start"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))), lambda p: p["kind"] != "text")
    learnt = F.col("role").isin(*trained)
    marks = F.struct("begin", F.when(learnt, start).alias("loss_start"), F.when(learnt, start + F.length("body")).alias("loss_end"))
    laid = placed.select("conv", "at", F.concat("head", "body", F.lit(END)).alias("piece"), marks.alias("marks"), held.alias("held"))
    out = laid.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", "piece", "marks", "held"))).alias("t"))
    files = F.flatten("t.held")
    return out.select(
        F.col("conv").alias(conversation), F.array_join("t.piece", "").alias("formatted"), F.size("t").cast("long").alias("n_turns"), F.col("t.marks").alias("turns"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("n_attachment_tokens"))


def pieces(formatted: Column) -> Column:
    """The turns of a formatted text, markers of the end included."""
    return F.filter(F.split(formatted, r"<\|turn\|>"), lambda p, i: i > 0)


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted text; attachments stay placeholders."""
    return F.transform(pieces(formatted), lambda p: F.struct(
        unescape(F.substring_index(p, SAYS, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, SAYS, -1), END, 1)).alias("text")))


def masked_text(formatted: Column, turns: Column) -> Column:
    """What lies under the loss mask, unescaped and joined. Each span is cut out of its own turn, so
    the work is that of reading the text once."""
    cut = lambda p, t: F.substr(p, (t["loss_start"] - t["begin"] - len(TURN) + 1).cast("int"), (t["loss_end"] - t["loss_start"]).cast("int"))
    return F.array_join(F.zip_with(pieces(formatted), turns, lambda p, t: F.when(t["loss_start"].isNotNull(), unescape(cut(p, t)))), "")


def with_attachment_tokens(chats: DataFrame, name: str = "model_tokens_of_attachments") -> DataFrame:
    """``chats`` with the kinds of attachments and the tokens that each kind expands to (map)."""
    kinds = F.array_distinct("attachments.kind")
    total = lambda k: F.aggregate(F.filter("attachments", lambda a: a["kind"] == k), F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return chats.withColumn(free_name(chats, name), F.map_from_arrays(kinds, F.transform(kinds, total)))
