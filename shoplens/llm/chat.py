"""Chat formatting: typed content parts flattened to ordered placeholders in one training text.

A turn has a role and a list of typed parts. A visitor, one method for each kind, renders every part
as text or as a placeholder, and records the attachment it stands for and how many tokens it will
expand to. The formatted conversation is ::

    <|im_start|>role
    text of the turn<|im_end|>

for each turn, in order. Control strings inside roles and texts are escaped by a backslash after their
first character (and one more where backslashes already follow it), which reading back takes away.
Everything is a column expression; turns are rendered before they are gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.tables import pick

# The template's marks and the control strings that texts must not contain as such.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = [
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|image|>", "<|audio|>", "<|document|>", "<|unknown|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
]
# Tokens that an attachment expands to: an image one per patch, audio per second, a document per page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 512

PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("width", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("pages", T.LongType()),
    ]
)


def _quote(text: str) -> str:
    return "".join(f"\\{c}" if c in r"\.[]{}()<>*+-=!?^$|/" else c for c in text)


# First character, backslashes, rest: the rest holds neither "<" nor "[" first, so matches cannot overlap,
# save "<<SYS>>" and "<</SYS>>", whose rest starts with "<" and of which the whole is one match.
_RESTS = sorted({c[1:] for c in CONTROL}, key=lambda c: (-len(c), c))
_ESCAPABLE = rf"([<\[])(\\*)({'|'.join(map(_quote, _RESTS))})"
_ESCAPED = rf"([<\[])\\(\\*)({'|'.join(map(_quote, _RESTS))})"


def escape(text: Column) -> Column:
    """Text without control strings, from which ``unescape`` makes the same text again."""
    return F.regexp_replace(text, _ESCAPABLE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """As ``escape``, on one line: the role ends where its line ends."""
    one_line = F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(one_line)


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


class PartVisitor:
    """Renders one part: its text, its tokens and whether it is an attachment. Subclass to change a kind."""

    def text(self, part: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(part["text"], F.lit(""))), F.lit(0)

    def image(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|image|>"), self._patches(part["width"]) * self._patches(part["height"])

    def audio(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|audio|>"), F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE)

    def document(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|document|>"), F.greatest(F.lit(1), F.coalesce(part["pages"], F.lit(1))) * PAGE_TOKENS

    def other(self, part: Column) -> tuple[Column, Column]:
        return F.lit("<|unknown|>"), F.lit(1)

    @staticmethod
    def _patches(side: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.coalesce(side, F.lit(PATCH)) / PATCH))

    def visit(self, part: Column) -> Column:
        """struct(kind, shown, tokens, ref) of a part; a part without type is a text."""
        kind = F.coalesce(part["type"], F.lit("text"))
        known = ["text", "image", "audio", "document"]
        seen = {name: getattr(self, name)(part) for name in known}
        other = self.other(part)

        def chosen(i: int) -> Column:
            return reduce(lambda rest, name: F.when(kind == name, seen[name][i]).otherwise(rest), known, other[i])

        return F.struct(
            kind.alias("kind"), chosen(0).alias("shown"), chosen(1).cast("long").alias("tokens"), part["ref"].alias("ref")
        )


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    values = {"type": F.lit("text"), "text": text}
    return F.array(F.struct(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PART.fields)))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content",
    loss_role: str = "assistant", visitor: PartVisitor | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, n_turns.

    content is an array of parts as ``PART``. loss_spans are [start, end) in code points of ``formatted``, one per
    turn of ``loss_role``, around its rendered content. attachments hold, in reading order, kind, ref, tokens and
    the offset of their placeholder in the conversation.

    Turns are ordered by turn (null first), then role, then rendered content. Null content is an empty turn, a null
    role an empty one, a null part an empty text; rows without conversation form one conversation with a null id.
    Repeated rows are turns of their own. An empty table gives no rows.
    """
    visitor = visitor or PartVisitor()
    rows = pick(turns, conv=conv, turn=turn, role=role, content=content)
    parts = F.transform(F.coalesce(F.col("content"), F.array().cast(T.ArrayType(PART))), visitor.visit)
    rendered = rows.withColumn("parts", parts).select(
        "conv", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join(F.col("parts")["shown"], "").alias("body"),
        # Attachments with their offset in the body: the length of what is shown before them.
        F.filter(
            F.transform(
                F.col("parts"),
                lambda p, i: F.struct(
                    p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"),
                    F.length(F.array_join(F.slice(F.col("parts")["shown"], F.lit(1), i), "")).cast("long").alias("at"),
                ),
            ),
            lambda p: p["kind"] != "text",
        ).alias("files"),
    )
    turn_ = F.struct("turn", "role", "body", "head", "files")
    # A conversation is one training text, so its turns do meet in one row; they come rendered and only once.
    gathered = rendered.groupBy("conv").agg(F.sort_array(F.collect_list(turn_)).alias("turns"))
    sizes = F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END))
    # Running offsets: one pass that appends the next start to the starts so far.
    starts = F.aggregate(
        "sizes", F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    )
    placed = gathered.withColumn("sizes", sizes).withColumn("starts", starts)
    at = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["role"].alias("role"),
            (F.get("starts", i) + F.length(t["head"])).alias("start"),
            (F.get("starts", i) + F.length(t["head"]) + F.length(t["body"])).alias("end"),
            t["files"].alias("files"),
        ),
    )
    return placed.withColumn("at", at).select(
        F.col("conv").alias("conv_id"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform(
            F.filter("at", lambda t: t["role"] == loss_role), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
        ).alias("loss_spans"),
        F.flatten(
            F.transform(
                "at",
                lambda t: F.transform(
                    t["files"],
                    lambda f: F.struct(f["kind"].alias("kind"), f["ref"].alias("ref"), f["tokens"].alias("tokens"), (t["start"] + f["at"]).alias("at")),
                ),
            )
        ).alias("attachments"),
        F.size("turns").cast("long").alias("n_turns"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text), as they were before."""
    pieces = F.split(formatted, _quote(END[:-1]) + "\n")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)  # what follows the last mark is empty

    def read(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(role) + 2, F.length(piece))
        return F.struct(unescape_role(F.substring(role, F.lit(len(START) + 1), F.length(role))).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, read)


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The texts under a loss mask, as they were before formatting."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
