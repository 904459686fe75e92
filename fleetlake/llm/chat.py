"""Chat formatting of typed content parts.

A message is a list of typed parts: text, image, audio or document. A visitor takes the parts
in order and flattens them into one text, in which each attachment is a placeholder; what a
placeholder stands for, and how many tokens it expands to, is recorded beside the text in the
order of the placeholders. Messages of a conversation are put between turn marks, and the
places of assistant text are listed as the loss mask.

Control strings begin with `<|`. In texts and roles, `<`, any backslashes and `|` in a row get
one more backslash after the `<`, so that no text holds `<|` and reading takes the backslash
away again. Everything is built from column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
ATTACHMENTS = ("image", "audio", "document")
PATCH = 28
AUDIO_TOKENS = 25
PAGE_TOKENS = 512

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
_MARK = "\x01"


def text_part(text: str) -> Column:
    """A message that is one text part; null text is empty."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(F.col(text), F.lit("")).alias("text"))).cast(_wide("text"))


def _wide(*names: str) -> str:
    fields = [f for f in PART.removeprefix("struct<").removesuffix(">").split(", ") if f.split(":")[0] in ("kind", *names)]
    return f"array<struct<{', '.join(fields)}>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit(LINE))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def _tokens(part: Column, patch: int, audio: int, page: int) -> Column:
    """Tokens an attachment expands to: patches of an image, seconds of audio, pages of a document; one at least."""
    across = F.ceil(F.coalesce(part["width"], F.lit(0)) / patch) * F.ceil(F.coalesce(part["height"], F.lit(0)) / patch)
    made = (
        F.when(part["kind"] == "image", across)
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * audio))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)).cast("long") * page)
    )
    return F.greatest(made, F.lit(1)).cast("long")


def flatten(content: Column) -> Column:
    """The parts of a message as one text, attachments as placeholders in order.

    Neighbouring text parts are joined before control strings are escaped, so that none can
    be put together from two of them. Until then an attachment is a mark of its own.
    """

    def visit(part: Column) -> Column:
        plain = F.replace(F.coalesce(part["text"], F.lit("")), F.lit(_MARK), F.lit(_MARK + "0"))
        return F.when(part["kind"] == "text", plain).otherwise(F.concat(F.lit(_MARK), F.substring(part["kind"], 1, 1)))

    made = escape(F.array_join(F.transform(content, visit), ""))
    for kind in ATTACHMENTS:
        made = F.replace(made, F.lit(_MARK + kind[0]), F.lit(f"<|{kind}|>"))
    return F.replace(made, F.lit(_MARK + "0"), F.lit(_MARK))


def format_chats(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "content",
    speaker: str = "assistant",
    patch: int = PATCH,
    audio: int = AUDIO_TOKENS,
    page: int = PAGE_TOKENS,
) -> DataFrame:
    """One row per conversation: its id, n_turns, formatted, loss, attachments.

    `content` holds an array of parts as in `PART`, of which fields that no part needs may be
    missing where all parts are text. `loss` lists (start, end) in bytes of the formatted text
    in UTF-8, one per message of `speaker`, in order; `attachments` lists (turn, kind, ref, tokens)
    in the order of their placeholders.

    Rows go by turn, equal turns by role and then by text, null ones first. A null role is
    empty; null content, null parts and null texts are empty; a part of an unknown kind is an
    error. Rows with a null id are one conversation. Repeated rows are turns of their own. Other
    columns are ignored; an empty table gives no rows. A formatted conversation is one value
    and has to fit in one, as does its result; lengths are summed over sorted rows, nothing
    is quadratic in its turns.
    """
    typed = dict(rows.select(F.col(content).alias("c")).dtypes)["c"]
    parts = F.filter(F.coalesce(F.col(content), F.array().cast(typed)), lambda p: p.isNotNull())
    known = F.forall(parts, lambda p: p["kind"].isin("text", *ATTACHMENTS))
    none = "array<struct<kind:string,ref:string,tokens:bigint>>"
    attached = F.array().cast(none)
    if "ref:" in typed:
        attached = F.transform(
            F.filter(parts, lambda p: p["kind"] != "text"),
            lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p, patch, audio, page).alias("tokens")),
        ).cast(none)
    said = rows.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.when(F.coalesce(known, F.lit(False)), flatten(parts)).otherwise(F.raise_error(F.lit("a part is of an unknown kind"))).alias("body"),
        attached.alias("attached"),
    )
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    placed = said.select(
        "conv_id",
        "turn",
        (F.col("role") == speaker).alias("masked"),
        "attached",
        F.concat(head, "body", F.lit(END + "\n")).alias("piece"),
        F.octet_length(head).cast("long").alias("before"),
        F.octet_length("body").cast("long").alias("size"),
        F.row_number().over(order).alias("nth"),
        (F.sum(F.octet_length(head) + F.octet_length("body") + len(END) + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))).alias("done"),
    )
    start = F.col("done") - len(END) - 1 - F.col("size")
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("nth", "piece", "masked", start.alias("start"), (start + F.col("size")).alias("end"), "turn", "attached"))
        ).alias("turns")
    )
    loss = F.transform(F.filter("turns", lambda t: t["masked"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return whole.select(
        F.col("conv_id").alias(conversation),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        loss.alias("loss"),
        F.flatten(
            F.transform(
                "turns",
                lambda t: F.transform(
                    t["attached"], lambda a: F.struct(t["turn"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))
                ),
            )
        ).alias("attachments"),
    )


def turns_of(formatted: str = "formatted") -> Column:
    """The turns of a formatted conversation as (role, text): read from it alone, unescaped; placeholders stay as they are."""
    pieces = F.split(F.col(formatted), START.replace("|", r"\|"))
    pieces = F.slice(pieces, F.lit(2), F.size(pieces) - 1)

    def read(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + F.lit(2), F.length(piece) - F.length(role) - F.lit(len(END) + 2))
        return F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, read)


def masked_text(formatted: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    raw = F.col(formatted).cast("binary")
    cut = F.transform(loss, lambda s: unescape(F.substring(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).cast("string")))
    return F.array_join(cut, "")
