"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only.

``segments`` gives one row per conversation with the text segments in order, a loss flag for each, the whole formatted
text, and the verdict of the state machine. ``read_back`` parses a formatted text into turns again.

Control marks inside texts are escaped by one more backslash between ``<`` and ``|``, and restored by taking one away,
so ``<|`` occurs in the output as a mark only. Roles are written on one line (``%`` and line feeds as ``%25``, ``%0A``).

Results: rows go by turn, then role, then text (ties and repeated rows all stay); null text or role is empty; a null
conversation id is a conversation of its own. A conversation whose roles the machine rejects is formatted all the same, with
``valid`` false and the position of the first bad turn. Extra columns are ignored. One conversation makes one row, since
its text is one training sample.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around each turn, roles whose text is trained on, and the role order as a state machine."""

    open: str = "<|im_start|>"
    head_end: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Role before (empty: start) to the roles that may follow.
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    accept: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if not self.open.startswith("<|") or not self.close.startswith("<|") or self.head_end != "\n":
            raise ValueError("marks start with <| and the role ends with a line feed")


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _turns(conversations: DataFrame) -> DataFrame:
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, valid, bad_turn (0-based or null), segments (text, loss), formatted."""
    moves = F.array(*[F.lit(f"{a}\n{b}") for a, to in template.follows.items() for b in to])

    def three(t: Column) -> Column:
        head = F.concat(F.lit(template.open), _role_out(t.role), F.lit(template.head_end))
        loss = t.role.isin(*template.loss_roles)
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")), F.struct(escape(t.text).alias("text"), loss.alias("loss")), F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss"))
        )

    roles = F.transform("turns", lambda t: t.role)
    step = F.transform("roles", lambda r, i: F.array_contains(moves, F.concat(F.when(i == 0, F.lit("")).otherwise(F.element_at("roles", F.greatest(i, F.lit(1)))), F.lit("\n"), r)))
    bad = F.array_position(step, False)
    return (
        _turns(conversations)
        .withColumn("roles", roles)
        .withColumn("bad", bad)
        .select(
            "conv_id",
            ((F.col("bad") == 0) & F.element_at("roles", -1).isin(*template.accept)).alias("valid"),
            F.when(F.col("bad") > 0, F.col("bad") - 1).alias("bad_turn"),
            F.flatten(F.transform("turns", three)).alias("segments"),
        )
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s.text), ""))
    )


def read_back(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) that a formatted text holds."""
    pieces = F.split(formatted, r"\Q" + template.open + r"\E")
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, template.head_end, 1)
        start = F.char_length(role) + 2
        return F.struct(_role_in(role).alias("role"), unescape(F.substring(p, start, F.char_length(p) - start + 1 - len(template.close))).alias("text"))

    return F.transform(pieces, turn)


def loss_text(segs: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segs, lambda s: s.loss), lambda s: unescape(s.text)), "")


def format_digest(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation: figures and digests read back from the formatted text and its loss mask."""
    turns = F.array_join(F.transform(read_back(F.col("formatted"), template), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return (
        segments(conversations, template)
        .withColumn("loss_text", loss_text(F.col("segments")))
        .select(
            "conv_id",
            F.size(read_back(F.col("formatted"), template)).cast("long").alias("n_turns"),
            F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
            F.char_length("loss_text").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )
