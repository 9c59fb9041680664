"""Chat formatting: role automaton, declarative template, text segments with loss flags.

Only DataFrame functions are used.  Turns are put together in two steps: blocks of
`BLOCK` consecutive turn numbers first, then the blocks of a conversation, so the rows of
a very long conversation are gathered by many tasks and the last step sees few rows.

Control strings inside texts are escaped as in markup: `&` becomes `&amp;`, `<|` becomes
`&lt;|`, and in role names a line break becomes `&#10;`.  So the marks of the template
occur in the output only where the template put them, and the output can be read back.

Defined results: null text is empty, null role is the empty name; turns of one
conversation with equal numbers are ordered by role and text, a null number comes first;
turns with a null conversation form one conversation.  Conversations that break the role
order are formatted all the same, with `valid` false.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 64


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles carry loss, and which role may follow which."""

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> roles that may come next; the role is the next state.
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant", "tool"),
    })
    ends: tuple[str, ...] = ("assistant", "user", "tool")


CHATML = Template()


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&#10;"), F.lit("\n")), F.lit("&lt;|"), F.lit("<|"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, segments (array of text and loss), formatted, roles, valid.

    `turns` needs conv_id, turn, role and text; other columns are ignored.
    """
    clean = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / BLOCK).alias("block"))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def segments(t: Column) -> Column:
        return F.array(
            part(F.concat(F.lit(template.open), _escape_role(t["role"]), F.lit(template.after_role)), F.lit(False)),
            part(escape(t["text"]), t["role"].isin(*template.loss_roles)),
            part(F.lit(template.close), F.lit(False)))

    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    blocks = clean.groupBy("conv_id", "block").agg(rows.alias("rows")).select(
        "conv_id", "block", F.flatten(F.transform("rows", segments)).alias("segments"), F.col("rows.role").alias("roles"))
    whole = blocks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "segments", "roles"))).alias("blocks")
    ).select("conv_id", F.flatten("blocks.segments").alias("segments"), F.flatten("blocks.roles").alias("roles"))

    moves = F.create_map(*[F.lit(x) for state, roles in template.follows.items() for r in roles for x in (f"{state}>{r}", r)])
    state = F.aggregate("roles", F.lit("start"), lambda s, r: F.coalesce(moves[F.concat(s, F.lit(">"), r)], F.lit("error")))
    return whole.select(
        "conv_id", "segments", F.array_join("segments.text", "").alias("formatted"), "roles",
        state.isin(*template.ends).alias("valid"))


def read_back(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, turns (array of role and text) and the text under the loss mask, from the output alone."""
    pieces = F.split("formatted", _literal(template.open))
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))

    def turn(p: Column) -> Column:
        cut = F.instr(p, F.lit(template.after_role))
        body = F.substring(p, cut + len(template.after_role), F.length(p) - cut - (len(template.after_role) - 1) - len(template.close))
        return F.struct(unescape(F.substring(p, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    under_loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.select(
        "conv_id", F.transform(pieces, turn).alias("turns"), F.array_join(under_loss, "").alias("loss_text"),
        "formatted", "valid")


def _literal(mark: str) -> str:
    return "\\Q" + mark + "\\E"
