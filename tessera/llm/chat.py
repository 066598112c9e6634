"""Chat formatting by a finite-state machine over roles and a declarative template.

Built from DataFrame functions only.  A conversation is one output row, as its
digest is taken over the whole of it: a conversation has to fit a row.

Defined results
---------------
* rows are ordered by (turn, role, text), a null turn first; repeated rows are turns of their own;
* a null role or text counts as empty; a null ``conv_id`` is one conversation;
* an order that the machine does not accept is still formatted: ``valid`` is false and
  ``bad_turn`` is the index (from 0) of the first turn it rejects, or the number of turns if it ends too early;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is ``opening + role + divider + text + closing``.

    ``\\`` escapes inside texts: it is doubled, and each character that starts a control string becomes
    ``\\`` and a letter of its own.  So no escaped text holds even the first character of a control string.
    """

    opening: str = "### "
    divider: str = ":\n"
    closing: str = " </turn>\n"
    controls: tuple[str, ...] = ("</turn>", "##")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    #: The machine: (state, role) pairs it accepts; the state after a turn is its role.
    accepts: tuple[tuple[str, str], ...] = field(
        default=(("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"))
    )
    ends: tuple[str, ...] = ("assistant",)


DEFAULT = ChatTemplate()


def _letters(template: ChatTemplate) -> dict[str, str]:
    """The escape of each character that starts a control string, in order; the divider's comes last, for roles."""
    starts = [*dict.fromkeys(c[0] for c in template.controls), template.divider[0]]
    return {ch: f"\\{chr(ord('a') + i)}" for i, ch in enumerate(dict.fromkeys(starts))}


def escape(text: Column, template: ChatTemplate = DEFAULT, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for ch, said in _letters(template).items():
        if role or ch in {c[0] for c in template.controls}:
            out = F.replace(out, F.lit(ch), F.lit(said))
    return out


def unescape(text: Column, template: ChatTemplate = DEFAULT) -> Column:
    """Pairs of ``\\`` are found from the left, and between them each escape stands for its character."""

    def plain(x: Column) -> Column:
        for ch, said in _letters(template).items():
            x = F.replace(x, F.lit(said), F.lit(ch))
        return x

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def format_chats(rows: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, formatted, seg_chars, seg_loss, valid, bad_turn.

    ``seg_chars`` and ``seg_loss`` describe the text segments of ``formatted`` in
    order, three per turn (head, text, close): code points and loss flag.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(template.opening), escape(t["role"], template, role=True), F.lit(template.divider))
    parts = chats.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"]).alias("roles"),
        F.transform(
            "turns",
            lambda t: F.struct(
                head(t).alias("head"), escape(t["text"], template).alias("body"), t["role"].isin(*template.loss_roles).alias("loss")
            ),
        ).alias("parts"),
    )
    # State after i turns is the role of turn i, so each step of the machine looks at two neighbours.
    steps = F.array(*(F.lit(f"{a}\x1f{b}") for a, b in template.accepts))
    state = F.concat(F.array(F.lit(template.start)), F.col("roles"))
    tried = F.zip_with(F.slice(state, 1, F.size("roles")), F.col("roles"), lambda a, b: F.concat(a, F.lit("\x1f"), b))
    refused = F.array_position(F.transform(tried, lambda x: F.array_contains(steps, x)), False) - 1
    last = F.element_at(state, -1)
    bad = F.when(refused >= 0, refused).when(~last.isin(*template.ends), F.size("roles").cast("long"))
    nil = F.lit(0)
    return parts.select(
        "conv_id",
        F.array_join(
            F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(template.closing))), ""
        ).alias("formatted"),
        F.flatten(
            F.transform("parts", lambda p: F.array(F.length(p["head"]), F.length(p["body"]), nil + len(template.closing)))
        ).alias("seg_chars"),
        F.flatten(F.transform("parts", lambda p: F.array(F.lit(False), p["loss"], F.lit(False)))).alias("seg_loss"),
        bad.isNull().alias("valid"),
        bad.alias("bad_turn"),
    )


def segments(formatted: DataFrame) -> DataFrame:
    """One row per text segment: conv_id, segment (from 0), start, chars, loss."""
    each = formatted.select(
        "conv_id", F.posexplode(F.arrays_zip("seg_chars", "seg_loss")).alias("segment", "s")
    )
    return each.select("conv_id", "segment", F.col("s.seg_chars").alias("chars"), F.col("s.seg_loss").alias("loss"))


def read_chats(formatted: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """Reads ``format_chats`` output back: conv_id, turns (array of role, text, loss)."""
    raw = F.split("formatted", f"\\Q{template.closing}\\E", -1)
    raw = F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(0)))
    opened, divided = len(template.opening), len(template.divider)

    def turn(x: Column, i: Column) -> Column:
        head = F.get("seg_chars", i * 3)
        role = F.substr(x, F.lit(opened + 1), head - opened - divided)
        body = F.substr(x, head + 1, F.get("seg_chars", i * 3 + 1))
        return F.struct(
            unescape(role, template).alias("role"), unescape(body, template).alias("text"), F.get("seg_loss", i * 3 + 1).alias("loss")
        )

    return formatted.select("*", F.transform(raw, turn).alias("turns"))


def chat_digests(formatted: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """The figures of the contract, taken from what ``read_chats`` finds in the formatted text."""
    back = read_chats(formatted, template)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.withColumn(
        "lossy", F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("lossy").cast("long").alias("loss_chars"),
        F.sha2("lossy", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


#: What the contract adds to the table: both turns of conversation -7 say this.
PROBE = r"\### Assistant: </turn> ok"


def query(spark, sf_dir):
    from tessera.llm.common import table

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat_digests(format_chats(rows.unionByName(probe)))


SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as before,
    lead(role) over (partition by conv_id order by turn nulls first, role, text) as after,
    length(replace(replace(replace(text, '\', '\\'), '<', '\a'), '#', '\b')) + length(replace(replace(replace(replace(role, '\', '\\'), '<', '\a'), '#', '\b'), ':', '\c')) + 15 as chars
  from t)
select conv_id, count(*)::BIGINT as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::BIGINT as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::BIGINT as formatted_chars,
  bool_and(coalesce(before, 'start') || '>' || role in
    ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')
    and (after is not null or role = 'assistant')) as valid
from e group by conv_id
"""
