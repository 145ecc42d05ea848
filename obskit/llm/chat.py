"""Chat formatting with Spark expressions only.

A conversation becomes one string. Adjacent turns of one role form a block, blocks follow one another:

    [INST] user text[SEP]next user text [/INST]<s> assistant text </s>[SYS] system text [/SYS][ROLE=hex] other [/ROLE]

``hex`` is the role's UTF-8 bytes. A control string inside a text gets one more backslash after its first
character (``</s>`` to ``<\\/s>``), and reading takes one away, so any text survives, backslashes included.

Defined cases: a null text or role is empty; a null conversation id is a conversation of its own; turns sort by
(turn, role, text), a null turn last; repeated rows stay, as turns of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: What a control string is after its first character.
TAIL = r"(/?INST\]|/?SYS\]|SEP\]|/?s>|ROLE=[0-9A-F]*\]|/ROLE\])"
SEP = "[SEP]"
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("<s> ", " </s>")}
BLOCK = r"(?s)(\[INST\]|\[SYS\]|<s>|\[ROLE=[0-9A-F]*\]) (.*?) (\[/INST\]|\[/SYS\]|</s>|\[/ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])(\\*)" + TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])\\(\\*)" + TAIL, "$1$2$3")


def _mark(role: Column, k: int) -> Column:
    other = F.concat(F.lit("[ROLE="), F.hex(F.encode(role, "UTF-8")), F.lit("] ")) if k == 0 else F.lit(" [/ROLE]")
    out = other
    for name, marks in MARKS.items():
        out = F.when(role == name, marks[k]).otherwise(out)
    return out


def _blocks(turns: Column) -> Column:
    """array<struct<role, texts>>: runs of one role, found where the role differs from the turn before."""

    def cut(t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]))
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda p, k: F.struct(
                    F.get(t, p)["role"].alias("role"),
                    F.transform(F.slice(t, p + 1, F.coalesce(F.get(s, k + 1), F.size(t)) - p), lambda x: x["text"]).alias("texts"),
                ),
            ),
        )

    return let(turns, cut)


def _segment(loss: Column, text: Column) -> Column:
    return F.struct(loss.alias("loss"), text.alias("text"))


def _segments(blocks: Column, trained: str) -> Column:
    no = F.lit(False)

    def block(b: Column) -> Column:
        texts = F.transform(
            b["texts"],
            lambda x, j: F.when(j == 0, F.array(_segment(b["role"] == trained, escape(x)))).otherwise(
                F.array(_segment(no, F.lit(SEP)), _segment(b["role"] == trained, escape(x)))
            ),
        )
        return F.concat(F.array(_segment(no, _mark(b["role"], 0))), F.flatten(texts), F.array(_segment(no, _mark(b["role"], 1))))

    return F.flatten(F.transform(blocks, block))


def format_chats(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, segments array<struct<loss, text>>.

    The segments joined are ``formatted``; those with ``loss`` are the trained role's texts, one each.
    """
    rows = turns.select("conv_id", F.struct(F.isnull("turn").alias("last"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    marked = chats.select("conv_id", let(_blocks(F.col("turns")), lambda b: _segments(b, trained)).alias("segments"))
    return marked.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse_chat(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns, read back from a formatted conversation."""
    opens, bodies = F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(1)), F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(2))

    def role(mark: Column) -> Column:
        out = F.decode(F.unhex(F.regexp_extract(mark, "=([0-9A-F]*)", 1)), "UTF-8")
        for name, (first, _) in MARKS.items():
            out = F.when(mark == first.strip(), name).otherwise(out)
        return out

    return F.flatten(
        F.zip_with(
            opens,
            bodies,
            lambda o, b: let(role(o), lambda r: F.transform(F.split(b, r"\[SEP\]", -1), lambda x: F.struct(r.alias("role"), unescape(x).alias("text")))),
        )
    )


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
