"""Operator 3: chat formatting by a grammar round trip (native, no Python).

A conversation becomes one string, a frame per turn:

    system     [SYS] text [/SYS]
    user       [INST] text [/INST]
    assistant  <s> text </s>
    any other  [ROLE] role [TEXT] text [/ROLE]

The parser is deterministic: frames follow one another without gaps, and no
text may hold a control string that lacks a backslash before it.  Every turn
is first rendered as it is and reparsed; where role or text come back changed
(or the parse fails) the turn's control strings are escaped (one backslash
more before a control string and the backslashes that lead to it) and it is
rendered again.  The whole string is then reparsed and compared with the
source; a conversation that still differs stops the job, so nothing is ever
returned that does not read back.

Defined results: null text and null role count as empty; turns are ordered by
(turn, role, text) with null turns first, so repeated turn numbers and repeated
rows are all kept in a fixed order; rows with a null ``conv_id`` form one
conversation of that id; an empty table gives no rows; other columns are ignored.

One conversation is one output string, so its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template, as one pattern.
CONTROL = r"(?:</?s>|\[/?INST\]|\[/?SYS\]|\[/?ROLE\]|\[TEXT\])"
# Opening and closing string of the roles that have a frame of their own.
FRAMES = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
_FRAME = (
    r"(?s)\[SYS\] (.*?) \[/SYS\]|\[INST\] (.*?) \[/INST\]|<s> (.*?) </s>"
    r"|\[ROLE\] (.*?) \[TEXT\] (.*?) \[/ROLE\]"
)
_BARE = r"(?<!\\)" + CONTROL


def escape(text: Column) -> Column:
    """One backslash more before each control string (and the backslashes before it)."""
    return F.regexp_replace(text, r"(\\*" + CONTROL + ")", r"\\$1")


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: one backslash less before each control string."""
    return F.regexp_replace(text, r"\\(\\*" + CONTROL + ")", "$1")


def render_turn(role: Column, text: Column) -> Column:
    out = F.concat(F.lit("[ROLE] "), role, F.lit(" [TEXT] "), text, F.lit(" [/ROLE]"))
    for name, (start, end) in FRAMES.items():
        out = F.when(role == name, F.concat(F.lit(start), text, F.lit(end))).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns of a formatted string as array<struct<frame, role, raw, text, ok>>.

    ``frame`` is the turn's whole span, ``raw`` its text as written, ``text``
    as unescaped; ``ok`` is false where a control string stands bare in a text.
    """

    def turn(frame: Column) -> Column:
        group = lambda i: F.regexp_extract(frame, _FRAME, i)
        is_sys, is_user, is_bot = (frame.startswith(FRAMES[r][0]) for r in ("system", "user", "assistant"))
        raw_role = F.when(is_sys, "system").when(is_user, "user").when(is_bot, "assistant").otherwise(group(4))
        raw = F.when(is_sys, group(1)).when(is_user, group(2)).when(is_bot, group(3)).otherwise(group(5))
        return F.struct(
            frame.alias("frame"),
            unescape(raw_role).alias("role"),
            raw.alias("raw"),
            unescape(raw).alias("text"),
            (~raw.rlike(_BARE) & ~raw_role.rlike(_BARE)).alias("ok"),
        )

    return F.transform(F.regexp_extract_all(formatted, F.lit(_FRAME), F.lit(0)), turn)


def _reads_back(formatted: Column, parsed: Column, source: Column) -> Column:
    """True where ``parsed`` covers ``formatted`` and equals ``source`` turn by turn."""
    covered = F.aggregate(parsed, F.lit(0), lambda n, t: n + F.length(t["frame"]))
    got = F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return (covered == F.length(formatted)) & F.forall(parsed, lambda t: t["ok"]) & (got == source)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns`` and ``loss_spans``.

    ``turns`` is what the parser reads back from ``formatted``; ``loss_spans``
    are the (start, length) in code points, from 0, of the assistant texts in
    ``formatted``: the loss mask.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    plain = render_turn(F.col("role"), F.col("text"))
    source = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    rows = rows.withColumn("_plain", plain).withColumn("_parsed", parse(F.col("_plain")))
    rows = rows.withColumn("_same", _reads_back(F.col("_plain"), F.col("_parsed"), source)).drop("_parsed")
    rows = rows.withColumn(
        "frame",
        F.when(F.col("_same"), F.col("_plain")).otherwise(
            render_turn(
                F.when(F.col("role").isin(*FRAMES), F.col("role")).otherwise(escape(F.col("role"))),
                escape(F.col("text")),
            )
        ),
    )
    whole = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "frame"))).alias("_rows")
    )
    whole = whole.select(
        "conv_id",
        F.array_join(F.col("_rows.frame"), "").alias("formatted"),
        F.transform("_rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("_source"),
    ).withColumn("_parsed", parse(F.col("formatted")))
    checked = whole.withColumn(
        "turns",
        F.when(_reads_back(F.col("formatted"), F.col("_parsed"), F.col("_source")), F.col("_parsed")).otherwise(
            F.raise_error(F.concat(F.lit("conversation does not read back: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    opening = len(FRAMES["assistant"][0])

    def step(acc: Column, t: Column) -> Column:
        span = F.struct((acc["at"] + opening).alias("start"), F.length(t["raw"]).alias("length"))
        return F.struct(
            (acc["at"] + F.length(t["frame"])).alias("at"),
            F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return checked.select(
        "conv_id",
        "formatted",
        "turns",
        F.aggregate("turns", start, step)["spans"].alias("loss_spans"),
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digest columns of ``format_conversations``, all read back from ``formatted``."""
    turns = F.array_join(F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.array_join(
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), ""
    )
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"),
        F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
