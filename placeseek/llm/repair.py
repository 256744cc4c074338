"""Operator 12: conversation structure repair over a suffix-shared automaton.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles (system, user,
assistant).  Each row gets a symbol: its role's initial (``o`` for others), in upper
case if the text is cut short, or ``x`` if the row has to go (blank, or role and text
seen earlier).  The symbols of a conversation are its signature.

The cheapest edits that make a signature right (``K`` keep, ``R`` set the role, ``D``
delete, ``I`` insert an empty row) depend on the rows still to come and on the state of the grammar
alone.  So the distinct signatures of all conversations are shared from their ends: sorted by their
reversed text, each adds nodes for the rows before the suffix that it shares with its neighbour,
and every node works out once, for each grammar state, the cost to go and the first edits of the best
audit (fewest cost, then ASCII order).  Nodes of equal cost differences and
symbol are one entry of a register.  Audits are read off by following the nodes.

Spark deals the work: rows are range-partitioned by conversation and turn, so a conversation
with very many rows is spread over tasks that each write segments of the signature; counts are
sums over segments; signatures are range-partitioned by reversed text, so a task
holds the nodes of one signature at a time.  The repaired rows come from one stream per
task, sorted by conversation, in which an audit goes before its rows; what a task holds is the audit and
one batch.

Defined results: null roles and texts are one space, null turns come first, a null
conversation id is an id of its own; rows of equal turn are ordered by role and the SHA-256 of the
text; repeated rows are duplicates; rows may come in any order; texts may be of any length; roles
other than the three can be deleted or set, not kept; a conversation without rows has no
edits; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeseek.llm.common import map_arrow, slices, stored
from placeseek.session import fits_for_broadcast

#: Symbols of one segment of a signature, and rows of a slice.
SEGMENT = 1 << 16
ROWS_AT_ONCE = 2048
# Blanks, closing marks, and the costs of the contract.
BLANKS = " \t\n\x0b\f\r"
CLOSING = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States of the grammar (nothing yet, then the initial read last), and the state
# that an inserted or renamed row leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEEDED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# Cost to go after the last row, and the edits that finish the conversation.
END = ((0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""))


def _as_text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def _key(conv_col: str) -> Column:
    """The conversation id as text, different from any text for a null id."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit(""))


def prepare(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``rows`` in the operator's own columns: ``_conv``, ``_known`` and ``_turn``, ``_role``,
    ``_text``, ``_copies`` (1)."""
    return rows.select(
        _key(conv_col).alias("_conv"),
        F.col(turn_col).isNotNull().alias("_known"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(0).cast("long")).alias("_turn"),
        _as_text(role_col).alias("_role"),
        _as_text(text_col).alias("_text"),
        F.lit(1).alias("_copies"),
    )


def damaged(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``prepare(rows)`` with the faults of the contract put in, by the CRC-32 of ``conv:turn``."""
    own = prepare(rows, conv_col, turn_col, role_col, text_col)
    named = F.concat(
        F.when(F.col("_conv") == "", " ").otherwise(F.expr("substring(_conv, 2)")),
        F.lit(":"),
        F.when(F.col("_known"), F.col("_turn").cast("string")).otherwise(" "),
    )
    own = own.withColumn("_lot", F.crc32(named.cast("binary")) % 20)
    text = F.when(F.col("_lot") == 1, "").when(F.col("_lot") == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text"))
    return own.where("_lot != 0").select(
        "_conv", "_known", "_turn",
        F.when(F.col("_lot") == 4, "user").otherwise(F.col("_role")).alias("_role"),
        text.alias("_text"),
        F.when(F.col("_lot") == 3, 2).otherwise(1).alias("_copies"),
    )


ORDER = ("_conv", "_known", "_turn", "_role", "_digest")


def _with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_digest`` of the text and ``_fault`` (a duplicate is not known yet)."""
    rest = F.rtrim(F.col("_text"), F.lit(BLANKS))
    fault = F.when(rest == "", "blank").when(~F.substring(rest, -1, 1).isin(*CLOSING), "truncated").otherwise("")
    return rows.select("*", F.sha2("_text", 256).alias("_digest"), fault.alias("_fault"))


def _signed(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: order, number of copies, initial, fault, and whether
    role and text come first there."""
    initial = F.substring("_role", 1, 1)
    distinct = rows.groupBy(*ORDER, "_fault").agg(F.sum("_copies").alias("_copies"))
    same = ("_conv", "_role", "_digest")
    first = rows.groupBy(*same).agg(F.min(F.struct("_known", "_turn")).alias("_first"))
    first = first.select(*same, "_first._known", "_first._turn", F.lit(True).alias("_is_first"))
    return distinct.join(first, list(ORDER), "left").select(
        *ORDER, "_fault", "_copies", F.coalesce("_is_first", F.lit(False)).alias("_is_first"),
        F.when(initial.isin(*INITIALS), initial).otherwise("o").alias("_initial"),
    )


_SEGMENTS = (
    "_conv string, _task long, _nr long, _symbols string, _blank long, _duplicate long, _truncated long, _illegal long, "
    "_initial string, _last_initial string, _turns long, _first_turn long, _last_turn long"
)


class _Segment:
    """A stretch of one conversation's rows in one task."""

    def __init__(self):
        self.symbols: list[str] = []
        self.size = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initial = self.last_initial = ""
        self.first_turn = self.last_turn = None

    def add(self, symbol: str, n: int) -> None:
        self.symbols.append(symbol * n)
        self.size += n

    def follow(self, initial: str) -> None:
        if not self.initial:
            self.initial = initial
        elif self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.last_initial = initial

    def row(self, conv: str, task: int, nr: int) -> tuple:
        return (
            conv, task, nr, "".join(self.symbols), self.blank, self.duplicate, self.truncated, self.illegal,
            self.initial, self.last_initial, self.turns, self.first_turn, self.last_turn,
        )


# Pairs of initials that may follow each other.
LEGAL = ("su", "ua", "au")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to segments; one conversation at a time is open."""
    task, nr, conv, now = TaskContext.get().partitionId(), 0, None, _Segment()
    names = [part.split()[0] for part in _SEGMENTS.split(", ")]
    kinds = [pa.string() if "string" in part else pa.int64() for part in _SEGMENTS.split(", ")]
    pack = lambda done: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)
    for batch in batches:
        done = []
        for row in zip(*[batch.column(c).to_pylist() for c in ("_conv", "_known", "_turn", "_fault", "_copies", "_is_first", "_initial")]):
            key, known, turn, fault, copies, is_first, initial = row
            if key != conv:
                if now.size:
                    done.append(now.row(conv, task, nr))
                    nr += 1
                conv, now = key, _Segment()
            now.follow(initial)
            now.illegal += copies - 1
            if known and now.last_turn != turn:
                now.turns += 1
                now.first_turn = turn if now.first_turn is None else now.first_turn
                now.last_turn = turn
            kept = fault != "blank" and is_first
            now.truncated += kept and fault == "truncated"
            if fault == "blank":
                now.blank += copies
            else:
                now.duplicate += copies - kept
            if kept:
                now.add(initial.upper() if fault else initial, 1)
            left = copies - kept
            while left:
                n = min(left, SEGMENT - now.size % SEGMENT)
                now.add("x", n)
                left -= n
                if now.size >= SEGMENT and left:
                    nr, now = _turn_over(done, now, conv, task, nr)
            if now.size >= SEGMENT:
                nr, now = _turn_over(done, now, conv, task, nr)
        if done:
            yield pack(done)
    if now.size:
        yield pack([now.row(conv, task, nr)])


def _turn_over(done: list, now: _Segment, conv: str, task: int, nr: int) -> tuple[int, _Segment]:
    """Closes a full segment; the next one knows how it ended, so nothing is counted twice."""
    done.append(now.row(conv, task, nr))
    new = _Segment()
    new.last_initial = new.initial = now.last_initial
    new.first_turn = new.last_turn = now.last_turn
    return nr + 1, new


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation: ``signature``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``."""
    signed = _signed(rows)
    dealt = signed.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    parts = stored(map_arrow(dealt, _segments, _SEGMENTS), "signature-segments")
    before = Window.partitionBy("_conv").orderBy("_task", "_nr")
    lag = lambda c: F.lag(c).over(before)
    same_task = lag("_task") == F.col("_task")  # its segment has counted what lies between
    meets = lag("_last_initial").isNotNull() & ~same_task
    legal = F.concat(lag("_last_initial"), F.col("_initial")).isin(*LEGAL)
    again = ~same_task & (F.col("_first_turn") == lag("_last_turn"))
    parts = parts.select(
        "*", F.when(meets & ~legal, 1).otherwise(0).alias("_cross"), F.when(again, 1).otherwise(0).alias("_again")
    )
    turns = F.coalesce(F.max("_last_turn") - F.min("_first_turn") + 1 - (F.sum("_turns") - F.sum("_again")), F.lit(0))
    pieces = F.sort_array(F.collect_list(F.struct("_task", "_nr", "_symbols")))
    return parts.groupBy("_conv").agg(
        F.array_join(F.transform(pieces, lambda s: s["_symbols"]), "").alias("signature"),
        turns.cast("long").alias("gaps"),
        *[F.sum(f"_{c}").alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("_illegal") + F.sum("_cross")).alias("illegal"),
    )


class Register:
    """Best edits per symbol and costs to go: nodes that differ in neither share them."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def node(self, symbol: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
        """Costs to go per grammar state, and per state its edits and the state they lead to."""
        least = min(after)
        key = (symbol, *[c - least for c in after])
        if key not in self.known:
            self.known[key] = _best(symbol, key[1:])
        costs, edits = self.known[key]
        return tuple(c + least for c in costs), edits


def _best(symbol: str, after: tuple[int, ...]) -> tuple:
    costs, edits = [], []
    for state in range(4):
        options, here = [], state
        for inserted in range(3):  # a third insertion would only lead back to the first
            done = "I" * inserted
            options.append((inserted * INSERT + DELETE + after[here], done + "D", here))
            if symbol != "x":
                extra = TRUNCATED if symbol.isupper() else 0
                options.append((inserted * INSERT + REROLE + extra + after[NEEDED[here]], done + "R", NEEDED[here]))
                to = INITIALS.get(symbol.lower())
                if to == NEEDED[here] or to == SYSTEM and here == START:
                    options.append((inserted * INSERT + KEEP + extra + after[to], done + "K", to))
            here = NEEDED[here]
        cost, done, to = min(options)
        costs.append(cost)
        edits.append((done, to))
    return tuple(costs), tuple(edits)


def audits(signature_rows: DataFrame) -> DataFrame:
    """``signature``, ``cost`` and ``audit`` of every distinct ``signature``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        register = Register()
        last, path = "", []  # nodes of the signature read last, from its end on
        for batch in batches:
            for part in slices(batch, ROWS_AT_ONCE):
                costs, found = [], []
                ends = part.column(0).to_pylist()
                for backwards in ends:
                    shared = _common(last, backwards)
                    del path[shared:]
                    for symbol in backwards[shared:]:
                        path.append(register.node(symbol, path[-1][0] if path else END[0]))
                    last = backwards
                    costs.append(path[-1][0][START] if path else 0)
                    found.append(_read_off(path))
                forwards = [b[::-1] for b in ends]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(forwards, pa.string()), pa.array(costs, pa.int64()), pa.array(found, pa.string())],
                    names=["signature", "cost", "audit"],
                )

    backwards = signature_rows.select(F.reverse("signature").alias("_backwards")).distinct()
    dealt = backwards.repartitionByRange("_backwards").sortWithinPartitions("_backwards")
    return map_arrow(dealt, step, "signature string, cost long, audit string")


def _common(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _read_off(path: list) -> str:
    state, out = START, []
    for _, edits in reversed(path):
        done, state = edits[state]
        out.append(done)
    return "".join(out) + END[1][state]


_REPAIRED = "_conv string, place long, role string, text string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation an audit row, then its rows in order, to the repaired rows in order."""
    conv, audit, end, at, state, place = None, "", 0, 0, START, 0
    for batch in batches:
        for part in slices(batch, ROWS_AT_ONCE):
            out: list[tuple] = []
            for key, kind, role, text, copies in zip(*[part.column(c).to_pylist() for c in ("_conv", "_kind", "_role", "_text", "_copies")]):
                if kind == 0:
                    conv, audit, end, at, state, place = key, text, len(text.rstrip("I")), 0, START, 0
                    continue
                for _ in range(copies):
                    while audit[at] == "I":
                        at, state = at + 1, NEEDED[state]
                        out.append((conv, place, ROLES[state], ""))
                        place += 1
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    state = NEEDED[state] if edit == "R" else INITIALS[role[0]]
                    out.append((conv, place, ROLES[state] if edit == "R" else role, text))
                    place += 1
                while end <= at < len(audit):  # after the last row only insertions are left
                    at, state = at + 1, NEEDED[state]
                    out.append((conv, place, ROLES[state], ""))
                    place += 1
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())],
                    names=["_conv", "place", "role", "text"],
                )


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repairs prepared (or damaged) rows.

    Returns a report per conversation (``_conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost``, ``audit``) and the repaired rows (``_conv``, ``place``, ``role``, ``text``),
    which come conversation by conversation in order of ``place`` within each task.
    """
    rows = stored(_with_faults(rows), "conversation-rows")
    signed = stored(signatures(rows), "signatures")
    best = stored(audits(signed), "audits")
    if fits_for_broadcast(best, 100_000, 64 << 20):
        best = F.broadcast(best)
    report = stored(signed.join(best, "signature").drop("signature"), "repairs")
    kinds = report.select(
        "_conv", F.lit(0).alias("_kind"), F.lit(False).alias("_known"), F.lit(0).cast("long").alias("_turn"),
        F.lit("").alias("_role"), F.lit("").alias("_digest"), F.col("audit").alias("_text"), F.lit(0).alias("_copies"),
    )
    stream = kinds.union(rows.select("_conv", F.lit(1), "_known", "_turn", "_role", "_digest", "_text", "_copies"))
    stream = stream.repartition("_conv").sortWithinPartitions("_conv", "_kind", *ORDER[1:])
    return report, map_arrow(stream, _repaired, _REPAIRED)


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, from rows that come in order
    (as ``repair`` gives them): the digest is fed row by row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, hashlib.sha256()
        done: list[tuple[str, str]] = []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names=["_conv", "repaired_sha256"])
        for batch in batches:
            for key, role, text in zip(*[batch.column(c).to_pylist() for c in ("_conv", "role", "text")]):
                if key == conv:
                    digest.update(b"\n")
                else:
                    if conv is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = key, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            if done:
                yield pack()
                done = []
        if conv is not None:
            done.append((conv, digest.hexdigest()))
            yield pack()

    return map_arrow(repaired.select("_conv", "role", "text"), step, "_conv string, repaired_sha256 string")


def repair_report(
    rows: DataFrame, prepared: DataFrame | None = None, conv_col: str = "conv_id"
) -> DataFrame:
    """One row per conversation id of ``rows``: the report with ``repaired_sha256``; ``prepared``
    are the rows to repair (those of ``rows`` by default)."""
    report, repaired = repair(prepare(rows, conv_col) if prepared is None else prepared)
    ids = rows.select(F.col(conv_col), _key(conv_col).alias("_conv")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (
        ids.join(report, "_conv", "left")
        .join(digests(repaired), "_conv", "left")
        .select(
            conv_col,
            *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
