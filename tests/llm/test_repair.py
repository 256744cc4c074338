"""Operator 12 against a search over all edits, and against a plain reading of its rules."""

import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from placeseek.llm import repair
from placeseek.llm.repair import Register, _best, audits, digests, prepare, repair_report

GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(signature):
    """(cost, audit) by Dijkstra over (row, roles so far as far as the grammar cares)."""
    following = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if (at, last) in seen:
            continue
        seen.add((at, last))
        if at == len(signature) and last in ("", "a"):
            return cost, audit
        for role in following[last]:
            if role != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", at, role))
            if at < len(signature) and signature[at] != "x":
                extra = 3 if signature[at].isupper() else 0
                if role == signature[at].lower():
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role))
                if role != "s":
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, role))
        if at < len(signature):
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last))
    raise AssertionError


def brute(rows):
    """The report of one conversation from its rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, signature, counts = set(), "", dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
        signature += "x" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit = cheapest(signature)
    lines, at, last = [], 0, ""
    for edit in audit:
        need = "assistant" if last == "u" else "user"
        if edit == "I":
            lines.append((need, ""))
        else:
            _, role, text = rows[at]
            at += 1
            if edit != "D":
                lines.append((need if edit == "R" else role, text))
        if edit != "D":
            last = lines[-1][0][0]
    assert GRAMMAR.fullmatch("".join(r[0] for r, _ in lines))
    return dict(
        gaps=max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **counts,
        illegal=sum(p not in ("su", "ua", "au") for p in pairs), cost=cost, audit=audit,
        repaired_sha256=hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


def test_every_short_signature_gets_its_cheapest_audit(spark):
    rnd = random.Random(12)
    words = {""} | {"".join(rnd.choice("suaoSUAOx") for _ in range(rnd.randint(1, 9))) for _ in range(1500)}
    words |= {a + b + c for a in "suaoSUAOx" for b in "suaoSUAOx" for c in "suaoSUAOx"}
    table = spark.createDataFrame([(w,) for w in sorted(words)] * 2, "signature string")
    got = audits(table).collect()
    assert len(got) == len(words)
    assert {r.signature: (r.cost, r.audit) for r in got} == {w: cheapest(w) for w in words}


def test_each_node_is_solved_once_for_all_signatures(monkeypatch):
    """Suffixes shared by many signatures, and nodes of equal futures, are solved once."""
    solved = []
    monkeypatch.setattr(repair, "_best", lambda *a: solved.append(a) or _best(*a))
    import pyarrow as pa

    endings = "uauaUaxua"
    words = sorted((c * n + endings)[::-1] for c in "suo" for n in range(40))
    register, held = Register, []
    monkeypatch.setattr(repair, "Register", lambda: held.append(register()) or held[-1])
    monkeypatch.setattr(repair, "map_arrow", lambda df, step, schema: list(step(iter([pa.record_batch({"b": words})]))))
    from unittest.mock import MagicMock

    [batch] = repair.audits(MagicMock())
    assert dict(zip(batch["signature"].to_pylist(), batch["audit"].to_pylist())) == {w[::-1]: cheapest(w[::-1])[1] for w in words}
    assert len(solved) == len(held[0].known) < 60  # of some 2,700 rows


ROLES = ["user", "assistant", "system", "tool", "", None, "u2"]
TEXTS = ["Yes.", "No", " \t\n", "", None, "Ja!\n ", "ä?", "x ", "Yes.", "why"]


def _random_rows(rnd, n):
    return [(rnd.choice([None, 0, 1, 2, 3, 5, 9]), rnd.choice(ROLES), rnd.choice(TEXTS)) for _ in range(n)]


@pytest.mark.parametrize("segment", [1 << 16, 3])
def test_reports_equal_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rnd = random.Random(segment)
    convs = {i if i else None: _random_rows(rnd, rnd.randint(1, 12)) for i in range(120)}
    rows = [(c, *r, "extra") for c, rs in convs.items() for r in rs]
    rnd.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, _conv string").repartition(5)
    got = {r.conv_id: r.asDict() for r in repair_report(table).collect()}
    assert got == {c: {"conv_id": c, **brute(rs)} for c, rs in convs.items()}


def test_a_conversation_spread_over_many_tasks(spark):
    """One conversation with nearly all rows: its signature comes from several tasks' segments."""
    rnd = random.Random(5)
    big = [(i // 2, rnd.choice(["user", "assistant"]), rnd.choice(["a.", "b!", f"text {i}", f"end {i}."])) for i in range(6000)]
    small = [(1, "user", "Hi."), (2, "assistant", "Hello.")]
    rows = [(7, *r) for r in big] + [(8, *r) for r in small]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: r.asDict() for r in repair_report(table).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == {7: {"conv_id": 7, **brute(big)}, 8: {"conv_id": 8, **brute(small)}}


def test_repaired_rows_and_long_texts(spark):
    long = "very long " * 300_000
    table = spark.createDataFrame([(1, 1, "assistant", long), (1, 2, "user", "ok."), (1, 2, "user", "ok.")], "conv_id long, turn long, role string, text string")
    report, rows = repair.repair(prepare(table))
    assert [r.audit for r in report.collect()] == ["DKDI"]
    assert [(r.place, r.role, r.text) for r in rows.collect()] == [(0, "user", "ok."), (1, "assistant", "")]
    assert digests(rows).first().repaired_sha256 == hashlib.sha256(b"user:ok.\nassistant:").hexdigest()
    kept = table.where("turn = 1").withColumn("role", F.lit("user"))
    assert brute([(1, "user", long)]).items() <= repair_report(kept).first().asDict().items()


def test_nothing_left_and_empty_tables(spark):
    table = spark.createDataFrame([(1, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    row = repair_report(table, prepare(table).limit(0)).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair_report(table.limit(0)).count() == 0


def test_damage_follows_the_checksum(spark):
    from zlib import crc32

    rows = [(c, t, "assistant", "One. Two!") for c in range(60) for t in range(4)] + [(3, None, "user", None), (None, 2, None, "x?")]
    got = repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        lot = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if lot:
            new = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
            want.append(("" if c is None else f"={c}", t is not None, t or 0, "user" if lot == 4 else role, new, 2 if lot == 3 else 1))
    assert sorted(map(tuple, got)) == sorted(want)
