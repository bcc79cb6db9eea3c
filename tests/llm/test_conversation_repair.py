from __future__ import annotations

import hashlib
import itertools
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from textlake.llm import conversation_repair as C

PATTERN = re.compile(r"(s?(ua)+)?")


def every_split(rows: list[tuple[str, str]]) -> tuple[int, str]:
    """CYK over all spans and all ways to split them; rows: (initial, fault)."""
    n, cells = len(rows), {}
    for size in range(1, n + 1):
        for i in range(n - size + 1):
            if size == 1:
                cells[i, i + 1] = C.row_cell(*rows[i])
                continue
            tried = [C.combined(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
            assert all(t == tried[0] for t in tried)  # any split gives the span's cell
            cells[i, i + size] = tried[0]
    cell = cells[0, n] if n else C.NO_ROWS
    return min(cell[p] for p in C.ENDS if p in cell)


def listed(rows: list[tuple[str, str]], most: int = 4) -> tuple[int, str]:
    """Least (cost, audit) by trying all edits with at most so many insertions."""
    best = None
    for inserts in range(most + 1):
        for where in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
            slots = [(["I"] * where.count(k), k) for k in range(len(rows) + 1)]
            for kinds in itertools.product("KRD", repeat=len(rows)):
                audit, cost, choices = "", 3 * inserts, []
                for extra, k in slots:
                    audit += "".join(extra)
                    choices += ["ua"] * len(extra)
                    if k < len(rows):
                        (initial, fault), kind = rows[k], kinds[k]
                        audit += kind
                        if kind == "D":
                            cost += 4
                            continue
                        if fault in ("blank", "duplicate"):
                            cost = 10**6
                        cost += (3 if fault == "truncated" else 0) + (3 if kind == "R" else 0)
                        choices.append("ua" if kind == "R" else initial)
                if (best is None or (cost, audit) < best) and any(PATTERN.fullmatch("".join(x)) for x in itertools.product(*choices)):
                    best = (cost, audit)
    return best


def test_cells_equal_every_split_and_every_edit():
    rng = random.Random(2)
    for _ in range(60):
        rows = [(rng.choice("suuaa?"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(0, 4))]
        assert every_split(rows) == listed(rows), rows
    for _ in range(20):
        rows = [(rng.choice("suuaa?"), rng.choice(["", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(5, 24))]
        span = C.Span()
        for initial, fault in rows:
            span.push(1, C.row_cell(initial, fault))
        cell = span.cell()
        assert min(cell[p] for p in C.ENDS if p in cell) == every_split(rows)


def plain(rows: list[tuple], damage: bool) -> dict:
    """The report by parsing each conversation whole, through all splits."""
    found: dict = {}
    for conv, turn, role, text in rows:
        role, text, copies = " " if role is None else role, " " if text is None else text, 1
        if damage:
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            code = crc32(key.encode()) % 20
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
            role, copies = "user" if code == 4 else role, {0: 0, 3: 2}.get(code, 1)
        found.setdefault(conv, []).extend([(turn is not None, turn or 0, role, text, turn)] * copies)
    report = {}
    for conv, own in found.items():
        own.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, parsed, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text, _ in own:
            rest = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] = counts.get(fault, 0) + 1
            parsed.append((role[:1], fault))
        cost, audit = every_split(parsed)
        initials = [p[0] for p in parsed]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        turns = [r[4] for r in own if r[4] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines, rest, before = [], iter(own), ""
        for edit in audit:
            row = None if edit == "I" else next(rest)
            if edit == "D":
                continue
            role = row[2] if edit == "K" else "assistant" if before == "u" else "user"
            before = role[0]
            lines.append(f"{role}:{row[3] if row else ''}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        report[conv] = (min(gaps, 2**63 - 1), counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return report


def cases(seed: int) -> list[tuple]:
    rng, rows = random.Random(seed), []
    texts = ["Hi.", "Yes!", "no", "", " \t\n", "What?", "Fine. ", "ok\x0b", "é.", "...", None]
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "tool", "", "User", "unknown", "agent", "sys", None]
    for conv in [*range(60), None, -(2**63)]:
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(70, t, "user", "Same.") for t in (-(2**63), 2**63 - 1)]
    rows += [(71, 1, "user", "Copy.")] * 5 + [(71, 2, "assistant", "Copy.")] * 3
    rows += rng.sample(rows, 30)
    return rows


KIND = "conv_id long, turn long, role string, text string"


def read(df) -> dict:
    rows = df.collect()
    assert df.columns == ["conv_id", *C.COUNTS, "audit", "repaired_sha256"]
    return {r[0]: tuple(r)[1:] for r in rows} if len({r[0] for r in rows}) == len(rows) else None


def test_reports_equal_whole_parses(spark):
    rows = cases(5)
    df = spark.createDataFrame(rows, KIND).withColumn("copies", F.lit("x")).withColumn("kind", F.lit(7)).withColumn("first", F.lit(1)).repartition(7)
    assert read(C.repair_report(df)) == plain(rows, False)
    assert read(C.damaged_and_repaired(df)) == plain(rows, True)


def test_repaired_rows(spark):
    rows = cases(6)
    df = spark.createDataFrame(rows, KIND)
    wanted = plain(rows, False)
    found: dict = {}
    for r in C.repair(df).orderBy("conv_id", "place").collect():
        found.setdefault(r["conv_id"], []).append(r)
    for conv, (*_, audit, digest) in wanted.items():
        own = found.get(conv, [])
        assert [r["place"] for r in own] == list(range(len(own)))
        assert "".join(r["edit"] for r in own) == audit.replace("D", "")
        assert PATTERN.fullmatch("".join(r["role"][:1] for r in own))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own).encode()).hexdigest() == digest


def test_one_conversation_in_many_tasks(spark):
    """A conversation of nearly all rows is parsed by several tasks, with the same result."""
    rng = random.Random(9)
    texts = ["A.", "B!", "long text", "", "Ok."] + [f"text {i}." for i in range(300)]
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(texts)) for t in range(4000)] + cases(7)
    df = spark.createDataFrame(rows, KIND).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = C.spans(C.prepared(df)).where("conv_id = 1").count()
        found = read(C.repair_report(df))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts >= 4
    rest = plain([r for r in rows if r[0] != 1], False)
    assert {k: v for k, v in found.items() if k != 1} == {k: v for k, v in rest.items() if k != 1}
    span, seen = C.Span(), set()
    for conv, turn, role, text in sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
        role, text = role if role is not None else " ", text if text is not None else " "
        span.add(turn, role, text, 1, (role, text) not in seen)
        seen.add((role, text))
    cell = span.cell()
    assert found[1][5:7] == min(cell[p] for p in C.ENDS if p in cell)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(None, 1, "user", "Hi.")]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    assert read(C.repair_report(df)) == plain(rows, False)
    assert C.repair(df).count() == sum(len(r[6].replace("D", "")) for r in plain(rows, False).values())
