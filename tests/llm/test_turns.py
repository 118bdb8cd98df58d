"""Conversation repair against a plain search over all edits, and the tree's bounded memory."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from tonality.llm import turn_repair
from tonality.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """``rows``: (turn, role, text) in order.  The whole answer by a search from the end."""
    faults, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))

    def after(state, initial):
        got = state + initial
        return got if re.fullmatch(r"(s?(ua)*u?)|s", got) and initial else None

    def short(state):
        return state if len(state) < 2 else "ua" if state[-1] == "a" else "uau"

    @cache
    def best(i, state, inserts=3):
        """(cost, edits, repaired rows) of rows i.. after the legal initials ``state`` (cut to what matters)."""
        ways = [(0, "", ())] if i == len(rows) and LEGAL.fullmatch(state) else []

        def go(edit, price, to, text, *rest):
            new = after(state, to[:1])
            if new is not None:
                c, e, r = best(*rest[:1], short(new), *rest[1:])
                ways.append((c + price, edit + e, (f"{to}:{text}", *r)))

        if i < len(rows):
            c, e, r = best(i + 1, state)
            ways.append((c + 4, "D" + e, r))
            _, role, text = rows[i]
            if faults[i] in ("", "truncated"):
                more = 3 * (faults[i] == "truncated")
                go("K", more, role, text, i + 1)
                go("R", 3 + more, "user", text, i + 1)
                go("R", 3 + more, "assistant", text, i + 1)
        if inserts:
            go("I", 3, "user", "", i, inserts - 1)
            go("I", 3, "assistant", "", i, inserts - 1)
        return min(ways) if ways else (10 ** 9, "~", ())

    cost, audit, repaired = best(0, "")
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(repaired).encode()).hexdigest()}


def local(rows):
    report, seen, marked = turn_repair.Report(), set(), []
    for t, role, text in rows:
        marked.append((t, role, text, (role, text) in seen))
        seen.add((role, text))
    nodes = list(turn_repair.edits(marked, report))
    out = "\n".join(f"{n.row[1]}:{n.row[2]}" for n in nodes if n.edit != "D")
    return {"gaps": report.gaps, "blank": report.blank, "duplicate": report.duplicate, "truncated": report.truncated,
            "illegal": report.illegal, "cost": report.cost, "audit": "".join(n.edit for n in nodes),
            "repaired_sha256": hashlib.sha256(out.encode()).hexdigest()}


def some_rows(rng, n):
    roles = rng.choice([["user", "assistant"], ["user", "assistant", "system"], ["tool", "user"], ["tool"],
                        ["user", "assistant", "system", "tool", " ", ""]])
    return [(i + rng.randrange(2), rng.choice(roles), rng.choice(["Yes.", "No!", "so", "", " \t", f"t{i}.", f"t{i}"]))
            for i in range(n)]


def test_every_tie_and_cost_as_a_search_over_all_edits():
    rng = random.Random(3)
    for _ in range(1500):
        rows = some_rows(rng, rng.randrange(0, 9))
        assert local(rows) == brute(rows), rows


@pytest.mark.parametrize("role", ["tool", ""])
def test_all_edits_tied_for_long(role):
    rows = [(i, role, f"t{i}.") for i in range(41)]
    assert local(rows) == brute(rows)


def test_memory_is_the_unresolved_suffix():
    rng = random.Random(5)
    rows = [(i, ("user", "assistant")[i % 2] if rng.random() > .05 else "user", f"t{i}.", rng.random() < .05)
            for i in range(20_000)]
    report = turn_repair.Report()
    n = sum(node.edit != "I" for node in turn_repair.edits(iter(rows), report))
    assert n == len(rows) and report.unresolved < 40


def damaged(rows):
    """The contract's faults, by conversation and in order."""
    out = {}
    for conv, turn, role, text in rows:
        plain = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{plain[0]}:{plain[1]}".encode()) % 20
        role, text = plain[2:]
        mine = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def test_query_on_the_given_table(spark, tmp_path):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r.asDict() for r in QUERIES["op12_survivor_viterbi"](spark, path).collect()}
    want = {c: {"conv_id": c, **brute(tuple(v))} for c, v in damaged(rows).items()}
    assert got == want


def test_awkward_rows(spark, tmp_path):
    rng = random.Random(9)
    rows = [(None if i % 11 == 0 else i % 7, None if rng.random() < .1 else rng.randrange(12),
             rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice([None, "", "a.", "b?", "long " * 5000, "c", "é!\n"]))
            for i in range(300)]
    # a conversation of which no row is left after the damage
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "x."), *rows[:20]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = df.select("*", *[F.lit(1).alias(c) for c in ("conv", "present", "again", "kind", "r", "t", "copy", "step")])
    damage = turn_repair.damage(extra)
    got = [r.asDict() for r in turn_repair.audit(damage, present="present").collect()]
    want = damaged(rows)
    assert len(got) == len(want)
    for r in got:
        conv = r.pop("conv_id")
        report = local(want[conv])
        assert r == report, conv
    empty = next(r for r in turn_repair.audit(damage, present="present").where(F.col("conv_id") == gone).collect())
    assert (empty.cost, empty.audit, empty.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    # the table of edits holds the same repaired rows
    for r in (turn_repair.repair(damage, present="present").groupBy("conv_id")
              .agg(F.sort_array(F.collect_list(F.struct("step", "edit", "role", "text"))).alias("e")).collect()):
        text = "\n".join(f"{x.role}:{x.text}" for x in r.e if x.edit != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == local(want[r.conv_id])["repaired_sha256"]
    assert turn_repair.audit(df.limit(0)).count() == 0 and turn_repair.repair(df.limit(0)).count() == 0


def test_rows_without_a_present_column(spark):
    df = spark.createDataFrame([("c", 0, "user", "Hi."), ("c", 1, "assistant", "Hello."), ("d", 0, "assistant", "So")],
                               "conv_id string, turn int, role string, text string")
    got = {r.conv_id: (r.cost, r.audit) for r in turn_repair.audit(df).collect()}
    assert got == {"c": (0, "KK"), "d": (4, "D")}
