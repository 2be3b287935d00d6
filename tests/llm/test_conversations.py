"""Repair of conversations against all edit sequences, the registered SQL and spilled runs."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from odd_rows import SMALL

import __spark_entry__ as driver
from verification.check import differences, duck, duck_rows, spark_rows
from waterline.llm import conversations

DDL = "conv_id long, turn long, role string, text string, part string, step int, fault string, seen int"
SOUND = re.compile(r"(s?(ua)+)?")


def test_against_sql(spark):
    got = spark_rows(driver.queries()["op13_conversations"](spark, SMALL))
    assert differences(got, duck_rows(duck(SMALL), driver.oracle_sql()["op13_conversations"])) == []


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        words = text.encode().split()
        if not words:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if words[-1][-1:] in b".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All sequences of edits with at most two insertions in a row."""
    found = faults(rows)
    best = None
    ways = []
    for (role, _), fault in zip(rows, found, strict=True):
        stay = [] if fault in ("blank", "duplicate") else [("K", role[:1] or "-", 0), ("R", "u", 1), ("R", "a", 1)]
        ways.append([(e, i, c + 5 * (fault == "truncated")) for e, i, c in stay] + [("D", "", 2)])
    inserts = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    for edits in itertools.product(*ways):
        for places in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(c for _, _, c in edits) + 5 * sum(map(len, places))
            if best and cost > best[0]:
                continue
            roles = "".join("".join(p) + e[1] for p, e in zip(places, [*edits, ("", "", 0)], strict=True))
            audit = "".join("I" * len(p) + e[0] for p, e in zip(places, [*edits, ("", "", 0)], strict=True))
            if SOUND.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def random_rows(draw, length):
    roles = ["user", "assistant", "system", "tool", "u", "", "system"]
    return [(draw.choice(roles), draw.choice(["a.", "b!", "c", " ", "", "d ?  ", "e. "]) if draw.random() < 0.7 else f"t{i}.") for i in range(length)]


def test_cheapest_edits(spark):
    draw = random.Random(2)
    made = {i: random_rows(draw, draw.randrange(0, 4)) for i in range(60)}
    rows = [(i, turn, *row, *["x", 1, "y", 2]) for i, conversation in made.items() for turn, row in enumerate(conversation)]
    log = conversations.edits(spark.createDataFrame(rows, DDL).repartition(3))
    got = {r.part: r for r in conversations.reports(log).collect()}
    for i, conversation in made.items():
        if conversation:
            r = got[str(i)]
            assert (r.cost, r.audit) == cheapest(conversation)
            assert (r.blank, r.duplicate, r.truncated) == tuple(faults(conversation).count(f) for f in ("blank", "duplicate", "truncated"))
    kept = {}
    for r in conversations.repaired(log).orderBy("part", "step").collect():
        kept.setdefault(r.part, []).append(r)
    for part, r in got.items():
        stays = kept.get(part, [])
        assert SOUND.fullmatch("".join(k.role[0] for k in stays))
        assert hashlib.sha256("\n".join(f"{k.role}:{k.text}" for k in stays).encode()).hexdigest() == r.repaired_sha256


def damaged(conv_id, turn, role, text):
    role, text = (" " if x is None else x for x in (role, text))
    case = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
    if case == 4:
        role = "user"
    text = {1: "", 2: re.sub("[.!?]", "", text)}.get(case, text)
    return [(turn, role, text)] * {0: 0, 3: 2}.get(case, 1)


def test_odd_rows(spark):
    rows = [(None, t, "user" if t % 2 else "assistant", f"n{t % 3}.") for t in range(5)]
    rows += [(None, None, None, None), (1, None, "user", "first."), (1, None, "assistant", None), (1, 2**60, "user", "y " * 200_000 + ".")]
    rows += [(2, 7, "user", "tie."), (2, 7, "assistant", "tie."), (2, 7, "user", "tie."), (-3, -5, "system", ""), (-3, -1, "", "é…")]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(10, 60) for t in range(4)]
    given = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DDL).repartition(4)
    got = {r.conv_id: r for r in conversations.repair_conversations(given).collect()}
    assert set(got) == {r[0] for r in rows} and len(got) == len({r[0] for r in rows})
    for conv_id in got:
        after = sorted((x for r in rows if r[0] == conv_id for x in damaged(*r)), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = [t for t, _, _ in after if t is not None]
        r = got[conv_id]
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert r.illegal == sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(after))
        if len(after) < 4:
            assert (r.cost, r.audit) == (cheapest([x[1:] for x in after]) if after else (0, ""))
    assert conversations.repair_conversations(given.limit(0)).count() == 0


@pytest.mark.parametrize("length", [0, 1, 7, 500])
def test_spilled_blocks_give_the_same_edits(monkeypatch, length):
    draw = random.Random(length)
    made = random_rows(draw, length)
    rows = [(i, *row, fault) for i, (row, fault) in enumerate(zip(made, faults(made), strict=True))]

    def log():
        conversation = conversations._Conversation("c")
        for row in rows:
            conversation.add(*row)
        return list(conversation.edits()), len(conversation.blocks)

    whole, none = log()
    monkeypatch.setattr(conversations, "HELD_ROWS", 3)
    spilled, blocks = log()
    assert spilled == whole and none == 0 and blocks == length // 3


def test_one_shuffle_for_the_log(spark):
    plan = conversations.edits(spark.createDataFrame([(1, 1, "user", "a.", "x", 1, "y", 2)], DDL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
