"""Repair of conversations against a plain search by cost, over real rows and awkward ones."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from laneforge.llm import conversations as c
from laneforge.llm import queries

SF = "/root/testdata/sf0.01"
ACCEPTED = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """(conv_id, turn, role, text) as the contract has it, in order; every conversation is a key."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += []
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        if kind:
            out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        stripped = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def by_cost(rows, found):
    """The cheapest edits by a queue of (cost, audit): no bound, no estimate, roles told by the pattern itself."""
    prefixes = {"": True, "s": False, "u": False, "a": True}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, roles, out = heapq.heappop(queue)
        key = (i, roles[-1:] or ("" if not roles else roles))
        if key in done:
            continue
        done.add(key)
        if i == len(rows) and prefixes[roles[-1:]] and ACCEPTED.fullmatch(roles):
            return cost, audit, list(out)
        may = lambda x: ACCEPTED.fullmatch(roles + x) or ACCEPTED.fullmatch(roles + x + "a") or ACCEPTED.fullmatch(roles + x + "ua")  # noqa: B023, E731
        for name in ("user", "assistant"):
            if may(name[0]):
                heapq.heappush(queue, (cost + 3, audit + "I", i, roles + name[0], (*out, (name, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, roles, out))
            if found[i] not in ("blank", "duplicate"):
                extra = 3 * (found[i] == "truncated")
                if role[:1] in ("s", "u", "a") and may(role[0]):
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, roles + role[0], (*out, (role, text))))
                for name in ("user", "assistant"):
                    if may(name[0]):
                        heapq.heappush(queue, (cost + 3 + extra, audit + "R", i + 1, roles + name[0], (*out, (name, text))))
    raise AssertionError("no repair")


def expected(rows):
    out = {}
    for conv, mine in damage(rows).items():
        found = faults(mine)
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, left = by_cost(mine, found)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv] = (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, digest)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(spark, path):
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op11_conversation_repair(spark, path).collect()
    want = expected(rows)
    assert len(found) == len(want)
    for r in found:
        assert tuple(r[k] for k in COLUMNS) == want[r.conv_id], r.conv_id
    return want


def test_real_rows(spark):
    assert len(check(spark, SF)) == 100


AWKWARD = [
    (None, 0, "user", "No id."), (None, 1, "assistant", "Is there?"), (None, None, "system", "Null turn."), (1, None, None, None), (1, 5, "user", None), (1, 5, None, "Which?"), (1, 9, "", "No role."),
    (2, 0, "system", "Alone."), (4, 0, "tool", "Other."), (4, 1, "USER", "Capitals!"), (4, 2, "unknown", "Kept by initial."), (5, 0, "user", "Same."), (5, 1, "user", "Same."), (5, 2, "user", "Same."), (5, 2, "user", "Same."),
    (6, 3, "user", " \t\n\x0b\x0c\r"), (6, 4, "assistant", "ends with spaces. \n"), (6, 5, "user", "x "), (6, -3, "user", "\x85"), (7, 0, "assistant", "a" * 300_000 + "."),
    *((8, k, ("user", "assistant", "system")[k % 3], f"Turn {k}.") for k in range(700)), *((9, 0, "system", f"Note {k}") for k in range(30)), (9, 1, "user", "late?"),
]


def test_awkward_rows(spark, tmp_path):
    rows = [(*r, "x", "y", 1) for r in AWKWARD]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, _digest string, _copy int").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    check(spark, str(tmp_path))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_conversation_repair(spark, str(tmp_path))
    assert found.collect() == [] and {"conv_id", *COLUMNS} <= set(found.columns)


def test_all_rows_dropped(spark, tmp_path):
    turns = [t for t in range(200) if zlib.crc32(f"3:{t}".encode()) % 20 == 0]
    spark.createDataFrame([(3, t, "user", "Hi.") for t in turns], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert turns and check(spark, str(tmp_path)) == {3: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("seed", range(4))
def test_search_against_the_queue(seed):
    """Short sequences of every kind of row: cost and audit; and the bound of the easier problem is never too high."""
    rng = random.Random(seed)
    for _ in range(1500):
        kinds = bytes(rng.choice(b"-ouasOUAS") for _ in range(rng.randrange(9)))
        rows = [(0, "x" if k in b"-oO" else chr(k | 32), "") for k in kinds]
        found = ["blank" if k == c.GONE else "truncated" if k < 91 else "" for k in kinds]
        cost, audit, _ = by_cost(rows, found)
        assert c.cheapest(kinds) == (cost, audit), kinds
        assert cost - 6 <= c.relaxed(kinds)[0][0] <= cost


def test_long_conversation_takes_few_steps():
    rng = random.Random(1)
    kinds = bytes(rng.choice(b"-oouuuaaasU") for _ in range(60_000))
    cost, audit = c.cheapest(kinds)
    assert cost > 0 and sum(x != "I" for x in audit) == len(kinds)


def test_repaired_rows(spark):
    """The messages themselves: roles that the pattern accepts, and edits that make up the audit."""
    rows = c.damaged(c.texts(c.conversations(spark, SF)))
    plan = c.plans(rows)
    audits = {r.conv_id: r.audit for r in plan.collect()}
    found = defaultdict(list)
    for r in c.repaired(rows, plan).orderBy("conv_id", "step").collect():
        found[r.conv_id].append(r)
    for conv, audit in audits.items():
        assert ACCEPTED.fullmatch("".join(r.role[0] for r in found[conv]))
        assert "".join(r.edit for r in found[conv]) == audit.replace("D", "")
        assert [r.step for r in found[conv]] == list(range(len(found[conv])))


def test_undamaged_rows(spark):
    rows = c.whole(c.texts(c.conversations(spark, SF)))
    assert c.plans(rows).where("cost = 0 AND NOT audit RLIKE '^K+$'").isEmpty()


def test_sql_gives_the_same_rows(spark, tmp_path):
    """The twin over awkward rows too."""
    import duckdb

    rows = [r for r in AWKWARD if r[0] != 8]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    found = duck.execute(c.oracle())
    names = [d[0] for d in found.description]
    want = {r.conv_id: r for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    got = {x["conv_id"]: x for x in (dict(zip(names, r)) for r in found.fetchall())}
    assert got.keys() == want.keys()
    for conv, row in got.items():
        assert all(row[k] == want[conv][k] for k in COLUMNS), conv
