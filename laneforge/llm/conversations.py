"""Repair of conversations whose turns no longer alternate, by iterative-deepening A*.

A repaired conversation has an optional system message and then pairs of a user's and an
assistant's messages, or nothing at all. The cheapest edits that give one are searched depth-first in the ASCII order
of their initials (Delete, Insert, Keep, Rerole) under a rising bound of the cost; states that have
failed under a bound are remembered with the slack they failed with, so each is left at once when it comes again with no more. The
first path that is accepted has the least cost and, of those, the least initials. The bound starts
from the exact cost of an easier problem, in which a system message alone is accepted too; it is
never too high and at most two insertions too low, so few rounds are made and time grows with the rows.

A conversation is searched over one byte a row (role and fault), so the rows of a task come as a
sorted stream and no conversation's texts are held. Repeated messages are found by a window over digests.
A conversation is one task's work all the same, since its audit and its digest are one value of it in order; it
may have as many rows as a string has bytes, two billion.

Defined cases: a null id is a conversation of its own. A null role or text counts as one space. Rows of one turn are
taken in order of role, then of a hash of the text; null turns come first. A role of no letter has no
initial and can't be kept. A role of an initial of s, u or a is kept as it stands. Other columns and an
empty table do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laneforge.llm.common import saved

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANK_CHARS, ENDS = r"\x20\x09-\x0D", ".!?"
#: What a row is to the search: it must go (blank or repeated), or the initial that it has; capitals stand for truncated rows.
GONE, OTHER = ord("-"), ord("o")
#: States of the accepted roles: nothing yet, after a system message, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE_AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT_AS = {ord("s"): SYSTEM, ord("u"): USER, ord("a"): ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
ORDER = ["conv_id", "turn", "role", "_digest", "_copy"]


# ---- rows before the search --------------------------------------------------------------


def texts(rows: DataFrame) -> DataFrame:
    """The four columns of a conversation's rows, a null role or text as one space."""
    blank = F.lit(" ")
    return rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``texts`` damaged by a hash of id and turn; ``_copy`` numbers a repeated row, and is null for a dropped one."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("_kind", F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20)
    kind = F.col("_kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 0, F.array(F.lit(None).cast("int"))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy"))


def whole(rows: DataFrame) -> DataFrame:
    """Rows of ``texts`` as they are, in the columns of ``damaged``."""
    return rows.withColumn("_copy", F.lit(0))


def with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_digest", F.unhex(F.md5(F.encode("text", "UTF-8"))))


def marked(rows: DataFrame) -> DataFrame:
    """Narrow rows, by conversation: place, and ``kind``, the byte that the search reads; null for a dropped row.

    ``fault`` is 1 for blank, 2 for a repeated and 3 for a truncated row.
    """
    stripped = F.regexp_replace("text", f"[{BLANK_CHARS}]+$", "")
    narrow = with_digest(rows).select(
        "conv_id", "turn", "role", "_digest", "_copy", (F.length(stripped) == 0).alias("blank"), (~F.substring(stripped, -1, 1).isin(*ENDS)).alias("open"),
    )
    # one exchange by conversation serves the window and the sort that follows it
    again = Window.partitionBy("conv_id", "role", "_digest").orderBy(F.col("_copy").isNull(), F.col("turn").asc_nulls_first(), "_copy")
    narrow = narrow.repartition("conv_id").withColumn("again", F.row_number().over(again) > 1)
    fault = F.when(F.col("blank"), 1).when(F.col("again"), 2).when(F.col("open"), 3).otherwise(0)
    return narrow.select(*ORDER, F.when(F.col("_copy").isNotNull(), fault).cast("byte").alias("fault"))


def in_order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), *(F.col(c).asc_nulls_last() for c in ORDER[2:])]


# ---- search ------------------------------------------------------------------------------


def kind_of(role: str, fault: int) -> int:
    if fault in (1, 2):
        return GONE
    initial = ord(role[0]) if role[:1] in ("s", "u", "a") else OTHER
    return initial - 32 if fault == 3 else initial


def relaxed(kinds: bytes) -> tuple[list[int], list[int], list[int]]:
    """The least cost from each row to the end at the start, where a user's message is due, and where an assistant's is.

    Exact but for one thing: it accepts a system message that nothing follows.
    """
    n = len(kinds)
    at_start, due_user, due_assistant = [0] * (n + 1), [0] * (n + 1), [INSERT] * (n + 1)
    for i in range(n - 1, -1, -1):
        start, user, assistant = at_start[i + 1], due_user[i + 1], due_assistant[i + 1]
        kind = kinds[i]
        s, u, a = DELETE + start, DELETE + user, DELETE + assistant
        if kind != GONE:
            extra = TRUNCATED if kind < 91 else 0  # a capital
            initial = kind | 32
            to_user, to_assistant = extra + assistant + (0 if initial == 117 else REROLE), extra + user + (0 if initial == 97 else REROLE)
            s, u, a = min(s, to_user), min(u, to_user), min(a, to_assistant)
            if initial == 115:
                s = min(s, extra + user)
        u, a = min(u, INSERT + a), min(a, INSERT + u)
        at_start[i], due_user[i], due_assistant[i] = min(s, INSERT + a), u, a
    return at_start, due_user, due_assistant


def cheapest(kinds: bytes) -> tuple[int, str]:
    """The least cost and the initials of the edits, by iterative deepening."""
    at_start, due_user, due_assistant = relaxed(kinds)
    ahead = (at_start, due_user, due_assistant, due_user)
    bound = at_start[0]
    while True:
        path, bound = search(kinds, ahead, bound)
        if path is not None:
            return bound, path


def search(kinds: bytes, ahead, bound: int) -> tuple[str | None, int]:
    """The first accepted path under ``bound``, and the bound; or None and the next bound to try."""
    n = len(kinds)
    failed = bytearray(4 * (n + 1))  # by state: the largest slack (two insertions at most) that it failed with, and one
    rows, states, costs, turns, path = [0], [START], [0], [0], bytearray()
    beyond = None
    while rows:
        i, state, cost, turn = rows[-1], states[-1], costs[-1], turns[-1]
        if turn == 0 and i == n and state in (START, ASSISTANT):
            return path.decode(), bound
        if turn == 4:
            failed[4 * i + state] = max(failed[4 * i + state], bound - cost - ahead[state][i] + 1)
            rows.pop(), states.pop(), costs.pop(), turns.pop()
            if path:
                path.pop()
            continue
        turns[-1] += 1
        then, to, price, initial = i + 1, state, None, b"DIKR"[turn]
        if initial == 73:  # Insert
            then, to, price = i, ROLE_AFTER[state], INSERT
        elif i < n:
            kind = kinds[i]
            extra = TRUNCATED if kind != GONE and kind < 91 else 0
            held = KEPT_AS.get(kind | 32) if kind != GONE else None
            legal = held == ROLE_AFTER[state] or held == SYSTEM and state == START
            if initial == 68:  # Delete
                price = DELETE
            elif initial == 75 and legal:  # Keep
                to, price = held, KEEP + extra
            elif initial == 82 and kind != GONE and held != ROLE_AFTER[state]:  # Rerole
                to, price = ROLE_AFTER[state], REROLE + extra
        if price is None:
            continue
        total = cost + price
        slack = bound - total - ahead[to][then]
        if slack < 0:
            beyond = bound - slack if beyond is None else min(beyond, bound - slack)
        elif slack >= failed[4 * then + to]:
            rows.append(then), states.append(to), costs.append(total), turns.append(0)
            path.append(initial)
    return None, beyond


# ---- by conversation ---------------------------------------------------------------------

PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def plans(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (as ``damaged`` or ``whole`` give them): its faults, and the cheapest edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None
        for batch in batches:
            for conv, turn, role, fault in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.closed())
                    now = Conversation(conv)
                if fault is not None:
                    now.add(turn, role, fault)
            if len(done) >= 1000:
                yield batch_of(done, PLAN)
                done = []
        if now is not None:
            done.append(now.closed())
        yield batch_of(done, PLAN)

    ordered = marked(rows).sortWithinPartitions(*in_order()).select("conv_id", "turn", "role", "fault")
    return ordered.withColumn("conv_id", F.col("conv_id").cast("long")).mapInArrow(run, PLAN)


class Conversation:
    """What is held of a conversation while its rows go by: counts, and one byte a row."""

    def __init__(self, conv):
        self.conv, self.kinds, self.counts = conv, bytearray(), [0, 0, 0, 0]
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.before = None

    def add(self, turn, role: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.kinds.append(kind_of(role, fault))

    def closed(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = cheapest(bytes(self.kinds))
        return (self.conv, gaps, *self.counts[1:], self.illegal, cost, audit)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [c.split() for c in schema.split(", ")]
    columns = [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def beside_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of each conversation in order, after a row with its audit, as a sorted stream."""
    kept = with_digest(rows.where("_copy IS NOT NULL")).withColumns({"conv_id": F.col("conv_id").cast("long"), "audit": F.lit(None).cast("string")})
    heads = plan.select("conv_id", "audit")
    both = kept.unionByName(heads, allowMissingColumns=True).repartition("conv_id")
    first = F.col("audit").isNull()
    ordered = both.sortWithinPartitions(in_order()[0], first, *in_order()[1:])
    return ordered.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "audit")


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each edit of each conversation (conv_id, initial, turn, role, text), a deleted row's included; a conversation starts with (conv_id, None, ...)."""
    audit, at, state = "", 0, START
    conv = None
    for batch in batches:
        for conv_id, turn, role, text, head in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if head is not None:
                for edit in inserted(conv, audit, at, state):
                    yield edit[0]
                conv, audit, at, state = conv_id, head, 0, START
                yield conv, None, None, None, None
                continue
            for edit, state, at in inserted(conv, audit, at, state):
                yield edit
            initial, at = audit[at], at + 1
            if initial == "R":
                role = NAMES[ROLE_AFTER[state]]
            if initial != "D":
                state = KEPT_AS[ord(role[0])]
            yield conv, initial, turn, role, text
    for edit in inserted(conv, audit, at, state):
        yield edit[0]


def inserted(conv, audit: str, at: int, state: int) -> Iterator[tuple]:
    """The insertions that stand next in an audit, each with the state and place after it."""
    while audit[at : at + 1] == "I":
        state, at = ROLE_AFTER[state], at + 1
        yield (conv, "I", None, NAMES[state], ""), state, at


REPAIRED = "conv_id long, step long, edit string, turn long, role string, text string"


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The messages of each repaired conversation in order of ``step``, from 0, with the edit that each came by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, step, size = [], 0, 0
        for conv, initial, turn, role, text in edited(batches):
            if initial is None:
                step = 0
            elif initial != "D":
                out.append((conv, step, initial, turn, role, text))
                step, size = step + 1, size + len(text)
            if size > 1 << 20 or len(out) >= 10_000:
                yield batch_of(out, REPAIRED)
                out, size = [], 0
        yield batch_of(out, REPAIRED)

    return beside_plan(rows, plan).mapInArrow(run, REPAIRED)


def digests(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256``, of the repaired messages as role:text, newline-joined."""
    schema = "conv_id long, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, joint, last = [], None, b"", None
        for conv, initial, _, role, text in edited(batches):
            if initial is None:
                if digest is not None:
                    out.append((last, digest.hexdigest()))
                digest, joint, last = hashlib.sha256(), b"", conv
                if len(out) >= 1000:
                    yield batch_of(out, schema)
                    out = []
            elif initial != "D":
                digest.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
        if digest is not None:
            out.append((last, digest.hexdigest()))
        yield batch_of(out, schema)

    return beside_plan(rows, plan).mapInArrow(run, schema)


def audits(rows: DataFrame) -> DataFrame:
    """Plan and digest of each conversation, the null one included."""
    plan = saved(plans(rows))
    found = digests(rows, plan).withColumnRenamed("conv_id", "_conv")
    return plan.join(found, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


# ---- the same in SQL ---------------------------------------------------------------------


def best(*options: str) -> str:
    """The least of structs (c: cost, a: audit, r: repaired text), nulls left out."""
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


def after(state: str, cost: str, initial: str, piece: str | None = None, when: str = "true") -> str:
    """A state after an edit that costs ``cost`` and adds a message ``piece``."""
    text = f"{state}.r" if piece is None else f"coalesce({state}.r || chr(10), '') || {piece}"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{initial}', 'r': {text}}} END"


def oracle() -> str:
    """The rows of ``audits`` over damaged rows in DuckDB's SQL: from row to row the best way into each of the four states."""
    ascii_bytes = "list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    fold = "CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    whole, own, extra = "fault NOT IN (1, 2)", "role || ':' || text", f"CASE WHEN fault = 3 THEN {TRUNCATED} ELSE 0 END"
    keep = lambda state, initial: after(state, extra, "K", own, f"{whole} AND left(role, 1) = '{initial}'")
    rerole = lambda state, name: after(state, f"{REROLE} + {extra}", "R", f"'{name}:' || text", whole)
    dropped = [after(f"s{k}", str(DELETE), "D") for k in range(4)]
    due_user = ("s0", "s1", "s3")
    into = [
        dropped[0], best(dropped[1], keep("s0", "s")), best(dropped[2], *(f(s, x) for s in due_user for f, x in ((keep, "u"), (rerole, "user")))),
        best(dropped[3], keep("s2", "a"), rerole("s2", "assistant")),
    ]
    closed = f"n0 AS s0, n1 AS s1, {best('n2', *(after(s, str(INSERT), 'I', chr(39) + 'user:' + chr(39)) for s in ('n0', 'n1', 'n3')))} AS s2, n3"
    opened = f"s0, s1, s2, {best('n3', after('s2', str(INSERT), 'I', chr(39) + 'assistant:' + chr(39)))} AS s3"
    kind = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR)"
    strip = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"
    return f"""WITH RECURSIVE tbl AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: {fold}) AS c
 FROM (SELECT unnest(range(256)) AS i))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
 xor(list_reduce(list_prepend(4294967295, {ascii_bytes}), lambda a, b: xor(a >> 8, t[1 + xor(a, b) % 256])), 4294967295) % 20 AS kind FROM conversations, tbl),
hit AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
 CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again
 FROM keyed WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again) AS rn FROM hit),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) AS seen, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS before, {strip} AS stripped FROM placed),
marked AS (SELECT *, CASE WHEN stripped = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(stripped, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM ranked),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 1) AS blank, count_if(fault = 2) AS duplicate,
 count_if(fault = 3) AS truncated, count_if(before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY 1),
ids AS (SELECT DISTINCT conv_id FROM conversations),
st AS (SELECT conv_id, CAST(0 AS BIGINT) AS rn, CAST({{'c': 0, 'a': '', 'r': NULL}} AS {kind}) AS s0, CAST(NULL AS {kind}) AS s1,
 CAST({{'c': {INSERT}, 'a': 'I', 'r': 'user:'}} AS {kind}) AS s2, CAST({{'c': {2 * INSERT}, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS {kind}) AS s3 FROM ids
UNION ALL SELECT conv_id, rn, {opened} FROM (SELECT conv_id, rn, {closed} FROM (
 SELECT st.conv_id, m.rn, {', '.join(f'CAST({x} AS {kind}) AS n{k}' for k, x in enumerate(into))} FROM st JOIN marked m ON m.conv_id IS NOT DISTINCT FROM st.conv_id AND m.rn = st.rn + 1))),
ends AS (SELECT conv_id, {best('s0', 's3')} AS e FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY rn DESC) AS last FROM st) WHERE last = 1)
SELECT ends.conv_id, {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {c}' for c in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))}, e.c AS cost, e.a AS audit, sha256(coalesce(e.r, '')) AS repaired_sha256 FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id"""
