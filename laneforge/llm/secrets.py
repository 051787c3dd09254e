"""Secret scans with a trigram inverted index, in DataFrame operations.

Each rule is an expression. From it follows a Boolean query of trigrams that any match must hold: an
OR of ANDs, read off the expression's parse. The index has a posting (trigram, row) for each trigram
that some query asks for; the queries intersect postings by equality join and count, and only
the rows that satisfy a rule's query are searched with its expression. Rules without a
mandatory trigram search all rows.

Spans count code points, end exclusive, leftmost and not overlapping within a kind. The base kinds
``assign``, ``access`` and ``hex`` come first; the others are this method's own.

Defined cases: a null text counts as empty and has no spans; redaction leaves it null. Texts are
searched whole. Rows repeat and ids may be null: rows are told apart by their address in the table, which
is the same at every read; ``is_table`` says that ``docs`` is a plain read of one, else it is stored first. An
empty table gives an empty result. Other columns pass through ``redact``.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as parser
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laneforge.llm.common import addressed, saved, unused


class Rule(NamedTuple):
    kind: str
    pattern: str
    #: Least length of ``group``; shorter matches are dropped after matching.
    group: int
    least: int


# The base's kinds.
BASE = (
    Rule("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
RULES = (
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("github_fine", r"github_pat_[A-Za-z0-9_]+", 0, 60),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]+", 0, 26),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("npm", r"npm_[A-Za-z0-9]+", 0, 40),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]+", 0, 50),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
    Rule("url_password", r"[a-z]+://[A-Za-z0-9_.%-]+:[A-Za-z0-9_.%!*+-]+@", 0, 8),
    Rule("bearer", r"[bB]earer\x20+[A-Za-z0-9._~+/-]+", 0, 23),
)

#: Alternatives that the reading of an expression keeps track of.
MOST = 64


# ---- from expressions to trigram queries --------------------------------------------------


def alternatives(op, value) -> set[str] | None:
    """The strings in lower case that an element matches, or None where they are too many to list."""
    if op is ops.LITERAL:
        return {chr(value).lower()}
    if op is ops.IN and all(o is ops.LITERAL for o, _ in value):
        return {chr(v).lower() for _, v in value} if len(value) <= 6 else None
    if op is ops.SUBPATTERN:
        return joined(value[3])
    if op is ops.BRANCH:
        parts = [joined(branch) for branch in value[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op is ops.MAX_REPEAT and value[:2] == (0, 1):
        inner = joined(value[2])
        return inner | {""} if inner is not None else None
    if op is ops.MAX_REPEAT and value[0] == value[1] and value[0] <= 8:
        inner = joined(value[2])
        return {"".join(x) for x in product(inner, repeat=value[0])} if inner is not None and len(inner) ** value[0] <= MOST else None
    return None


def joined(sequence) -> set[str] | None:
    found = {""}
    for op, value in sequence:
        next_ = alternatives(op, value)
        if next_ is None or len(found) * len(next_) > MOST:
            return None
        found = {a + b for a in found for b in next_}
    return found


def needed(sequence) -> list[set[str]]:
    """Sets of strings of which each match holds one, for every set: what stands between long classes."""
    sets, run = [], {""}
    for op, value in [*sequence, (None, None)]:
        next_ = alternatives(op, value) if op else None
        if next_ is not None and len(run) * len(next_) <= MOST:
            run = {a + b for a in run for b in next_}
            continue
        sets.append(run)
        run = next_ if next_ is not None else {""}
        if op is ops.SUBPATTERN and next_ is None:
            sets += needed(value[3])
        elif op is ops.MAX_REPEAT and value[0] > 0 and next_ is None:
            sets += needed(value[2])
    return [s for s in sets if all(len(x) >= 3 for x in s)]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """An OR of ANDs of lower-case trigrams that any match satisfies; empty if none is mandatory."""
    sets = sorted(needed(parser.parse(pattern)), key=len)
    ways: list[frozenset[str]] = [frozenset()]
    for s in sets:
        if len(ways) * len(s) <= MOST:
            ways = [w | {x[i : i + 3] for i in range(len(x) - 2)} for w in ways for x in sorted(s)]
    return sorted({w for w in ways if not any(v < w for v in ways)}, key=sorted) if sets else []


def one_of(trigrams: list[str]) -> str:
    """An expression for any of the trigrams, branching by first character."""
    quote = lambda x: "".join(c if c.isalnum() or c == "_" else f"\\x{ord(c):02X}" for c in x)
    heads: dict[str, list[str]] = {}
    for t in trigrams:
        heads.setdefault(t[0], []).append(t[1:])
    return "|".join(f"{quote(h)}(?:{'|'.join(map(quote, sorted(tails)))})" for h, tails in sorted(heads.items()))


# ---- index, candidates, verification -----------------------------------------------------


def postings(told: DataFrame, keys: list[str], trigrams: list[str], text: str = "text") -> DataFrame:
    """``trigram`` and a row's address for the trigrams of a list that the row's text holds, in any case."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?=({one_of(trigrams)}))"), F.lit(1)))
    return told.select(*keys, F.explode(found).alias("trigram"))


def candidates(told: DataFrame, keys: list[str], rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """A row's address and ``_rules``, the numbers of the rules whose trigram query the row satisfies."""
    terms = [(t, n, k, len(way)) for n, r in enumerate(rules) for k, way in enumerate(trigram_query(r.pattern)) for t in sorted(way)]
    index = postings(told, keys, sorted({t for t, *_ in terms}), text)
    literal = F.array(*(F.struct(F.lit(t).alias("trigram"), F.lit(n).alias("rule"), F.lit(k).alias("way"), F.lit(size).alias("need")) for t, n, k, size in terms))
    asked = told.sparkSession.range(1).select(F.inline(literal))  # as many rows as the rules have trigrams
    met = index.join(F.broadcast(asked), "trigram").groupBy(*keys, "rule", "way", "need").count().where(F.col("count") == F.col("need"))
    return met.groupBy(*keys).agg(F.collect_set("rule").alias("_rules"))


def applies(n: int, rule: Rule) -> Column:
    if not trigram_query(rule.pattern):
        return F.lit(True)
    return F.coalesce(F.array_contains("_rules", n), F.lit(False))


def quick(rule: Rule) -> str:
    """An expression that a text with a match that is kept satisfies; for a plain run, of the least length."""
    return rule.pattern[:-1] + f"{{{rule.least},}}" if rule.pattern == "[0-9a-f]+" else rule.pattern


def matches(told: DataFrame, keys: list[str], rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The address, ``rule``, ``start`` and ``end`` of every match that is kept, of rows with the address ``keys``.

    The pieces that an expression's matches part a text into tell where the matches lie.
    """
    texts = told.select(*keys, F.col(text).alias("_text"))
    small = texts.join(saved(candidates(texts, keys, rules, "_text")), keys, "left")
    body = F.col("_text")

    def of(n: int, rule: Rule) -> Column:
        pattern = quick(rule)
        parts = F.struct(F.split(body, pattern).alias("gaps"), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("found"), F.regexp_extract_all(body, F.lit(pattern), F.lit(rule.group)).alias("checked"))
        listed = F.get(F.transform(F.array(parts), lambda p: F.transform(p["found"], lambda m, i: F.struct(
            F.lit(n).alias("rule"), i.alias("at"), F.length(F.get(p["gaps"], i)).alias("gap"), F.length(m).alias("size"), (F.length(F.get(p["checked"], i)) >= rule.least).alias("kept"),
        ))), F.lit(0))
        return F.when(applies(n, rule) & body.rlike(pattern), listed)

    none = F.array().cast("array<struct<rule:int,at:int,gap:int,size:int,kept:boolean>>")
    every = F.flatten(F.array(*(F.coalesce(of(n, r), none) for n, r in enumerate(rules))))
    rows = small.select(*keys, F.explode(every).alias("m")).select(*keys, "m.*")
    run = Window.partitionBy(*keys, "rule").orderBy("at")
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(run)).where("kept")
    return placed.select(*keys, "rule", (F.col("end") - F.col("size")).alias("start"), "end")


def listed(told: DataFrame, keys: list[str], rules: tuple[Rule, ...], text: str, name: str) -> DataFrame:
    """The address of each row with matches, and these as structs of start, rule and end, in order."""
    return matches(told, keys, rules, text).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "rule", "end"))).alias(name))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", is_table: bool = False) -> DataFrame:
    """The rows of ``docs`` without their text, with ``found``, in place of a column of that name: structs of start, rule and end, in order."""
    told, keys = addressed(docs, is_table)
    names = [c for c in docs.columns if c not in (text, "found")]
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>")
    held = told.select(*names, *keys).join(listed(told, keys, rules, text, "found"), keys, "left")
    return held.select(*names, F.coalesce("found", none).alias("found"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", is_table: bool = False) -> DataFrame:
    """``docs`` with each secret replaced by ``[kind]``; spans that overlap are replaced as one."""
    told, keys = addressed(docs, is_table)
    found = unused(told, "found")
    held = told.join(listed(told, keys, rules, text, found), keys, "left")
    kinds = F.array(*(F.lit(f"[{r.kind}]") for r in rules))
    body = F.col(text)
    part = lambda start, end: F.substring(body, start + 1, end - start)
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["upto"]
        more = F.concat(done["out"], part(done["upto"].cast("int"), s["start"].cast("int")), F.get(kinds, s["rule"]))
        return F.struct(F.greatest(done["upto"], s["end"]).alias("upto"), F.when(fresh, more).otherwise(done["out"]).alias("out"))

    put = F.aggregate(found, start, step, lambda done: F.concat(done["out"], part(done["upto"].cast("int"), F.length(body))))
    names = docs.columns
    return held.withColumn(text, F.when(F.col(found).isNotNull(), put).otherwise(body)).select(*names)


def span_text(found: Column) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in RULES))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def found_secrets(docs: DataFrame) -> DataFrame:
    """Counts, spans and their digest by document of a stored table."""
    out = scan(docs.select("doc_id", "text"), is_table=True)
    count = lambda n: F.size(F.filter("found", lambda s: s["rule"] == n)).cast("long")
    base = F.filter("found", lambda s: s["rule"] < len(BASE))
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))


def oracle() -> str:
    """The rows of ``found_secrets`` in DuckDB's SQL, each rule over all texts."""
    parts = []
    for n, rule in enumerate(RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        parts.append(
            f"SELECT r, {n} AS rule, '{rule.kind}' AS kind, i, len(gaps[i]) AS gap, len(ms[i]) AS size, len(cs[i]) >= {rule.least} AS kept FROM (SELECT r, string_split_regex(t, {pattern}) AS gaps, "
            f"regexp_extract_all(t, {pattern}, 0) AS ms, regexp_extract_all(t, {pattern}, {rule.group}) AS cs FROM d WHERE regexp_matches(t, {pattern})), unnest(range(1, len(ms) + 1)) AS u(i)"
        )
    listed = lambda rule: f"coalesce(string_agg(kind || ':' || (e - size) || ':' || e, ',' ORDER BY e - size, rule){rule}, '')"
    base = f"rule < {len(BASE)}"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
p AS (SELECT * FROM (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY r, rule ORDER BY i) AS BIGINT) AS e FROM m) WHERE kept)
SELECT doc_id, count(*) FILTER (WHERE rule = 0) AS n_assign, count(*) FILTER (WHERE rule = 1) AS n_access, count(*) FILTER (WHERE rule = 2) AS n_hex,
sha256({listed(f' FILTER (WHERE {base})')}) AS base_sha256, {listed('')} AS spans FROM d LEFT JOIN p USING (r) GROUP BY d.r, doc_id"""
