"""Line-first quality rules in built-in functions.

Each line with a word is held against punctuation, navigation and boilerplate rules: symbols, menus in one line or with an entry a
line, addresses, and phrases of sites in four languages. Lines that fail are taken out of the text, and a document that loses too much of its text is rejected, as
is one that is too short or repeats itself too much.

Defined cases: a null or blank text has no words and is rejected for its length. Lines without a
word neither count nor fail. Repeated rows and null ids are kept as they are; each row is
judged by its own text only. An empty table gives an empty result. Columns of the input other
than those named here pass through ``clean`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneforge.llm.common import WORD, unused

SYMBOL = r"[#*$%&|<>]"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
#: Characters that part the entries of a menu when they stand alone.
SEPARATOR = r"(?:\A|[\x20\x09-\x0D])[|>/\x{BB}\x{203A}\x{B7}\x{2022}](?:[\x20\x09-\x0D]|\z)"
# Phrases of sites rather than of texts, by language; each stands at the start of a word.
PHRASES = {
    "en": r"all rights reserved|cookies? policy|uses? cookies|privacy policy|terms of (?:use|service)|(?:enable|requires?) javascript|click here|sign up (?:now|today|for)|"
    r"subscribe (?:now|to)|share (?:this|on)|lorem ipsum|powered by|skip to (?:main )?content|back to top",
    "fr": r"tous droits r[éÉ]serv[éÉ]s|politique de (?:confidentialit[éÉ]|cookies)|conditions d['’]utilisation|mentions l[éÉ]gales|utilise des cookies|activer javascript|cliquez ici|"
    r"inscrivez[- ]vous|abonnez[- ]vous|partager (?:cet article|sur)|propuls[éÉ] par|aller au contenu|retour en haut",
    "de": r"alle rechte vorbehalten|datenschutzerkl[äÄ]rung|nutzungsbedingungen|impressum|verwendet cookies|cookie[- ]richtlinie|javascript aktivieren|(?:hier klicken|klicken sie hier)|"
    r"jetzt (?:anmelden|abonnieren|registrieren)|newsletter abonnieren|teilen auf|zum inhalt springen|zum seitenanfang",
    "es": r"todos los derechos reservados|pol[íÍ]tica de (?:privacidad|cookies)|t[éÉ]rminos (?:de uso|y condiciones)|aviso legal|utiliza(?:mos)? cookies|habilit[ae]r? javascript|ha[gz]a? clic aqu[íÍ]|"
    r"reg[íÍ]strate|suscr[íÍ]bete|compartir (?:en|este)|saltar al contenido|volver arriba",
}
BOILERPLATE = r"(?i)(?:\A|[\x20\x09-\x0D(])(?:" + "|".join(PHRASES.values()) + ")"
#: An address of the web, as the start of a word.
ADDRESS = r"(?i)(?:\A|[\x20\x09-\x0D(<])(?:https?://|www\.)"
#: What ends a sentence or leads on to the next line.
END = r"[.!?…:;,。！？][\x20\x09-\x0D\x22'”»)\]]*\z"
#: A line of so few words without such an end is an entry; a menu has this many of them one after the other.
ENTRY_WORDS, MENU_ENTRIES = 3, 4
MIN_WORDS = 50
#: Percent of the words that may stand in repeated windows.
MAX_REPEATED = 50
#: A line of this many words or more is held against the punctuation rule.
PUNCTUATION_WORDS = 8
#: Boilerplate phrases condemn lines of at most this many words.
BOILERPLATE_WORDS = 25
#: Percent of the word characters that a document may lose with its failed lines.
MAX_LOST = 30


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def word_chars(text: Column) -> Column:
    """Code points that belong to words."""
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def line_fails(line: Column) -> Column:
    """True where a line is symbols rather than prose, a menu in one line, addresses, or boilerplate."""
    words = n_words(line)
    noisy = (words >= PUNCTUATION_WORDS) & (2 * F.regexp_count(line, F.lit(PUNCTUATION)) > words)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    menu = (separators >= 3) & (4 * separators >= words)
    links = (words <= BOILERPLATE_WORDS) & (2 * F.regexp_count(line, F.lit(ADDRESS)) >= words)
    boilerplate = (words <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
    return noisy | menu | links | boilerplate


def is_entry(line: Column) -> Column:
    """True for a few words that no mark ends."""
    return (n_words(line) <= ENTRY_WORDS) & ~line.rlike(END)


def in_menu(entries: Column, i: Column) -> Column:
    """True where a line is one of ``MENU_ENTRIES`` or more entries in a row: one of the stretches of that many around it is all entries."""
    at = lambda k: F.coalesce(F.get(entries, i + k), F.lit(False))
    out = F.lit(False)
    for first in range(1 - MENU_ENTRIES, 1):
        whole = F.lit(True)
        for k in range(first, first + MENU_ENTRIES):
            whole = whole & at(k)
        out = out | whole
    return out


def good_lines(lines: Column) -> Column:
    """The lines that neither fail by themselves nor are entries of a menu."""
    alone = F.filter(lines, lambda x: ~line_fails(x))
    some = F.size(F.filter(lines, is_entry)) >= MENU_ENTRIES  # most texts have few entries or none
    both = bind_array(F.transform(lines, is_entry), lambda e: F.filter(lines, lambda x, i: ~line_fails(x) & ~in_menu(e, i)))
    return F.when(some, both).otherwise(alone)


def repeated_words(words: Column) -> Column:
    """How many words of an array stand in three-word windows that occur twice or more in it.

    Most texts repeat no window; a hash of each tells so. The others sort their windows, mark
    those equal to a neighbour and add up what the marked positions cover.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(windows: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(windows) - 1)
        text = lambda i: F.get(windows, i)["w"]
        same = F.filter(at, lambda i: F.coalesce(text(i) == text(i - 1), F.lit(False)) | F.coalesce(text(i) == text(i + 1), F.lit(False)))
        return bind(
            F.array_sort(F.transform(same, lambda i: F.get(windows, i)["i"])),
            lambda p: F.aggregate(
                F.sequence(F.lit(0), F.size(p) - 1),
                F.lit(0).cast("long"),
                lambda total, k: total + F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(3))),
            ),
            F.size(same) > 0,
        )

    windows = F.sort_array(
        F.transform(
            starts,
            lambda i: F.struct(
                F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")
            ),
        )
    )
    some = bind(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) < 4, 0).when(some, bind(windows, covered)).otherwise(0).cast("long")


def bind(value: Column, use, when: Column | None = None) -> Column:
    """``use(value)`` with ``value`` computed once for a row, zero or null where ``when`` is false."""
    out = F.get(F.transform(F.array(value), use), F.lit(0))
    return out if when is None else F.when(when, out).otherwise(F.lit(0).cast("long"))


def bind_array(value: Column, use) -> Column:
    """``use(value)``, an array, with ``value`` computed once for a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(docs: DataFrame, name: str, **values: Column) -> DataFrame:
    """``docs`` with a struct ``name`` of the values, which no later filter or projection computes again."""
    return docs.withColumn(name, F.explode(F.array(F.struct(*(v.alias(k) for k, v in values.items())))))


def judged(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a struct ``name`` of counts, verdicts and the cleaned text."""
    body = F.coalesce(F.col(text), F.lit(""))
    q = lambda field: F.col(name)[field]
    step = once(docs, name, body=body, lines=F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)), words=F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
    step = once(
        step, name,
        n_words=F.size(q("words")).cast("long"), word_chars=F.length(F.array_join(q("words"), "")).cast("long"), n_repeat_words=bind(q("words"), repeated_words),
        n_symbols=F.regexp_count(q("body"), F.lit(SYMBOL)).cast("long"), n_dup_lines=(F.size(q("lines")) - F.size(F.array_distinct(q("lines")))).cast("long"),
        kept_lines=good_lines(q("lines")), n_lines=F.size(q("lines")),
    )
    n, chars, repeated = q("n_words"), q("word_chars"), q("n_repeat_words")
    kept_text = F.array_join(q("kept_lines"), "\n")
    base_failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n)
    whole = F.size(q("kept_lines")) == q("n_lines")
    lost = F.when(whole, 0).otherwise(chars - word_chars(kept_text)).cast("long")
    return once(
        step, name,
        **{c: q(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}, base_failed=base_failed,
        n_failed_lines=(q("n_lines") - F.size(q("kept_lines"))).cast("long"), lost_chars=lost, kept=~base_failed & (100 * lost <= MAX_LOST * chars), clean_text=kept_text,
    )


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, without their failed lines, in the columns of ``docs``."""
    name = unused(docs, "quality")
    q = F.col(name)
    out = judged(docs, name, text).where(q["kept"])
    cleaned = F.when(q["n_failed_lines"] > 0, q["clean_text"]).otherwise(F.col(text))
    return out.select(*(cleaned.alias(c) if c == text else F.col(c) for c in docs.columns))


def verdicts(docs: DataFrame) -> DataFrame:
    """Counts and verdicts by document."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_failed_lines", "lost_chars")
    return judged(docs.select("doc_id", "text"), "quality").select("doc_id", *(F.col("quality")[c].alias(c) for c in names))


def oracle() -> str:
    """The rows of ``verdicts`` in DuckDB's SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    count = lambda value, pattern: f"len(regexp_extract_all({value}, {quote(pattern)}))"
    words = count("x", WORD)
    fails = (
        f"(({words} >= {PUNCTUATION_WORDS} AND 2 * {count('x', PUNCTUATION)} > {words}) OR ({count('x', SEPARATOR)} >= 3 AND 4 * {count('x', SEPARATOR)} >= {words})"
        f" OR ({words} <= {BOILERPLATE_WORDS} AND (2 * {count('x', ADDRESS)} >= {words} OR regexp_matches(x, {quote(BOILERPLATE)}))))"
    )
    entry = f"({words} <= {ENTRY_WORDS} AND NOT regexp_matches(x, {quote(END)}))"
    at = lambda k: f"(i + {k} >= 1 AND coalesce(es[i + {k}], false))"
    menu = " OR ".join("(" + " AND ".join(at(k) for k in range(first, first + MENU_ENTRIES)) + ")" for first in range(1 - MENU_ENTRIES, 1))
    chars = lambda value: f"len(regexp_replace({value}, '[\\x20\\x09-\\x0D]+', '', 'g'))"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, {quote(WORD)}) AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {quote(WORD)})) AS ls FROM d),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY 1),
k AS (SELECT r, doc_id, t, len(ws) AS n_words, {chars('t')} AS word_chars, {count('t', SYMBOL)} AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines, list_filter(ls, lambda x, i: NOT {fails} AND NOT ({menu})) AS good FROM (SELECT *, list_transform(ls, lambda x: {entry}) AS es FROM w)),
v AS (SELECT k.*, coalesce(cov.n, 0) AS n_repeat_words, word_chars - {chars("array_to_string(good, chr(10))")} AS lost_chars FROM k LEFT JOIN cov USING (r)),
z AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * lost_chars <= {MAX_LOST} * word_chars AS kept, n_lines - len(good) AS n_failed_lines, lost_chars FROM z"""
