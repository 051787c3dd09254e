"""Column expressions: roles, patches, rune keys, rates and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laneforge.sources.schemas import PLATFORMS, ROLES


def as_int(value: Column) -> Column:
    return value.try_cast("int")


def as_long(value: Column) -> Column:
    return value.try_cast("bigint")


def sealed(payload: Column) -> tuple[Column, Column]:
    """A payload as the first of an array's two values, and the other, a hash of the payload.

    A text that goes on after its first document either makes the array longer or broken, or closes it before
    the hash, which it can't hold itself. So what parses to just these two values is one whole document.
    """
    seal = F.hex(F.xxhash64(payload))
    return seal, F.concat(F.lit("["), payload, F.lit(',{"_seal":"'), seal, F.lit('"}]'))


def valid_json(payload: Column) -> Column:
    """True for one JSON document; false for null, broken text, or text that goes on after it."""
    seal, both = sealed(payload)
    parsed = F.try_parse_json(both)
    last = F.try_variant_get(parsed, "$[1]._seal", "string")
    return F.coalesce((last == seal) & F.try_variant_get(parsed, "$[2]", "variant").isNull(), F.lit(False))


def parsed_json(payload: Column, schema: str) -> tuple[Column, Column, Column]:
    """A payload's struct of ``schema`` (``name: type`` fields) from one parse: the array to select first, and of a column ``both`` of it the struct and its validity.

    A document of another shape than a struct is valid too, and has a null struct.
    """
    seal, both = sealed(payload)
    array = F.from_json(both, f"ARRAY<STRUCT<{schema}, _seal: STRING>>")
    held = (F.size("both") == 2) & (F.get("both", F.lit(1))["_seal"] == seal)
    valid = F.when(F.coalesce(held, F.lit(False)), F.lit(True)).otherwise(valid_json(payload))
    return array, F.when(held, F.get("both", F.lit(0)).dropFields("_seal")), valid


def typed_json(payload: Column, schema: str, typed: str) -> tuple[Column, Column, Column]:
    """``parsed_json`` with numbers read as such: the struct is of ``typed``, which is ``schema`` with the types of fields that are read by ``try_cast`` alone.

    A number that is parsed as a string costs a generator of its own. So a payload is parsed to numbers first, between two seals; the few that
    hold a number in another spelling, or are broken, are parsed to strings and cast, so that both ways give the same. Of a name that comes
    twice the last stands, so a text that closes the array and opens another has lost one of its seals.
    """
    seal = F.hex(F.xxhash64(payload))
    end = F.concat(F.lit('{"_seal":"'), seal, F.lit('"}'))
    both = F.concat(F.lit('{"both":['), end, F.lit(","), payload, F.lit(","), end, F.lit("]}"))
    read = F.from_json(both, f"STRUCT<both: ARRAY<STRUCT<{typed}, _seal: STRING>>, _bad: STRING>", {"columnNameOfCorruptRecord": "_bad"})
    at = lambda k: F.get("both.both", F.lit(k))
    held = F.col("both._bad").isNull() & (F.size("both.both") == 3) & (at(0)["_seal"] == seal) & (at(2)["_seal"] == seal)
    held = F.coalesce(held, F.lit(False))
    array, _, _ = parsed_json(payload, schema)
    whole = lambda strings: (F.size(strings) == 2) & (F.get(strings, F.lit(1))["_seal"] == seal)
    once = lambda of: F.get(F.transform(F.array(array), of), F.lit(0))  # noqa: E731  an array of one array, so that it is made once
    strings = once(lambda x: F.when(whole(x), F.get(x, F.lit(0)).dropFields("_seal")))
    doc = F.when(held, at(1).dropFields("_seal")).otherwise(strings.try_cast(f"STRUCT<{typed}>"))
    valid = F.when(held, F.lit(True)).when(once(lambda x: F.coalesce(whole(x), F.lit(False))), F.lit(True)).otherwise(valid_json(payload))
    return read, doc, valid


def normal_role(team_position: Column, individual_position: Column) -> Column:
    """The assigned position, or where it is empty the detected one, under its published name."""
    chosen = F.coalesce(F.nullif(team_position, F.lit("")), individual_position)
    return (
        F.when(chosen == "TOP", "TOP").when(chosen == "JUNGLE", "JUNGLE").when(chosen.isin("MIDDLE", "MID"), "MID")
        .when(chosen.isin("BOTTOM", "ADC"), "BOTTOM").when(chosen.isin("UTILITY", "SUPPORT"), "SUPPORT")
    )


def two_parts(version: Column) -> Column:
    return F.concat_ws(".", F.split_part(version, F.lit("."), F.lit(1)), F.split_part(version, F.lit("."), F.lit(2)))


def patch_of(version: Column) -> Column:
    """The first two components of a version; null where there are not two."""
    return F.when(F.instr(version, ".") > 0, two_parts(version))


def patch_order(patch: Column) -> Column:
    """A patch's components as numbers, for ordering."""
    return F.transform(F.split(patch, r"\."), lambda x: as_int(x))


def valid_patch(patch: Column) -> Column:
    return F.coalesce(patch.rlike(r"^[0-9]+\.[0-9]+$"), F.lit(False))


def minute_of(timestamp_ms: Column) -> Column:
    return F.floor(timestamp_ms / F.lit(60000.0)).cast("int")


def epoch_ms(ts: Column, zoned: bool = False) -> Column:
    """Milliseconds from 1970 on to a point in time (``zoned``) or to a time without a zone, whatever the session's zone; rounded, halves away from zero."""
    if zoned:
        micros = F.unix_micros(ts)
    else:
        day, second = F.unix_date(ts.cast("date")).cast("bigint"), F.extract(F.lit("SECOND"), ts)
        micros = ((day * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60_000_000 + (second * 1_000_000).cast("bigint")
    return (F.round(micros, -3) / 1000).cast("bigint")


def rune_key(perks: Column) -> Column:
    """Primary tree, keystone, secondary tree and three shards; null unless the page is in order."""
    style = lambda k: F.get(perks["styles"], F.lit(k))
    perk = lambda k, j: as_int(F.get(style(k)["selections"], F.lit(j))["perk"])
    head = (as_int(style(0)["style"]), perk(0, 0), as_int(style(1)["style"]))
    stats = tuple(perks["statPerks"][n] for n in ("offense", "flex", "defense"))
    third = tuple(F.get(style(2)["selections"], F.lit(j))["perk"] for j in range(3))
    in_order = (style(0)["description"] == "primaryStyle") & (style(1)["description"] == "subStyle")
    there = lambda values: values[0].isNotNull() & values[1].isNotNull() & values[2].isNotNull()
    return F.when(in_order & there(stats), F.array(*head, *map(as_int, stats))).when(
        in_order & style(2)["description"].isin("statMods", "statMod") & there(third), F.array(*head, *map(as_int, third))
    )


def platforms_of(region: str | None, platform: str | None = None) -> list[str]:
    """The names that a region's matches may carry: the region's own and its platform's."""
    region, platform = (region or "").strip().upper(), (platform or "").strip().upper()
    names = [region, platform or PLATFORMS.get(region, region)]
    return list(dict.fromkeys(n for n in names if n))


def round4(value: Column) -> Column:
    return F.round(value * 10000) / 10000


def ci95(n: Column) -> Column:
    """Half the width of a 95 % interval of a rate near one half."""
    return round4(F.lit(0.98) / F.sqrt(n.cast("double")))


# Tiers and the least lead over the baseline, in percentage points.
TIERS = (("S+", 2.0), ("S", 1.2), ("A", 0.6), ("B", -0.6), ("C", -1.5))


def tier_of(rate: Column, baseline: Column) -> Column:
    """The tier of a rate that has not been rounded."""
    lead = (rate - baseline) * 100
    out = F.when(lead >= TIERS[0][1], TIERS[0][0])
    for name, least in TIERS[1:]:
        out = out.when(lead >= least, name)
    return out.otherwise("D")


def role_rank(role: Column) -> Column:
    return F.array_position(F.array(*(F.lit(r) for r in ROLES)), role)


def slug(key: Column) -> Column:
    return F.regexp_replace(F.lower(key), "[^a-z0-9]", "")
