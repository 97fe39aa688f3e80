"""Cleaning of free-text destinations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewake.functions.binding import bind

# Port codes, in the order in which combined texts are searched.
PORT_CODES = {
    "NLRTM": "ROTTERDAM",
    "NLAMS": "AMSTERDAM",
    "NLVLI": "VLISSINGEN",
    "BEANR": "ANTWERP",
    "GBLGP": "LONDON",
    "GBHRW": "HARWICH",
    "DEHAM": "HAMBURG",
    "DECUX": "CUXHAVEN",
    "DKSKA": "SKAGEN",
    "DEBRV": "BREMERHAVEN",
    "BEZEE": "ZEEBRUGGE",
    "NLTNZ": "TERNEUZEN",
    "ANT": "ANTWERP",
    "CUX": "CUXHAVEN",
}

# Fixed values: (pattern, replacement) corrections, applied one after the other.
CORRECTIONS = [
    (r"^ROT+EDAM$", "ROTTERDAM"),
    (r"^NLROTTERDAM$", "ROTTERDAM"),
    (r"^ROTTERDAM.*$", "ROTTERDAM"),
    (r"^AMS$", "AMSTERDAM"),
    (r"^AMSTERD[A-Z]*$", "AMSTERDAM"),
    (r"^VLISS?INGEN$", "VLISSINGEN"),
    (r"^LIVERPOOLTUGOPS$", "LIVERPOOL"),
    (r"^HARBOURTOWAGE$", "HARBOURTUG"),
    (r"^FISHINGGROUNDS?$", "FISHING"),
    (r"^FISHGORUND$", "FISHING"),
    (r"^0OSTENDE$", "OOSTENDE"),
    (r"^0$", ""),
    (r"^GBLGP.*$", "LONDON"),
    (r"^GBHRW.*$", "HARWICH"),
    (r"^DEHAM.*$", "HAMBURG"),
    (r"^BERGENMOBERGEN$", "BERGEN"),
    (r"^ANTWERPEN$", "ANTWERP"),
    (r"^ROTTHULLROTT$", "ROTTERDAM"),
    (r"^ROTTHULL$", "ROTTERDAM"),
    (r"^HULLROTT$", "HULL"),
]

# The shorter lists of the exploratory profile.
PROFILE_CODES = {
    "NLRTM": "ROTTERDAM",
    "NLAMS": "AMSTERDAM",
    "NLVLI": "VLISSINGEN",
    "BEANR": "ANTWERP",
}
PROFILE_CORRECTIONS = [
    (r"^ROT+EDAM$", "ROTTERDAM"),
    (r"^NLROTTERDAM$", "ROTTERDAM"),
    (r"^ROTTERDAM.*$", "ROTTERDAM"),
    (r"^AMS$", "AMSTERDAM"),
    (r"^AMSTERD[A-Z]*$", "AMSTERDAM"),
    (r"^VLISS?INGEN$", "VLISSINGEN"),
    (r"^LIVERPOOLTUGOPS$", "LIVERPOOL"),
    (r"^HARBOURTOWAGE$", "HARBOURTUG"),
    (r"^FISHINGGROUNDS?$", "FISHING"),
    (r"^0OSTENDE$", "OOSTENDE"),
    (r"^0$", ""),
]


def clean_destination(text: Column) -> Column:
    """Upper case with everything but letters A-Z and digits removed."""
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def map_codes(text: Column, codes: Mapping[str, str] = PORT_CODES) -> Column:
    """Replace a value that equals a code by its name; keep other values."""
    pairs = [F.lit(part) for pair in codes.items() for part in pair]
    return bind(text, lambda t: F.coalesce(F.try_element_at(F.create_map(*pairs), t), t))


def apply_rules(text: Column, rules: Sequence[tuple[str, str]] = tuple(CORRECTIONS)) -> Column:
    """Apply the corrections in order, each to the result of the one before.

    Most texts match no pattern. One combined test lets those skip the chain:
    a text that matches none of the patterns cannot be changed by any of them.
    """
    if all(pattern.startswith("^") for pattern, _ in rules):
        any_pattern = "^(?:" + "|".join(pattern[1:] for pattern, _ in rules) + ")"
    else:
        any_pattern = "|".join(f"(?:{pattern})" for pattern, _ in rules)

    def corrected(t: Column) -> Column:
        fixed = t
        for pattern, replacement in rules:
            fixed = F.regexp_replace(fixed, pattern, replacement)
        return F.when(t.rlike(any_pattern), fixed).otherwise(t)

    return bind(text, corrected)


def split_destination(text: Column, codes: Mapping[str, str] = PORT_CODES) -> Column:
    """Struct of the primary and the secondary port of a text that may name two ports.

    Only texts longer than five characters are split. A text with both ROTT and
    HULL is the Rotterdam-Hull ferry. Otherwise the first listed code inside the
    text whose name differs from the text gives the primary port. Every code up
    to that one, with itself cut out of the text, may find a secondary port: the
    first listed code in the rest; the last one found counts.
    """
    listed = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).alias("name")) for c, n in codes.items()])
    def by_codes(t: Column) -> Column:
        def found(hit: Column) -> Column:
            rest = F.replace(t, hit["code"], F.lit(""))
            return F.get(F.filter(listed, lambda c: F.contains(rest, c["code"])), 0)["name"]

        def walk(hits: Column) -> Column:
            stop = F.array_position(F.transform(hits, lambda c: c["name"] != t), True).cast("int")
            walked = F.when(stop > 0, F.slice(hits, 1, F.greatest(stop, F.lit(1)))).otherwise(hits)
            secondary = F.aggregate(walked, F.lit(None).cast("string"), lambda kept, hit: F.coalesce(found(hit), kept))
            primary = F.when(stop > 0, F.get(hits, stop - 1)["name"]).otherwise(t)
            return F.struct(primary.alias("primary"), secondary.alias("secondary"))

        return bind(F.filter(listed, lambda c: F.contains(t, c["code"])), walk)

    def split(t: Column) -> Column:
        def ports(primary: Column, secondary: Column) -> Column:
            return F.struct(primary.alias("primary"), secondary.alias("secondary"))

        none = F.lit(None).cast("string")
        return (
            F.when(F.length(t) <= 5, ports(t, none))
            .when(t.contains("ROTT") & t.contains("HULL"), ports(F.lit("ROTTERDAM"), F.lit("HULL")))
            .when(reduce(or_, [t.contains(code) for code in codes]), by_codes(t))
            .otherwise(ports(t, none))
        )

    return bind(text, split)
