"""Business labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.text import blank_to_null, clean_text

UNKNOWN = "Unknown"
UNKNOWN_KEY = -1

# Codes of the product feed, and the wider set the segmentation accepts.
GENERIC_CODES = ("Y", "S")
BRANDED_CODES = ("N",)
GENERIC_WORDS = ("Y", "YES", "1", "TRUE", "GENERIC")

# Segment names and descriptions by rank.
SEGMENT_LABELS = {
    1: "High-value pharmacies",
    2: "Standard pharmacies",
    3: "Low-value pharmacies",
}
SEGMENT_DESCRIPTIONS = {
    1: "Pharmacies with the strongest sales volume, transaction activity and commercial intensity.",
    2: "Pharmacies with intermediate commercial behaviour and stable sales activity.",
    3: "Pharmacies with lower sales intensity or lower transaction activity.",
}
OTHER_SEGMENT = "Additional segment "
OTHER_DESCRIPTION = "Additional behavioural pharmacy segment."

# Places whose district the postal-code map cannot settle.
MANUAL_DISTRICTS = {
    "Angeja": "Aveiro",
    "Freguesia de São Pedro do Sul": "Viseu",
    "Malveira da Serra": "Lisboa",
    "Pardilhó": "Aveiro",
    "Quarteira": "Faro",
    "São João de Madeira": "Aveiro",
    "Sobral da Adiça": "Beja",
    "Vimeiro": "Leiria",
}
# The shorter list used by the segmentation, keyed by match_key().
MANUAL_DISTRICTS_BY_KEY = {
    "freguesia de sao pedro do sul": "Viseu",
    "malveira da serra": "Lisboa",
    "sao joao de madeira": "Aveiro",
    "vimeiro": "Lisboa",
}


def pick(key: Column, choices: dict, default: Column | None = None) -> Column:
    """Value of ``choices`` for a key, as one CASE expression."""
    if not choices:
        return F.lit(None).cast("string") if default is None else default
    chain = reduce(lambda w, kv: w.when(key == F.lit(kv[0]), F.lit(kv[1])), choices.items(), F)
    return chain if default is None else chain.otherwise(default)


def generic_label(raw: Column) -> Column:
    code = F.upper(clean_text(raw))
    return (
        F.when(code.isin(*GENERIC_CODES), "Generic").when(code.isin(*BRANDED_CODES), "Branded").otherwise(UNKNOWN)
    )


def is_generic_word(raw: Column) -> Column:
    return F.coalesce(F.upper(clean_text(raw)).isin(*GENERIC_WORDS), F.lit(False))


def product_type(raw: Column) -> Column:
    return F.when(is_generic_word(raw), "Generic").otherwise("Branded")


def settled_district(original: Column, mapped: Column, place: Column, manual: dict | None = None) -> Column:
    """District by priority: as given, from the map, by hand, else Unknown."""
    by_hand = pick(clean_text(place), MANUAL_DISTRICTS if manual is None else manual)
    return F.coalesce(blank_to_null(original), blank_to_null(mapped), by_hand, F.lit(UNKNOWN))


def segment_label(rank: Column) -> Column:
    return pick(rank, SEGMENT_LABELS, F.concat(F.lit(OTHER_SEGMENT), rank.cast("string")))


def segment_description(rank: Column) -> Column:
    return pick(rank, SEGMENT_DESCRIPTIONS, F.lit(OTHER_DESCRIPTION))
