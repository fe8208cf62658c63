"""Address and code strings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Street suffixes that are no acronyms, and the patterns of a mailbox, an acronym and a one-line address.
STREET_SUFFIXES = ("ST", "AVE", "BLVD", "RD", "DR", "LN", "CT")
MAILBOX = r"(?i)PO Box|P O Box"
MAILBOX_IN_CAPITALS = r"PO BOX"
ACRONYM = r"^[A-Z](\.[A-Z])+\.?$"
ONE_LINE_ADDRESS = r"^(.*?),\s*(.*?,\s*)?(.*),\s*([A-Z]{2})\s*(\d{5}(?:-\d{4})?)$"
#: The states, and the district and territories that count with them.
STATES = tuple("AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY".split())
TERRITORIES = ("DC", "PR", "VI", "GU", "MP", "FM")


def normalise_address(x: Column) -> Column:
    """Lower case, one blank after commas, no characters but a-z, 0-9, commas and blanks, blanks folded."""
    x = F.regexp_replace(F.lower(x), r"\s*,\s*", ", ")
    x = F.regexp_replace(x, r"[^a-z0-9, ]", "")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def or_none_given(x: Column) -> Column:
    return F.coalesce(x, F.lit("None Given"))


def is_mailbox(x: Column) -> Column:
    return F.coalesce(x.rlike(MAILBOX), F.lit(False))


def strip_prefix(x: Column, prefix: str) -> Column:
    return F.regexp_replace(x, f"^{prefix}", "")


def pad_zip(zip_: Column) -> Column:
    """Zeros that a numeric read has lost: dddd to 0dddd, ddd to 0ddd0, one character to 00000."""
    z = F.regexp_replace(zip_, r"\b(\d{4})\b", "0$1")
    z = F.regexp_replace(z, r"\b(\d{3})\b", "0$10")
    return F.when(F.length(z) == 1, F.lit("00000")).otherwise(z)


def zip5(zip_: Column) -> Column:
    return F.regexp_extract(zip_, r"^[0-9]+", 0)


def zip4(zip_: Column) -> Column:
    return F.regexp_extract(zip_, r"(?<=-)[0-9]+", 0)


def zip_candidates(zip_: Column) -> Column:
    """The code itself, then its core with its edge zeros shared out in every other way, from all in front to none."""
    core = F.regexp_replace(F.regexp_replace(zip_, "^0+", ""), "0+$", "")
    zeros = F.length(zip_) - F.length(core)
    moved = F.transform(F.sequence(zeros, F.lit(0), F.lit(-1)), lambda k: F.concat(F.repeat(F.lit("0"), k), core, F.repeat(F.lit("0"), zeros - k)))
    every = F.when(core == "", F.array(zip_)).otherwise(F.array_distinct(F.concat(F.array(zip_), moved)))
    return F.when(zip_.isNull() | (zip_ == ""), F.array().cast("array<string>")).otherwise(every)


def looks_like_acronym(x: Column) -> Column:
    short = (F.length(x) <= 4) & ~x.contains(" ")
    return (short | x.rlike(ACRONYM)) & ~x.isin(*STREET_SUFFIXES)


def acronym_or_city(x: Column, is_city: Column) -> Column:
    """City before Acronym before Unknown; is_city: whether a gazetteer has the name."""
    return F.when(is_city, "City").when(looks_like_acronym(x), "Acronym").otherwise("Unknown")


def parse_address(x: Column) -> Column:
    """Street, line 2, city, state and ZIP of a one-line address, each null where it does not fit."""
    part = lambda i: F.nullif(F.regexp_extract(x, ONE_LINE_ADDRESS, i), F.lit(""))
    return F.struct(part(1).alias("line_1"), F.regexp_replace(part(2), r",\s*$", "").alias("line_2"), part(3).alias("city"), part(4).alias("state"), part(5).alias("zip"))


def compiled_address(line_1: Column, line_2: Column, city: Column, state: Column, zip_: Column, ext: Column) -> Column:
    """`line 1, line 2, city, state zip-ext`, without empty lines or a trailing dash."""
    full = F.concat_ws(", ", F.nullif(line_1, F.lit("")), F.nullif(line_2, F.lit("")), city, F.concat_ws(" ", state, F.concat_ws("-", zip_, F.nullif(ext, F.lit("")))))
    return F.regexp_replace(F.trim(full), "-$", "")


def address_parts(x: Column) -> Column:
    """Line, city, state and ZIP of an address of exactly four parts between commas; null where it has another number."""
    p = F.split(x, ", ")
    return F.when(F.size(p) == 4, F.struct(*[F.get(p, i).alias(k) for i, k in enumerate(("line", "city", "state", "zip"))]))


def geocoder_parts(x: Column) -> Column:
    """Street, city, state and ZIP of an address of three parts or four (a street of two), the last one `state zip`; null
    for one of fewer parts, or without a ZIP. Of five parts or more the first three count, as of three."""
    p = F.split(x, ", ")
    four = F.size(p) == 4
    place = F.split(F.get(p, F.when(four, 3).otherwise(2)), " ")
    street = F.when(four, F.concat_ws(", ", F.get(p, 0), F.get(p, 1))).otherwise(F.get(p, 0))
    parts = F.struct(street.alias("street"), F.get(p, F.when(four, 2).otherwise(1)).alias("city"), F.get(place, 0).alias("state"), F.get(place, 1).alias("zip"))
    return F.when((F.size(p) >= 3) & (F.size(place) >= 2), parts)


def is_zip4(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^[0-9]{4}$"), F.lit(False))


def members(x: Column) -> Column:
    """The members of a list that commas part, trimmed, without empty ones; null has none."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda m: F.trim(m)), lambda m: m != "")


def joined_list(x: Column, sep: str = "; ") -> Column:
    """An array as text; null for an empty one."""
    return F.when(F.size(x) > 0, F.array_join(x, sep))


def region_kind(state: Column) -> Column:
    """State, Territory or Other, by a state's two letters; null for null."""
    return F.when(state.isin(*STATES), "State").when(state.isin(*TERRITORIES), "Territory").when(state.isNotNull(), "Other")
