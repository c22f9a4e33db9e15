"""Text expressions. All are built-in columns, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"

# Country prefix, number lengths and provider prefixes.
COUNTRY_PREFIX = "237"
PROVIDER_PREFIXES = [
    ("MTN_MOMO", ("23767", "23768", "23679")),
    ("ORANGE_MONEY", ("23765", "23769")),
]
DEFAULT_PROVIDER = "MTN_MOMO"


def strip(c: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    return F.upper(strip(c))


def clean_status(c: Column, replacements: Mapping[str, str]) -> Column:
    """Lower-case and map known spellings; anything unmapped passes through."""
    low = F.lower(strip(c))
    pairs = [F.lit(x) for kv in replacements.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), low), low) if pairs else low


def flag_to_boolean(c: Column) -> Column:
    """true/yes and false/no in any case; NULL for anything else."""
    low = F.lower(strip(c))
    return F.when(low.isin("true", "yes"), True).when(low.isin("false", "no"), False)


def yes_no_to_int(c: Column) -> Column:
    """YES/NO, case-sensitive, to 1/0; NULL for anything else."""
    s = strip(c)
    return F.when(s == "YES", 1).when(s == "NO", 0)


def mask_phone(c: Column) -> Column:
    """Keep the last four characters; a number of four or fewer is masked whole."""
    s = strip(c)
    n = F.length(s)
    return F.when(n <= 4, F.repeat(F.lit("X"), n)).otherwise(
        F.concat(F.repeat(F.lit("X"), n - 4), F.substring(s, -4, 4))
    )


def audit_mask(c: Column) -> Column:
    """Keep the first six characters only."""
    return F.concat(F.substring(c, 1, 6), F.lit("XXXXXX"))


def normalise_phone(c: Column) -> Column:
    """Digits with the country prefix, NULL when the number is not valid."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    full = F.when(F.length(digits) == 9, F.concat(F.lit(COUNTRY_PREFIX), digits)).otherwise(digits)
    return F.when((F.length(full) == 12) & full.startswith(COUNTRY_PREFIX), full)


def is_valid_phone(c: Column) -> Column:
    return normalise_phone(c).isNotNull()


def phone_provider(c: Column) -> Column:
    """Provider by prefix of a normalised number, the first provider when none fits."""
    out = None
    for name, prefixes in PROVIDER_PREFIXES:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | c.startswith(p)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(DEFAULT_PROVIDER)


def without_punctuation(c: Column) -> Column:
    """Lower-cased text where everything but letters, digits, _ and blanks is a blank."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", " ")


def first_number(c: Column) -> Column:
    """First stand-alone run of four to nine digits, as an integer."""
    found = F.regexp_extract(c, r"(?:^|[^\p{L}\p{N}_])([0-9]{4,9})(?:$|[^\p{L}\p{N}_])", 1)
    return F.nullif(found, F.lit("")).try_cast("int")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | c.contains(w)
    return hit


def route_text(c: Column, rules: Sequence[tuple[str, Column]], default: str) -> Column:
    """First rule that holds names the label; the order of ``rules`` decides."""
    out = None
    for label, cond in rules:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return F.lit(default) if out is None else out.otherwise(default)


def amount_text(c: Column) -> Column:
    """``75,000``: thousands separators, no decimals, half-even."""
    return F.format_number(c, 0)


def percent_text(c: Column) -> Column:
    """``12%``: half-even on whole per cent."""
    return F.concat(F.bround(c * 100, 0).cast("int").cast("string"), F.lit("%"))


def join_first(items: Column, n: int, sep: str = " | ") -> Column:
    return F.concat_ws(sep, F.slice(items, 1, n))


def prefix_code(c: Column, prefix: str, if_match: int, otherwise: int) -> Column:
    """Code by text prefix; NULL text stays NULL."""
    return F.when(c.startswith(prefix), if_match).when(c.isNotNull(), otherwise)
