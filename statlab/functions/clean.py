"""Column functions that turn source text into values."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that carry no separable accent but are written plainly in other sources.
PLAIN = {"ł": "l", "Ł": "L", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ı": "i"}

MISSING = "N/A"


def _accented() -> dict[str, str]:
    """Every single letter that decomposes into one other letter and its marks; wide and styled forms as well."""
    found = dict(PLAIN)
    for code in range(0xC0, sys.maxunicode + 1):
        letter = chr(code)
        if not unicodedata.decomposition(letter) or not unicodedata.category(letter).startswith("L"):
            continue
        parts = [c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)]
        if len(parts) == 1 and parts[0] != letter and not unicodedata.category(letter).startswith("Lm"):
            found[letter] = parts[0]
    return found


_ACCENTED = _accented()
# Marks left alone after a decomposed letter are dropped: translate removes what has no replacement.
# The blocks of marks that are accents in every script.
_MARK_BLOCKS = [(0x300, 0x370), (0x1AB0, 0x1B00), (0x1DC0, 0x1E00), (0x20D0, 0x2100), (0xFE20, 0xFE30)]
_MARKS = "".join(chr(c) for a, b in _MARK_BLOCKS for c in range(a, b) if unicodedata.combining(chr(c)))


def strip_accents(text: Column) -> Column:
    return F.translate(text, "".join(_ACCENTED) + _MARKS, "".join(_ACCENTED.values()))


def fold_name(text: Column) -> Column:
    """Lower case, without accents, single spaces: the form in which names are compared."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(text)), r"\s+", " "))


def age_years(age: Column, days_per_year: float = 365.0) -> Column:
    """``'years-days'`` as fractional years with two decimals."""
    parts = F.split(age, "-")
    years, days = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.round(years.try_cast("double") + days.try_cast("double") / days_per_year, 2)


def fee_millions(fee: Column) -> Column:
    """``'€21.4M'`` as 21.4 and ``'Free'`` as 0; anything else is null."""
    number = F.regexp_extract(F.trim(fee), r"^€([0-9]+(?:\.[0-9]+)?)M$", 1).try_cast("double")
    return F.when(F.trim(fee) == "Free", F.lit(0.0)).otherwise(number)


def fee_kind(fee: Column) -> Column:
    """``free``, ``paid`` or ``unknown``, so that a fee of 0 is not taken for a missing one."""
    return (
        F.when(F.trim(fee) == "Free", "free")
        .when(fee_millions(fee).isNotNull(), "paid")
        .otherwise("unknown")
    )


def route(text: Column) -> Column:
    """``'from\\nto'`` as a struct of two clubs."""
    parts = F.split(text, "\n")
    return F.struct(
        F.trim(F.get(parts, F.lit(0))).alias("from_club"), F.trim(F.get(parts, F.lit(1))).alias("to_club")
    )


def primary_token(text: Column, separator: str = ",") -> Column:
    """The first of several values in one string: ``'FW,MF'`` is ``'FW'``."""
    return F.trim(F.get(F.split(text, separator), F.lit(0)))


def clamp_floor(value: Column, floor: float = 0.1) -> Column:
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def fixed(value: Column, decimals: int = 2) -> Column:
    """Half-even rounding and a fixed number of decimals, ``N/A`` where there is no value."""
    text = F.format_string(f"%.{decimals}f", F.bround(value, decimals))
    return F.when(value.isNull(), F.lit(MISSING)).otherwise(text)
