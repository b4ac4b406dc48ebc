"""Address, company-name and industry-code cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and city names that decide the cleaned text.
POSTCODE_DIGITS = r"^(\d{4})"
POSTCODE_LETTERS = r"([A-Za-z]{2})$"
CITIES_WITHOUT_POSTCODE = ("etten-leur", "kruiningen")
INDUSTRY_CODE_LENGTH = 4


def structure_postcode(postcode: Column) -> Column:
    """``1234 AB`` from a Dutch postcode in any spacing and case.

    A part that is missing stays empty, so a text with neither gives a single space and null stays null.
    """
    parts = [F.regexp_extract(postcode, pattern, 1) for pattern in (POSTCODE_DIGITS, POSTCODE_LETTERS)]
    return F.when(postcode.isNotNull(), F.upper(F.array_join(F.array(*parts), " ")))


def postcode_from_address(
    postcode: Column, city: Column, cities: Sequence[str] = CITIES_WITHOUT_POSTCODE
) -> Column:
    """The postcode of an address whose city field may begin with its letters (``1234``, ``ab city``).

    The first word of both fields together holds it. Fields that say the same count once. Where a field
    is null, or there is nothing but one of ``cities``, the text is empty.
    """
    both = F.concat(postcode, F.when(postcode != city, city).otherwise(""))
    first_word = F.substring_index(both, " ", 1)
    only_city = both.isin(*cities)
    return F.coalesce(F.when(~only_city, structure_postcode(first_word)), F.lit(""))


def preferred_name(default_name: Column, statutory_name: Column) -> Column:
    """The statutory name where there is one, else the default name, in lower case."""
    return F.lower(F.coalesce(statutory_name, default_name))


def clean_industry_code(code: Column) -> Column:
    """Without single quotes, short codes filled up with leading zeros; longer codes stay whole."""
    bare = F.translate(code, "'", "")
    missing = F.lit(INDUSTRY_CODE_LENGTH) - F.length(bare)
    return F.concat(F.repeat(F.lit("0"), F.greatest(missing, F.lit(0))), bare)
