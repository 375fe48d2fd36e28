"""Person names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters after which initcap starts a new word. The
# apostrophe is not among them.
INITCAP_DELIMITERS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def surname_before_comma(name: Column) -> Column:
    """``"Smith, Jane"`` -> ``SMITH``."""
    return F.upper(F.trim(F.split_part(name, F.lit(","), F.lit(1))))


def surname_last_token(name: Column) -> Column:
    """``"Jane Smith"`` -> ``SMITH``."""
    return F.upper(F.trim(F.split_part(name, F.lit(" "), F.lit(-1))))


def initcap_words(value: Column) -> Column:
    """Capitalise after blanks and punctuation, not only after blanks (H8)."""
    pieces = F.regexp_extract_all(
        F.lower(value),
        F.lit(f"([^{INITCAP_DELIMITERS}]+|[{INITCAP_DELIMITERS}]+)"),
        F.lit(1),
    )
    capital = F.transform(
        pieces,
        lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2))),
    )
    return F.array_join(capital, "")


def flip_name(name: Column) -> Column:
    """``"SMITH, JANE"`` -> ``Jane Smith``. Without a comma the name is doubled."""
    first = F.trim(F.substr(name, F.position(F.lit(","), name) + 1))
    last = F.trim(F.split_part(name, F.lit(","), F.lit(1)))
    return initcap_words(F.concat(first, F.lit(" "), last))


def display_name(
    title: Column, name: Column, party: Column, state: Column, chamber: Column, district: Column
) -> Column:
    """``Representative Smith, Jane (D-NY-14)``; NULL party or state gives NULL."""
    seat = F.when(
        (chamber == "house") & district.isNotNull(),
        F.concat(F.lit("-"), district.cast("string")),
    ).otherwise("")
    return F.concat(
        title, F.lit(" "), name, F.lit(" ("), F.left(party, F.lit(1)), F.lit("-"), state, seat, F.lit(")")
    )
