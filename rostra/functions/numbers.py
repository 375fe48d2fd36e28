"""Number, ratio and date casts with the source warehouse's semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHOLE = "decimal(38,0)"


def to_int(value: Column, dtype: str = "bigint") -> Column:
    """Strict integer cast that rounds decimal text half up instead of cutting it (H2)."""
    return value.cast(WHOLE).cast(dtype)


def try_to_number(value: Column, dtype: str = "bigint") -> Column:
    """NULL where the text is no number; rounds like :func:`to_int`."""
    return value.try_cast(WHOLE).try_cast(dtype)


def money(value: Column, scale: int = 0) -> Column:
    """A bare decimal has scale 0 in the source warehouse, so cents round away (H1)."""
    return value.cast(f"decimal(38,{scale})")


def try_money(value: Column, scale: int = 0) -> Column:
    return value.try_cast(f"decimal(38,{scale})")


def div0(a: Column, b: Column) -> Column:
    """0 where the divisor is 0, NULL where either side is NULL."""
    return F.when(b == 0, F.when(a.isNotNull(), F.lit(0))).otherwise(
        F.try_divide(a, b)
    )


def share(part: Column, whole: Column, digits: int = 3) -> Column:
    """rounded half-up ratio."""
    return F.round(div0(part, whole), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """F16: rounded percentage."""
    return F.round(div0(part, whole) * 100, digits)


# The date layouts seen in the landed sources.
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "d-MMM-yyyy"]
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss",
    "MMMM d, yyyy, hh:mm a",
]


# What a text must have in it to fit a layout. A layout that does not fit costs an exception for each row.
_NEEDS = {
    "yyyy-MM-dd": lambda c: c.contains("-") & ~c.rlike("[A-Za-z/]"),
    "MM/dd/yyyy": lambda c: c.contains("/"),
    "d-MMM-yyyy": lambda c: c.contains("-") & c.rlike("[A-Za-z]"),
    "yyyy-MM-dd'T'HH:mm:ss": lambda c: c.rlike(r"\dT\d"),
    "MMMM d, yyyy, hh:mm a": lambda c: c.contains(","),
}


def _if_it_may_fit(value: Column, layout: str, parsed: Column) -> Column:
    return F.when(_NEEDS[layout](value), parsed) if layout in _NEEDS else parsed


def try_date(value: Column, formats: list[str] | None = None) -> Column:
    """First layout that fits, else NULL. A leading ISO date in a timestamp also counts."""
    iso = F.regexp_extract(value, r"^(\d{4}-\d{2}-\d{2})[T ]", 1)
    tries = [_if_it_may_fit(value, f, F.try_to_date(value, f)) for f in (formats or DATE_FORMATS)]
    return F.coalesce(*tries, F.when(value.contains("-") & (iso != ""), F.try_to_date(iso, "yyyy-MM-dd")))


def try_timestamp(value: Column) -> Column:
    """H9: naive timestamp; runs of blanks in the printed form are squeezed first."""
    squeezed = F.trim(F.regexp_replace(value, r"\s+", " "))
    tries = [
        _if_it_may_fit(squeezed, f, F.try_to_timestamp(squeezed, F.lit(f)).cast("timestamp_ntz"))
        for f in TIMESTAMP_FORMATS
    ]
    return F.coalesce(squeezed.try_cast("timestamp_ntz"), *tries)
