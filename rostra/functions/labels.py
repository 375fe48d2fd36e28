"""Code decoding, tiers and vote options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Committee designation codes.
DESIGNATIONS = {
    "A": "Authorized by candidate",
    "B": "Lobbyist/registrant PAC",
    "D": "Leadership PAC",
    "J": "Joint fundraising committee",
    "P": "Principal campaign committee",
    "U": "Unauthorized",
}

# Sponsoring organisation codes.
ORGANIZATION_TYPES = {
    "C": "Corporation",
    "L": "Labor organization",
    "M": "Membership organization",
    "T": "Trade association",
    "V": "Cooperative",
    "W": "Corporation without capital stock",
}

# Printed roll-call options and their common form.
VOTE_OPTIONS = {
    "yea": "yes",
    "aye": "yes",
    "nay": "no",
    "no": "no",
    "not voting": "abstain",
    "present": "present",
}

# Score bounds of the risk tiers, highest first.
RISK_TIERS = [(60, "High"), (30, "Medium")]
LOWEST_TIER = "Low"


def decode(code: Column, labels: Mapping[str, str], default: Column | None = None) -> Column:
    """Label of a code; an unknown code stays as it is unless a default is given."""
    fallback = code if default is None else default
    items = iter(labels.items())
    key, label = next(items)
    result = F.when(code == key, F.lit(label))
    for key, label in items:
        result = result.when(code == key, F.lit(label))
    return result.otherwise(fallback)


def vote_option(value: Column) -> Column:
    """lower-case, then the common form; a missing option becomes ''."""
    lowered = F.lower(F.coalesce(value, F.lit("")))
    return decode(lowered, VOTE_OPTIONS)


def tier(score: Column, bounds: list[tuple[float, str]] = RISK_TIERS, lowest: str = LOWEST_TIER) -> Column:
    """first bound the score reaches; a NULL score reaches none."""
    (bound, name), *rest = bounds
    result = F.when(score >= bound, F.lit(name))
    for bound, name in rest:
        result = result.when(score >= bound, F.lit(name))
    return result.otherwise(lowest)


def chamber_of(district: Column) -> Column:
    """senators have no district."""
    return F.when(district.isNull(), "senate").otherwise("house")


def title_of(chamber: Column) -> Column:
    return F.when(chamber == "senate", "Senator").otherwise("Representative")
