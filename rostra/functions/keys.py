"""Surrogate keys. Every model builds its keys here so that they join.

Operators F1-F7, F22, F23. All keys use ``concat``, which is NULL as soon as
one part is NULL; ``concat_ws`` would silently skip NULL parts instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def text(value: Column) -> Column:
    return value.cast("string")


def _or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def person_key(prefix: str, source_id: Column) -> Column:
    """one person in one source ID system."""
    return F.md5(F.concat(F.lit(f"{prefix}:"), text(source_id)))


def candidacy_key(prefix: str, source_id: Column, cycle: Column) -> Column:
    """one candidate in one cycle."""
    return F.md5(F.concat(F.lit(f"{prefix}:"), text(source_id), F.lit(":"), text(cycle)))


def donor_key(name: Column, zip_code: Column, employer: Column) -> Column:
    """name + zip + employer. Case and outer blanks do not matter, except in the zip."""
    def clean(c: Column) -> Column:
        return F.upper(F.trim(_or_empty(c)))

    return F.md5(
        F.concat(clean(name), F.lit("|"), _or_empty(zip_code), F.lit("|"), clean(employer))
    )


def state_bill_key(bill_id: Column) -> Column:
    """F4, state half."""
    return F.md5(F.concat(F.lit("openstates:"), bill_id))


def federal_bill_key(congress: Column, bill_type: Column, number: Column) -> Column:
    """F4, federal half."""
    return F.md5(
        F.concat(F.lit("congress:"), text(congress), F.lit(":"), F.lower(bill_type), F.lit(":"), number)
    )


def bill_identifier(bill_type: Column, number: Column) -> Column:
    """``HR 12``."""
    return F.concat(F.upper(bill_type), F.lit(" "), number)


def bill_source_id(bill_type: Column, number: Column) -> Column:
    """``hr12``."""
    return F.concat(F.lower(bill_type), number)


def contribution_key(
    transaction_ref: Column,
    recipient_id: Column,
    cycle: Column,
    date: Column,
    donor: Column,
    amount: Column,
    sequence: Column,
) -> Column:
    """seven parts; a NULL recipient, cycle, amount or sequence makes the key NULL."""
    bar = F.lit("|")
    parts = [
        _or_empty(transaction_ref),
        recipient_id,
        text(cycle),
        _or_empty(text(date)),
        _or_empty(donor),
        text(amount),
        text(sequence),
    ]
    joined = [piece for part in parts for piece in (part, bar)][:-1]
    return F.md5(F.concat(*joined))


def sponsorship_key(person: Column, bill: Column, source: Column) -> Column:
    """F6, sponsorships."""
    return F.md5(F.concat(_or_empty(person), F.lit(":"), _or_empty(bill), F.lit(":"), source))


def vote_key(person: Column, voter_name: Column, event: Column, source: Column) -> Column:
    """F6, votes: falls back to the printed name where no person is known."""
    return F.md5(F.concat(F.coalesce(person, voter_name), F.lit(":"), event, F.lit(":"), source))


def house_vote_event(year: Column, roll: Column) -> Column:
    """F7, House."""
    return F.concat(F.lit("house:"), text(year), F.lit(":"), text(roll))


def senate_vote_event(congress: Column, session: Column, number: Column) -> Column:
    """F7, Senate."""
    return F.concat(
        F.lit("senate:"), text(congress), F.lit(":"), text(session), F.lit(":"), text(number)
    )


def district_key(fips: Column, number: Column | None = None) -> Column:
    """``cd-36-14`` for a district, ``state-36`` for a state."""
    if number is None:
        return F.concat(F.lit("state-"), fips)
    return F.concat(F.lit("cd-"), fips, F.lit("-"), number)
