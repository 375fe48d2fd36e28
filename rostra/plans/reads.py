"""Search and profile reads over the marts (Q1-Q8). Each returns DataFrames; the caller collects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..operators import name_index
from ..operators.joins import with_flag
from ..operators.nested import breakdown
from ..operators.paging import (
    contains_if_given,
    current_else_first,
    equals_if_given,
    latest_of,
    page,
    top,
)

# Allowed chambers, page sizes and chart labels.
CHAMBERS = ("house", "senate")
PAGE_LIMIT, PAGE_LIMIT_MAX = 25, 100
RECORD_LIMIT, RECORD_LIMIT_MAX = 50, 200
FUNDING_PARTS = {
    "individual_itemized_contributions": "Individual (itemized)",
    "individual_unitemized_contributions": "Individual (small-dollar)",
    "pac_contributions": "PACs & committees",
    "party_contributions": "Party committees",
    "candidate_self_funding": "Self-funding",
}


class NotFound(Exception):
    """No row has the given key."""


def _checked_limit(limit: int, most: int) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    return limit


def _require(df: DataFrame, key: str, value: str, what: str) -> DataFrame:
    found = df.where(F.col(key) == value)
    if found.isEmpty():
        raise NotFound(f"{what} not found")
    return found


def search_members(
    members: DataFrame,
    q: str | None = None,
    chamber: str | None = None,
    state: str | None = None,
    party: str | None = None,
    congress: int | None = None,
    limit: int = PAGE_LIMIT,
    offset: int = 0,
    name_index_path: str | None = None,
) -> DataFrame:
    """Q1: one page of members by name, with ``total_count``.

    The total is the true one even where the page lies past the end and is empty; use
    :func:`count_members` to read it then. With the path of an index of ``name`` (``name_index``) only rows
    that may hold ``q`` are read.
    """
    if q is not None and name_index_path:
        members, q = name_index.search(members, "member_key", "name", q, name_index_path), None
    found = _matching_members(members, q, chamber, state, party, congress).select(
        "member_key", "bioguide_id", "name", "display_name", "party", "state", "chamber",
        "district", "title", "latest_congress",
    )
    order = [F.asc_nulls_last("name"), F.asc_nulls_last("member_key")]
    return page(found, order, _checked_limit(limit, PAGE_LIMIT_MAX), offset, "total_count")


def count_members(members: DataFrame, **filters) -> DataFrame:
    """Q1: number of members the filters of :func:`search_members` match."""
    return _matching_members(members, **filters).agg(F.count("*").alias("total_count"))


def _matching_members(members, q=None, chamber=None, state=None, party=None, congress=None):
    if chamber is not None and chamber not in CHAMBERS:
        raise ValueError(f"chamber must be one of {CHAMBERS}")
    found = contains_if_given(members, "name", q)
    found = equals_if_given(found, "chamber", chamber)
    found = equals_if_given(found, "state", state.upper() if state else None)
    found = contains_if_given(found, "party", party)
    return equals_if_given(found, "latest_congress", congress)


def member_profile(members: DataFrame, memberships: DataFrame, key: str) -> dict[str, DataFrame]:
    """Q2: identity and committees, newest congress and highest rank first."""
    profile = _require(members, "member_key", key, "member").select(
        "member_key", "bioguide_id", "fec_candidate_id", "name", "display_name", "party", "state",
        "chamber", "district", "title", "latest_congress", "updated_at",
    )
    committees = (
        memberships.where(F.col("member_key") == key)
        .select("committee_name", "role_title", "rank", "industry_category", "congress")
        .orderBy(F.desc_nulls_first("congress"), F.asc_nulls_last("rank"), "committee_name")
    )
    return {"profile": profile, "committees": committees}


def current_committees(memberships: DataFrame, members: DataFrame) -> DataFrame:
    """T5: each member's committees of the latest congress, else the first ten on record."""
    order = [F.desc_nulls_first("congress"), F.asc_nulls_last("rank"), F.asc("committee_name")]
    return current_else_first(
        memberships, members, "member_key", "congress", "latest_congress", order
    )


def member_finance(members: DataFrame, finance: DataFrame, key: str) -> DataFrame:
    """Q3: finance by cycle, newest first."""
    _require(members, "member_key", key, "member")
    return (
        finance.where(F.col("member_key") == key)
        .select(
            "cycle", "total_receipts", "total_disbursements", "cash_on_hand", *FUNDING_PARTS,
            "pac_pct_of_total", "individual_pct_of_total",
        )
        .orderBy(F.desc_nulls_first("cycle"))
    )


def member_record(
    members: DataFrame,
    bills: DataFrame,
    sponsorships: DataFrame,
    votes: DataFrame,
    summaries: DataFrame,
    key: str,
    limit: int = RECORD_LIMIT,
) -> dict[str, DataFrame]:
    """Q4: sponsored bills and votes, newest first, votes with the bill summary if there is one."""
    _checked_limit(limit, RECORD_LIMIT_MAX)
    _require(members, "member_key", key, "member")
    sponsored = top(
        sponsorships.where(F.col("person_key") == key)
        .join(bills, "bill_key")
        .select("bill_key", "identifier", "title", "abstract", "url", "is_primary", "introduced_date"),
        [F.desc_nulls_last("introduced_date"), F.asc("bill_key")],
        limit,
    )
    cast = (
        votes.where(F.col("person_key") == key)
        .select("bill_key", "vote_event_id", "vote_date", "vote_option", "vote_result", "motion_text")
        .join(bills.select("bill_key", "identifier", "title"), "bill_key")
        .join(summaries.select("bill_key", "plain_summary", "eli5"), "bill_key", "left")
    )
    order = [F.desc_nulls_last("vote_date"), F.asc("vote_event_id")]
    return {"sponsored": sponsored, "votes": top(cast, order, limit)}


def member_conflict(members: DataFrame, conflicts: DataFrame, key: str) -> dict[str, DataFrame]:
    """Q5: newest score and its history."""
    _require(members, "member_key", key, "member")
    history = conflicts.where(F.col("member_key") == key).drop("member_key")
    newest_first = [F.desc_nulls_first("cycle")]
    return {"latest": top(history, newest_first, 1), "history": history.orderBy(*newest_first)}


def latest_conflicts(conflicts: DataFrame) -> DataFrame:
    """Q5 for everyone: the newest score of each member."""
    return latest_of(conflicts, ["member_key"], [F.desc_nulls_first("cycle")])


def bill_detail(bills: DataFrame, summaries: DataFrame, key: str) -> DataFrame:
    """Q6: a bill and whether a summary of it is ready."""
    bill = _require(bills, "bill_key", key, "bill").drop("source_bill_id", "bill_number")
    return with_flag(
        bill, summaries, "bill_key",
        ["plain_summary", "eli5", "model_id", "generated_at"], "summary_status",
    )


def funding_breakdown(finance: DataFrame, ids: tuple[str, ...] = ("member_key", "cycle")) -> DataFrame:
    """Q7: one row per funding part that is neither missing nor zero."""
    return breakdown(finance, list(ids), FUNDING_PARTS)


def history_series(df: DataFrame, measures: Mapping[str, str] | list[str]) -> DataFrame:
    """Q8: measures of each cycle as doubles, in cycle order."""
    return df.select("cycle", *[F.col(m).cast("double").alias(m) for m in measures]).orderBy("cycle")
