"""Staging: one function per raw source; rename, cast, drop rows without a key.

Records loaded more than once are reduced to their newest copy first, for every
table that declares a key. Operators P1-P13, N1-N3, W1, W2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import money, to_int, try_date, try_money, try_timestamp
from ..operators.dedup import latest_wins
from ..operators.nested import flatten, flatten_twice
from ..schemas import LOAD_KEYS

CENTS = "decimal(18,2)"
POPULATION = [
    "total_population",
    "median_household_income",
    "pop_white_alone",
    "pop_black_alone",
    "pop_hispanic_latino",
    "pop_bachelors_degree",
    "pop_health_insurance",
]


def newest(raw: DataFrame, table: str) -> DataFrame:
    """Newest copy of each record that has its first key column.

    Loads share a time stamp, so ties are the normal case. They are broken by a hash of all
    columns: every model that reads the table picks the same copy.
    """
    keys = LOAD_KEYS[table]
    return latest_wins(raw.where(F.col(keys[0]).isNotNull()), keys)


def newest_bills(raw: DataFrame) -> DataFrame:
    """The copies that all three state bill models read."""
    return newest(raw, "bills")


def optional(df: DataFrame, name: str, dtype: str) -> Column:
    """A raw column that only some loads carry; a typed NULL where it is absent."""
    present = {c.lower() for c in df.columns}
    return (F.col(name) if name.lower() in present else F.lit(None)).cast(dtype)


def null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _ordinal(name: str) -> Column:
    """The number at the start of a text such as "1st"; NULL where there is none."""
    return F.nullif(F.regexp_extract(name, r"^\s*(\d+)", 1), F.lit(""))


def congressional_districts(raw: DataFrame) -> DataFrame:
    """P1"""
    rows = newest(raw, "congressional_districts").where("congressional_district is not null")
    return rows.select(
        F.col("name").alias("district_name"),
        F.col("state").alias("state_fips"),
        F.col("congressional_district").alias("district_number"),
        *[to_int(F.col(c)).alias(c) for c in POPULATION],
    )


def states(raw: DataFrame) -> DataFrame:
    """P2"""
    return newest(raw, "states").select(
        F.col("name").alias("state_name"),
        F.col("state").alias("state_fips"),
        *[to_int(F.col(c)).alias(c) for c in POPULATION],
    )


def congress_bills(raw: DataFrame) -> DataFrame:
    """P3"""
    return newest(raw, "congress_bills").select(
        to_int(F.col("congress"), "int").alias("congress"),
        F.col("type").alias("bill_type"),
        F.col("number").alias("bill_number"),
        "title",
        F.col("originChamber").alias("origin_chamber"),
        F.col("url").alias("api_url"),
        try_date(F.col("latestAction.actionDate")).alias("latest_action_date"),
        F.col("latestAction.text").alias("latest_action_text"),
        try_date(F.col("updateDate")).alias("update_date"),
        "load_at",
    )


def congress_bill_sponsorships(raw: DataFrame) -> DataFrame:
    """P4"""
    rows = newest(raw, "congress_member_sponsorships").where("congress is not null")
    return rows.select(
        F.col("_bioguide_id").alias("bioguide_id"),
        to_int(F.col("congress"), "int").alias("congress"),
        F.col("type").alias("bill_type"),
        F.col("number").alias("bill_number"),
        "title",
        try_date(F.col("introducedDate")).alias("introduced_date"),
        F.col("policyArea.name").alias("policy_area"),
        try_date(F.col("latestAction.actionDate")).alias("latest_action_date"),
        F.col("latestAction.text").alias("latest_action_text"),
        "load_at",
    )


def congress_members(raw: DataFrame) -> DataFrame:
    """P5"""
    return newest(raw, "members").select(
        F.col("bioguideId").alias("bioguide_id"),
        F.col("name").alias("member_name"),
        F.col("partyName").alias("party"),
        "state",
        to_int(F.col("district"), "int").alias("district"),
        F.get("terms", F.lit(0))["congress"].cast("int").alias("latest_congress"),
        F.when(F.col("district").isNull(), "senate").otherwise("house").alias("chamber"),
        null("string").alias("fec_candidate_id"),
        try_date(F.col("updateDate")).alias("updated_at"),
    )


def congress_committee_memberships(raw: DataFrame) -> DataFrame:
    """Full committees only."""
    full = raw.where("subcommittee_code is null")
    return newest(full, "congress_committee_memberships").select(
        "bioguide_id",
        to_int(F.col("congress"), "int").alias("congress"),
        "chamber",
        "committee_code",
        "committee_name",
        "subcommittee_code",
        "subcommittee_name",
        to_int(F.col("rank"), "int").alias("rank"),
        F.col("title").alias("role_title"),
    )


def _chamber_committees(raw: DataFrame, table: str) -> DataFrame:
    return newest(raw, table).select(
        F.col("systemCode").alias("committee_code"), F.col("name").alias("committee_name"), "url"
    )


def house_committees(raw: DataFrame) -> DataFrame:
    """P7"""
    return _chamber_committees(raw, "house_committees")


def senate_committees(raw: DataFrame) -> DataFrame:
    """P7"""
    return _chamber_committees(raw, "senate_committees")


def fec_candidates(raw: DataFrame) -> DataFrame:
    """P8, W1"""
    return newest(raw, "candidates").select(
        "candidate_id", "name", "office", "office_full", "state", "district", "party",
        "party_full", "incumbent_challenge",
        F.col("has_raised_funds").cast("boolean").alias("has_raised_funds"),
        F.col("load_at").cast("timestamp").alias("load_at"),
    )


def fec_candidate_totals(raw: DataFrame) -> DataFrame:
    """P9, W2. Parts the source does not send yet are typed NULLs."""
    rows = newest(raw, "candidate_totals")
    return rows.select(
        "candidate_id",
        to_int(F.col("cycle"), "int").alias("cycle"),
        "name", "office", "office_full", "state", "district", "party_full",
        F.col("receipts").cast(CENTS).alias("total_receipts"),
        F.col("disbursements").cast(CENTS).alias("total_disbursements"),
        F.col("cash_on_hand_end_period").cast(CENTS).alias("cash_on_hand"),
        F.col("individual_itemized_contributions").cast(CENTS).alias("individual_itemized_contributions"),
        optional(rows, "individual_unitemized_contributions", CENTS).alias(
            "individual_unitemized_contributions"
        ),
        F.col("other_political_committee_contributions").cast(CENTS).alias("pac_contributions"),
        optional(rows, "political_party_committee_contributions", CENTS).alias("party_contributions"),
        optional(rows, "candidate_contribution", CENTS).alias("candidate_self_funding"),
        F.col("load_at").cast("timestamp").alias("load_at"),
    )


def fec_committees(raw: DataFrame) -> DataFrame:
    """P10"""
    return newest(raw, "committees").select(
        "committee_id", "name", "committee_type", "committee_type_full", "designation", "state",
        "party", "organization_type", "filing_frequency",
    )


def ny_boe_activity(raw: DataFrame, money_scale: int = 0) -> DataFrame:
    """Empty amounts become NULL."""
    return raw.where("candidate_name is not null").select(
        to_int(F.col("election_year"), "int").alias("election_year"),
        "filer_id", "committee_name", "candidate_name", "office", "district",
        try_money(F.col("public_funds_received"), money_scale).alias("public_funds_received"),
        try_money(F.col("qualified_campaign_expenditures"), money_scale).alias(
            "qualified_campaign_expenditures"
        ),
        F.col("load_at").cast("timestamp").alias("load_at"),
    )


def nyc_cfb_contributions(raw: DataFrame, money_scale: int = 0) -> DataFrame:
    """Only amounts above zero *after* rounding; unknown dates become NULL."""
    amount = money(F.col("amnt"), money_scale)
    return raw.where(F.col("amnt").isNotNull() & (amount > 0)).select(
        to_int(F.col("election"), "int").alias("election_cycle"),
        to_int(F.col("cycle_year"), "int").alias("cycle_year"),
        F.col("recipid").alias("recipient_id"),
        F.col("recipname").alias("recipient_name"),
        F.col("officecd").alias("office_code"),
        F.col("filing").alias("filing_period"),
        "schedule",
        F.col("refno").alias("transaction_ref"),
        try_date(F.col("date")).alias("contribution_date"),
        F.col("name").alias("contributor_name"),
        F.col("c_code").alias("contributor_type"),
        "city", "state", "zip", "occupation",
        F.col("empname").alias("employer_name"),
        amount.alias("amount"),
        money(F.col("matchamnt"), money_scale).alias("matchable_amount"),
        F.col("pay_method").alias("payment_method"),
        F.col("load_at").cast("timestamp").alias("load_at"),
    )


def openstates_bills(bills: DataFrame) -> DataFrame:
    """P13, from ``newest_bills``."""
    return bills.select(
        F.col("id").alias("bill_id"),
        "identifier", "title",
        null("string").alias("abstract"),
        "openstates_url",
        F.col("_state").alias("state"),
        "session",
        try_timestamp(F.col("created_at")).alias("created_at"),
        try_timestamp(F.col("updated_at")).alias("updated_at"),
    )


def openstates_people(raw: DataFrame) -> DataFrame:
    """P13"""
    return newest(raw, "people").select(
        F.col("id").alias("openstates_id"),
        "name", "party",
        F.col("_state").alias("state"),
        "current_role",
        try_timestamp(F.col("created_at")).alias("created_at"),
        try_timestamp(F.col("updated_at")).alias("updated_at"),
    )


def openstates_bill_sponsorships(bills: DataFrame) -> DataFrame:
    """N1, N3, from ``newest_bills``."""
    rows = flatten(bills, "sponsorships", "s", [F.col("id").alias("bill_id"), "load_at"])
    return rows.select(
        "bill_id",
        F.col("s.name").alias("sponsor_name"),
        F.col("s.entity_type").alias("entity_type"),
        F.col("s.primary").alias("is_primary"),
        F.col("s.classification").alias("classification"),
        F.col("s.person.id").alias("openstates_person_id"),
        "load_at",
    )


def openstates_bill_votes(bills: DataFrame) -> DataFrame:
    """Bills to vote events to single votes, from ``newest_bills``."""
    rows = flatten_twice(
        bills,
        "votes", "e", "votes", "v", [F.col("id").alias("bill_id"), "load_at"],
    )
    return rows.select(
        "bill_id",
        F.col("e.id").alias("vote_event_id"),
        F.col("e.motion_text").alias("motion_text"),
        F.col("e.result").alias("result"),
        try_date(F.col("e.start_date")).alias("vote_date"),
        F.col("v.voter_name").alias("voter_name"),
        F.col("v.voter.id").alias("openstates_person_id"),
        F.col("v.option").alias("vote_option"),
        "load_at",
    )


def house_votes(raw: DataFrame) -> DataFrame:
    """N1, N3. What a roll call prints is read once, not once per voter."""
    rows = newest(raw.where("congress is not null"), "congress_house_votes").select(
        to_int(F.col("congress"), "int").alias("congress"),
        to_int(_ordinal("session"), "int").alias("session"),
        "chamber",
        to_int(F.col("roll_number"), "int").alias("roll_number"),
        to_int(F.col("year"), "int").alias("year"),
        "legis_num", "vote_question", "vote_result",
        try_date(F.col("action_date")).alias("vote_date"),
        "member_votes", "load_at",
    )
    return flatten(rows, "member_votes", "v", [c for c in rows.columns if c != "member_votes"]).select(
        "congress", "session", "chamber", "roll_number", "year", "legis_num", "vote_question", "vote_result", "vote_date",
        F.col("v.bioguide_id").alias("bioguide_id"),
        F.col("v.name").alias("voter_name"),
        F.col("v.party").alias("party"),
        F.col("v.state").alias("state"),
        F.col("v.option").alias("vote_option"),
        "load_at",
    )


def senate_votes(raw: DataFrame) -> DataFrame:
    """N1, N3. What a roll call prints is read once, not once per voter."""
    rows = newest(raw, "congress_senate_votes").select(
        to_int(F.col("congress"), "int").alias("congress"),
        to_int(_ordinal("session"), "int").alias("session"),
        to_int(F.col("vote_number"), "int").alias("vote_number"),
        try_timestamp(F.col("vote_date")).alias("vote_date"),
        "vote_result", "chamber", "legis_num", "vote_question", "member_votes", "load_at",
    )
    return flatten(rows, "member_votes", "v", [c for c in rows.columns if c != "member_votes"]).select(
        "congress", "session", "chamber", "vote_number", "legis_num", "vote_question", "vote_result", "vote_date",
        F.col("v.lis_member_id").alias("lis_member_id"),
        F.col("v.name").alias("voter_name"),
        F.col("v.party").alias("party"),
        F.col("v.state").alias("state"),
        F.col("v.option").alias("vote_option"),
        "load_at",
    )
