"""Marts: conformed dimensions, facts and the funding-dependency score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import keys, labels
from ..functions.evidence import evidence_text
from ..functions.names import display_name, flip_name
from ..functions.numbers import percent, share, try_to_number
from ..operators.aggregates import joined_distinct
from ..operators.dedup import dedup_sequence
from ..operators.joins import attach, keyword_pairs, lookup
from ..operators.similar_rows import most_similar
from ..operators.unions import conform
from .staging import POPULATION, null

FEDERAL_OFFICES = ["H", "S"]


def dim_members(members: DataFrame, persons: DataFrame, state_map: DataFrame) -> DataFrame:
    """M3: one row per elected federal official."""
    named = members.withColumnRenamed("state", "state_name").withColumnRenamed("member_name", "name")
    with_state = lookup(named, state_map, {"state_name": "state_name"}, {"state": "state_abbr"})
    resolved = attach(
        with_state, persons, {"bioguide_id": "bioguide_id"},
        {"member_key": "person_key", "_matched": "fec_candidate_id"},
    )
    title = labels.title_of(F.col("chamber"))
    return resolved.select(
        "member_key", "bioguide_id",
        F.coalesce("_matched", "fec_candidate_id").alias("fec_candidate_id"),
        "name", "party", "state", "chamber", "district",
        title.alias("title"),
        "latest_congress",
        display_name(
            title, F.col("name"), F.col("party"), F.col("state"), F.col("chamber"), F.col("district")
        ).alias("display_name"),
        "updated_at",
    )


LEGISLATOR = (
    "person_key string, legislator_id string, name string, party string, level string, "
    "state string, chamber string, district bigint, title string"
)


def dim_legislators(
    members: DataFrame,
    people: DataFrame,
    federal_persons: DataFrame,
    state_persons: DataFrame,
    state_map: DataFrame,
) -> DataFrame:
    """M4: sitting legislators, federal and state."""
    named = members.withColumnRenamed("state", "state_name")
    with_state = lookup(named, state_map, {"state_name": "state_name"}, {"state": "state_abbr"})
    chamber = labels.chamber_of(F.col("district"))
    federal = attach(
        with_state, federal_persons, {"bioguide_id": "bioguide_id"}, {"person_key": "person_key"}
    ).select(
        "person_key",
        F.col("bioguide_id").alias("legislator_id"),
        F.col("member_name").alias("name"),
        "party",
        F.lit("federal").alias("level"),
        "state",
        chamber.alias("chamber"),
        "district",
        labels.title_of(chamber).alias("title"),
    )
    role = F.col("current_role")
    state = attach(
        people, state_persons, {"openstates_id": "openstates_id"}, {"person_key": "person_key"}
    ).select(
        "person_key",
        F.col("openstates_id").alias("legislator_id"),
        "name", "party",
        F.lit("state").alias("level"),
        F.upper("state").alias("state"),
        labels.decode(
            role["org_classification"], {"upper": "senate", "lower": "house"}, null("string")
        ).alias("chamber"),
        try_to_number(role["district"]).alias("district"),
        role["title"].alias("title"),
    )
    return conform(LEGISLATOR, federal, state)


def dim_candidates(candidates: DataFrame, totals: DataFrame, persons: DataFrame) -> DataFrame:
    """M5: House and Senate candidacies, one row per candidate and cycle."""
    cycles = totals.select("candidate_id", "cycle")
    federal = candidates.where(F.col("office").isin(FEDERAL_OFFICES))
    resolved = attach(
        federal, persons, {"candidate_id": "fec_candidate_id"}, {"person_key": "person_key"}
    )
    return resolved.join(cycles, "candidate_id").select(
        keys.candidacy_key("fec", F.col("candidate_id"), F.col("cycle")).alias("candidacy_key"),
        "person_key",
        flip_name(F.col("name")).alias("display_name"),
        F.col("party_full").alias("party"),
        F.lit("federal").alias("level"),
        F.col("office_full").alias("office"),
        "state",
        try_to_number(F.col("district")).alias("district"),
        "cycle",
        "incumbent_challenge",
        (F.col("incumbent_challenge") == "I").alias("is_incumbent"),
        F.lit("fec").alias("source_system"),
        F.col("candidate_id").alias("source_id"),
    )


BILL = (
    "bill_key string, source_bill_id string, source_system string, level string, state string, "
    "congress int, session string, bill_type string, bill_number string, identifier string, "
    "title string, abstract string, url string, latest_action_date date, "
    "latest_action_text string, update_date date"
)


def dim_bills(state_bills: DataFrame, federal_bills: DataFrame) -> DataFrame:
    """M6: state and federal bills (U2). ``bill_number`` is NULL for state bills."""
    state = state_bills.select(
        keys.state_bill_key(F.col("bill_id")).alias("bill_key"),
        F.col("bill_id").alias("source_bill_id"),
        F.lit("openstates").alias("source_system"),
        F.lit("state").alias("level"),
        F.upper("state").alias("state"),
        "session", "identifier", "title", "abstract",
        F.col("openstates_url").alias("url"),
        F.col("updated_at").cast("date").alias("update_date"),
    )
    kind, number = F.col("bill_type"), F.col("bill_number")
    federal = federal_bills.select(
        keys.federal_bill_key(F.col("congress"), kind, number).alias("bill_key"),
        keys.bill_source_id(kind, number).alias("source_bill_id"),
        F.lit("congress").alias("source_system"),
        F.lit("federal").alias("level"),
        "congress",
        F.upper(kind).alias("bill_type"),
        number.alias("bill_number"),
        keys.bill_identifier(kind, number).alias("identifier"),
        "title",
        F.col("api_url").alias("url"),
        "latest_action_date", "latest_action_text", "update_date",
    )
    return conform(BILL, state, federal)


def dim_committees(committees: DataFrame) -> DataFrame:
    """Committees with decoded codes; an unknown code stays."""
    return committees.select(
        "committee_id", "name", "committee_type", "committee_type_full", "designation",
        labels.decode(F.col("designation"), labels.DESIGNATIONS).alias("designation_full"),
        "state", "party", "organization_type",
        labels.decode(F.col("organization_type"), labels.ORGANIZATION_TYPES).alias(
            "organization_type_full"
        ),
        "filing_frequency",
    )


DISTRICT = (
    "district_key string, geo_level string, state string, district_number bigint, name string, "
    + ", ".join(f"{c} bigint" for c in POPULATION)
)
SHARES = {
    "pct_white": "pop_white_alone",
    "pct_black": "pop_black_alone",
    "pct_hispanic": "pop_hispanic_latino",
    "pct_bachelors": "pop_bachelors_degree",
    "pct_insured": "pop_health_insurance",
}


def dim_districts(districts: DataFrame, states: DataFrame, state_map: DataFrame) -> DataFrame:
    """M8: congressional districts and states with population shares (U4)."""
    on, take = {"state_fips": "state_fips"}, {"state": "state_abbr"}
    by_district = lookup(districts, state_map, on, take).select(
        keys.district_key(F.col("state_fips"), F.col("district_number")).alias("district_key"),
        F.lit("congressional_district").alias("geo_level"),
        "state",
        try_to_number(F.col("district_number")).alias("district_number"),
        F.col("district_name").alias("name"),
        *POPULATION,
    )
    by_state = lookup(states, state_map, on, take).select(
        keys.district_key(F.col("state_fips")).alias("district_key"),
        F.lit("state").alias("geo_level"),
        "state",
        F.col("state_name").alias("name"),
        *POPULATION,
    )
    both = conform(DISTRICT, by_district, by_state)
    total = F.col("total_population")
    return both.select(
        "*", *[share(F.col(part), total).alias(name) for name, part in SHARES.items()]
    )


def fct_contributions(contributions: DataFrame, persons: DataFrame) -> DataFrame:
    """M9: one row per contribution; repeated ones are numbered into the key, not dropped."""
    natural = [
        "transaction_ref", "recipient_id", "election_cycle", "contribution_date",
        "contributor_name", "amount",
    ]
    to_candidates = contributions.where("office_code <> 'IS'")
    numbered = dedup_sequence(to_candidates, natural)
    resolved = attach(
        numbered, persons, {"recipient_id": "nyc_cfb_recipient_id"}, {"person_key": "person_key"}
    )
    c = F.col
    return resolved.select(
        keys.contribution_key(*[c(n) for n in natural], c("dedup_seq")).alias("contribution_key"),
        keys.candidacy_key("nyc_cfb", c("recipient_id"), c("election_cycle")).alias("candidacy_key"),
        "person_key",
        keys.donor_key(c("contributor_name"), c("zip"), c("employer_name")).alias("donor_key"),
        F.lit("nyc_cfb").alias("source_system"),
        c("election_cycle").alias("cycle"),
        "contribution_date", "amount", "matchable_amount", "contributor_name", "contributor_type",
        "employer_name", "occupation", "city", "state", "zip", "payment_method", "recipient_id",
        "recipient_name",
    )


def fct_candidate_finance(totals: DataFrame) -> DataFrame:
    """Finance summary per candidacy; columns other sources will fill are typed NULLs."""
    return totals.where(F.col("office").isin(FEDERAL_OFFICES)).select(
        keys.candidacy_key("fec", F.col("candidate_id"), F.col("cycle")).alias("candidacy_key"),
        F.lit("fec").alias("coverage"),
        F.col("total_receipts").alias("total_raised"),
        F.col("total_disbursements").alias("total_spent"),
        "cash_on_hand",
        null("decimal(18,2)").alias("public_funds_received"),
        null("decimal(18,2)").alias("matchable_amount_total"),
        null("bigint").alias("contribution_count"),
        null("bigint").alias("unique_donor_count"),
        null("decimal(18,2)").alias("avg_contribution"),
        null("double").alias("pct_small_dollar"),
    )


def fct_member_finance(totals: DataFrame, members: DataFrame) -> DataFrame:
    """Finance totals per member and cycle with PAC and individual shares (F16)."""
    elected = members.select("member_key", "bioguide_id", "fec_candidate_id")
    joined = totals.where(F.col("office").isin(FEDERAL_OFFICES)).join(
        elected, totals["candidate_id"] == elected["fec_candidate_id"]
    )
    individual = F.col("individual_itemized_contributions") + F.col(
        "individual_unitemized_contributions"
    )
    receipts = F.col("total_receipts")
    return joined.select(
        "member_key", "bioguide_id",
        F.col("candidate_id").alias("fec_candidate_id"),
        "cycle", "total_receipts", "total_disbursements", "cash_on_hand",
        "individual_itemized_contributions", "individual_unitemized_contributions",
        "pac_contributions", "party_contributions", "candidate_self_funding",
        percent(F.col("pac_contributions"), receipts).cast("decimal(18,1)").alias("pac_pct_of_total"),
        percent(individual, receipts).cast("decimal(18,1)").alias("individual_pct_of_total"),
    )


def fct_committee_memberships(
    memberships: DataFrame, members: DataFrame, industries: DataFrame
) -> DataFrame:
    """Memberships with the alphabetically first industry of their committee."""
    elected = members.select("member_key", "bioguide_id")
    of_members = memberships.join(elected, "bioguide_id")
    matched = keyword_pairs(
        of_members, "committee_name",
        industries.select("committee_keyword", "industry_category"), "committee_keyword",
    )
    return matched.groupBy(
        "member_key", "congress", "chamber", "committee_code", "committee_name", "role_title", "rank"
    ).agg(F.min("industry_category").alias("industry_category"))


SPONSORSHIP = (
    "person_key string, bill_key string, source_system string, sponsor_name string, "
    "is_primary boolean, classification string, introduced_date date"
)


def fct_bill_sponsorships(
    state_rows: DataFrame,
    federal_rows: DataFrame,
    bills: DataFrame,
    state_persons: DataFrame,
    federal_persons: DataFrame,
) -> DataFrame:
    """Person x bill, state and federal; organisations are left out."""
    of_people = state_rows.where("entity_type = 'person'")
    with_bill = attach(
        of_people, bills.where("source_system = 'openstates'"),
        {"bill_id": "source_bill_id"}, {"bill_key": "bill_key"},
    )
    state = attach(
        with_bill, state_persons, {"openstates_person_id": "openstates_id"}, {"person_key": "person_key"}
    ).withColumn("source_system", F.lit("openstates"))
    typed = federal_rows.withColumn("_type", F.upper("bill_type"))
    with_bill = attach(
        typed, bills.where("source_system = 'congress'"),
        {"_type": "bill_type", "bill_number": "bill_number", "congress": "congress"},
        {"bill_key": "bill_key"},
    )
    federal = attach(
        with_bill, federal_persons, {"bioguide_id": "bioguide_id"}, {"person_key": "person_key"}
    ).withColumn("source_system", F.lit("congress"))
    both = conform(SPONSORSHIP, state, federal)
    key = keys.sponsorship_key(F.col("person_key"), F.col("bill_key"), F.col("source_system"))
    return both.select(key.alias("sponsorship_key"), "*")


VOTE = (
    "person_key string, bill_key string, vote_event_id string, source_system string, "
    "chamber string, vote_date date, vote_option string, vote_result string, motion_text string, "
    "voter_name string"
)


def _bill_of_roll_call(votes: DataFrame, bills: DataFrame, normalise: bool) -> DataFrame:
    """The bill a printed number such as ``HR 1234`` names.

    ``normalise`` also accepts dotted and spaced types such as ``H. R. 1234``.
    """
    printed = F.col("legis_num")
    if normalise:
        kind = F.regexp_replace(F.regexp_extract(printed, r"^(.*?)\s*(\d+)\s*$", 1), r"[.\s]", "")
        number = F.regexp_extract(printed, r"(\d+)\s*$", 1)
    else:
        kind = F.trim(F.split_part(printed, F.lit(" "), F.lit(1)))
        number = F.trim(F.split_part(printed, F.lit(" "), F.lit(2)))
    keyed = votes.withColumn("_type", F.upper(kind)).withColumn("_number", number)
    return attach(
        keyed, bills.where("source_system = 'congress'"),
        {"_type": "bill_type", "_number": "bill_number", "congress": "congress"},
        {"bill_key": "bill_key"},
    )


def fct_votes(
    state_rows: DataFrame,
    house_rows: DataFrame,
    senate_rows: DataFrame,
    bills: DataFrame,
    state_persons: DataFrame,
    federal_persons: DataFrame,
    normalise_legis_num: bool = False,
) -> DataFrame:
    """Person x roll call from three sources (U6). Senate rows know no person yet."""
    def labelled(df: DataFrame, event: Column, source: str, result: str, motion: str) -> DataFrame:
        return (
            df.withColumn("vote_event_id", event)
            .withColumn("source_system", F.lit(source))
            .withColumnRenamed(result, "vote_result")
            .withColumnRenamed(motion, "motion_text")
        )

    with_bill = attach(
        state_rows, bills.where("source_system = 'openstates'"),
        {"bill_id": "source_bill_id"}, {"bill_key": "bill_key"},
    )
    state = labelled(
        attach(
            with_bill, state_persons,
            {"openstates_person_id": "openstates_id"}, {"person_key": "person_key"},
        ),
        F.col("vote_event_id"), "openstates", "result", "motion_text",
    )
    house = labelled(
        attach(
            _bill_of_roll_call(house_rows, bills, normalise_legis_num),
            federal_persons, {"bioguide_id": "bioguide_id"}, {"person_key": "person_key"},
        ),
        keys.house_vote_event(F.col("year"), F.col("roll_number")),
        "congress_house", "vote_result", "vote_question",
    )
    senate = labelled(
        _bill_of_roll_call(senate_rows, bills, normalise_legis_num),
        keys.senate_vote_event(F.col("congress"), F.col("session"), F.col("vote_number")),
        "congress_senate", "vote_result", "vote_question",
    )
    every = conform(VOTE, state, house, senate)
    key = keys.vote_key(*[F.col(c) for c in ["person_key", "voter_name", "vote_event_id", "source_system"]])
    return every.select(key.alias("vote_key"), "*")


def mart_conflict_of_interest(
    finance: DataFrame, memberships: DataFrame, latest_congress_only: bool = False
) -> DataFrame:
    """Funding dependency per member and cycle with tier and evidence.

    Only cycles with receipts count. Committees of all congresses are named, unless
    ``latest_congress_only`` keeps each member's newest congress.
    """
    if latest_congress_only:
        newest = memberships.groupBy("member_key").agg(F.max("congress").alias("congress"))
        memberships = memberships.join(newest, ["member_key", "congress"], "left_semi")
    context = joined_distinct(
        memberships, ["member_key"],
        {"committees_served": "committee_name", "regulated_industries": "industry_category"},
    )
    funded = attach(
        finance.where("total_receipts > 0"), context, {"member_key": "member_key"},
        {"committees_served": "committees_served", "regulated_industries": "regulated_industries"},
    )
    score = F.col("pac_pct_of_total")
    return funded.select(
        "member_key", "cycle",
        score.alias("coi_score"),
        labels.tier(score).alias("risk_level"),
        "total_receipts", "pac_contributions", "individual_itemized_contributions",
        "individual_unitemized_contributions", "party_contributions", "candidate_self_funding",
        "committees_served", "regulated_industries",
        evidence_text(
            F.col("pac_contributions"), score, F.col("total_receipts"), F.col("cycle"),
            F.col("committees_served"), F.col("regulated_industries"),
        ).alias("evidence_description"),
    )


def mart_similar_legislators(votes: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` persons who vote most alike, by the cosine of their yes (1) and no (-1) votes."""
    value = F.when(F.col("vote_option") == "yes", 1).when(F.col("vote_option") == "no", -1)
    cast = votes.select("person_key", "vote_event_id", "source_system", value.alias("cast_as")).where("cast_as is not null")
    found = most_similar(cast, "person_key", "vote_event_id", F.col("cast_as"), part="source_system", k=k)
    return found.withColumnRenamed("other", "similar_person_key")


def committee_directory(house: DataFrame, senate: DataFrame) -> DataFrame:
    """Committees of both chambers."""
    return conform(
        "chamber string, committee_code string, committee_name string, url string",
        house.withColumn("chamber", F.lit("house")), senate.withColumn("chamber", F.lit("senate")),
    )
