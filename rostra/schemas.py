"""Explicit schemas of landed and raw tables; nothing is inferred in production.

``LOAD_KEYS`` names the columns that make a raw record unique across reloads.
A table without an entry keeps every row it was given.
"""

from __future__ import annotations

_VOTES_HOUSE = "array<struct<bioguide_id:string,name:string,party:string,state:string,option:string>>"
_VOTES_SENATE = "array<struct<lis_member_id:string,name:string,party:string,state:string,option:string>>"
_SPONSORSHIPS = (
    "array<struct<name:string,entity_type:string,primary:boolean,classification:string,"
    "person:struct<id:string>>>"
)
_STATE_VOTES = (
    "array<struct<id:string,motion_text:string,result:string,start_date:string,"
    "votes:array<struct<voter_name:string,option:string,voter:struct<id:string>>>>>"
)
_ACTION = "struct<actionDate:string,text:string>"
_POPULATION = (
    "total_population string, median_household_income string, pop_white_alone string, "
    "pop_black_alone string, pop_hispanic_latino string, pop_bachelors_degree string, "
    "pop_health_insurance string"
)

RAW = {
    "candidates": (
        "candidate_id string, name string, office string, office_full string, state string, "
        "district string, party string, party_full string, incumbent_challenge string, "
        "has_raised_funds boolean"
    ),
    "candidate_totals": (
        "candidate_id string, cycle int, name string, office string, office_full string, "
        "state string, district string, party_full string, receipts double, disbursements double, "
        "cash_on_hand_end_period double, individual_itemized_contributions double, "
        "other_political_committee_contributions double"
    ),
    "committees": (
        "committee_id string, name string, committee_type string, committee_type_full string, "
        "designation string, state string, party string, organization_type string, "
        "filing_frequency string"
    ),
    "members": (
        "bioguideId string, name string, partyName string, state string, district int, "
        "terms array<struct<congress:int>>, updateDate string"
    ),
    "house_committees": "systemCode string, name string, url string",
    "senate_committees": "systemCode string, name string, url string",
    "congress_committee_memberships": (
        "bioguide_id string, congress int, chamber string, committee_code string, "
        "committee_name string, subcommittee_code string, subcommittee_name string, rank int, "
        "title string, party string"
    ),
    "congress_bills": (
        "congress int, type string, number string, title string, originChamber string, url string, "
        f"latestAction {_ACTION}, updateDate string"
    ),
    "congress_member_sponsorships": (
        "_bioguide_id string, congress int, type string, number string, title string, "
        f"introducedDate string, policyArea struct<name:string>, latestAction {_ACTION}"
    ),
    "congress_house_votes": (
        "chamber string, congress string, session string, roll_number int, year int, "
        "legis_num string, vote_question string, vote_result string, action_date string, "
        f"member_votes {_VOTES_HOUSE}"
    ),
    "congress_senate_votes": (
        "chamber string, congress string, session string, vote_number string, vote_date string, "
        "legis_num string, vote_question string, vote_result string, "
        f"member_votes {_VOTES_SENATE}"
    ),
    "people": (
        "id string, name string, party string, _state string, "
        "current_role struct<title:string,org_classification:string,district:string>, "
        "created_at string, updated_at string"
    ),
    "bills": (
        "id string, identifier string, title string, openstates_url string, _state string, "
        f"session string, created_at string, updated_at string, sponsorships {_SPONSORSHIPS}, "
        f"votes {_STATE_VOTES}"
    ),
    "congressional_districts": (
        f"name string, state string, congressional_district string, {_POPULATION}"
    ),
    "states": f"name string, state string, {_POPULATION}",
    "ny_boe_activity": (
        "election_year string, filer_id string, committee_name string, candidate_name string, "
        "office string, district string, public_funds_received string, "
        "qualified_campaign_expenditures string"
    ),
    "nyc_cfb_contributions": (
        "election string, recipid string, recipname string, officecd string, filing string, "
        "schedule string, refno string, date string, name string, c_code string, city string, "
        "state string, zip string, occupation string, empname string, amnt string, "
        "matchamnt string, pay_method string, cycle_year int"
    ),
}

# Columns that the source began to send later; loads before that lack them.
OPTIONAL = {
    "candidate_totals": (
        "individual_unitemized_contributions double, "
        "political_party_committee_contributions double, candidate_contribution double"
    ),
}

LOAD_KEYS = {
    "candidates": ["candidate_id"],
    "candidate_totals": ["candidate_id", "cycle"],
    "committees": ["committee_id"],
    "members": ["bioguideId"],
    "house_committees": ["systemCode"],
    "senate_committees": ["systemCode"],
    "congress_committee_memberships": [
        "bioguide_id", "congress", "committee_code", "subcommittee_code", "rank", "title",
    ],
    "congress_bills": ["congress", "type", "number"],
    "congress_member_sponsorships": ["_bioguide_id", "congress", "type", "number"],
    "congress_house_votes": ["congress", "year", "roll_number"],
    "congress_senate_votes": ["congress", "session", "vote_number"],
    "people": ["id"],
    "bills": ["id"],
    "congressional_districts": ["state", "congressional_district"],
    "states": ["state"],
}

BILL_SUMMARIES = (
    "bill_key string, plain_summary string, eli5 string, model_id string, generated_at timestamp"
)
