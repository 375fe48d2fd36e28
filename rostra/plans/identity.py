"""Identity resolution: one row per person across five source ID systems (M1, M2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import person_key
from ..functions.names import surname_before_comma, surname_last_token
from ..functions.numbers import try_to_number
from ..operators.dedup import first_by, one_to_one, row_fingerprint
from ..operators.joins import attach, lookup, without
from ..operators.matching import best_matches, fuzzy_left_join
from ..operators.unions import conform
from ..session import staged

MIN_SCORE = 85

PERSON = (
    "person_key string, canonical_name string, level string, bioguide_id string, "
    "fec_candidate_id string, openstates_id string, ny_boe_filer_id string, "
    "nyc_cfb_recipient_id string, match_method string, match_confidence int"
)


def legislator_activity(activity: DataFrame, people: DataFrame) -> DataFrame:
    """M1: state campaign activity with the legislators of the same district and a like surname.

    Only assembly and senate activity can match; every activity row stays (J8, P17).
    """
    office = F.col("office")
    legislative = office.ilike("%assembly%") | office.ilike("%senate%")
    filed = activity.withColumn("_surname", surname_last_token(F.col("candidate_name"))).withColumn(
        "_district", F.when(legislative, F.col("district").cast("string"))
    )
    legislators = people.where("current_role is not null").select(
        "openstates_id",
        F.col("name").alias("legislator_name"),
        F.col("party").alias("legislator_party"),
        F.col("current_role.district").alias("_district"),
        surname_last_token(F.col("name")).alias("_legislator_surname"),
    )
    joined = fuzzy_left_join(
        filed, legislators, "_district", "_surname", "_legislator_surname", MIN_SCORE
    )
    return joined.drop("_surname", "_district", "_legislator_surname")


def _seat(chamber: str, *parts: Column) -> Column:
    return F.concat_ws("/", F.lit(chamber), *parts)


def federal_members(members: DataFrame, state_map: DataFrame) -> DataFrame:
    """Members with their postal state, surname and seat.

    House members compete for a state and district, senators for a state. Writing the
    seat as one text turns that either-or into a single equi-join key.
    """
    named = members.withColumn("state_name", F.col("state"))
    with_state = lookup(named, state_map, {"state_name": "state_name"}, {"state_abbr": "state_abbr"})
    abbr, district = F.col("state_abbr"), F.col("district")
    seat = F.when(
        abbr.isNotNull(),
        F.when(district.isNotNull(), _seat("H", abbr, district.cast("string"))).otherwise(
            _seat("S", abbr)
        ),
    )
    return with_state.select(
        "bioguide_id", "member_name", seat.alias("seat"),
        surname_before_comma(F.col("member_name")).alias("member_surname"),
    )


def fec_seats(candidates: DataFrame) -> DataFrame:
    """Candidates with surname and seat; presidential candidates have no seat and never match."""
    state, district = F.col("state"), try_to_number(F.col("district"))
    seat = F.when(
        (F.col("office") == "H") & state.isNotNull() & district.isNotNull(),
        _seat("H", state, district.cast("string")),
    ).when((F.col("office") == "S") & state.isNotNull(), _seat("S", state))
    return candidates.select(
        F.col("candidate_id").alias("fec_candidate_id"),
        F.col("name").alias("fec_name"),
        seat.alias("seat"),
        surname_before_comma(F.col("name")).alias("fec_surname"),
    )


def federal_matches(members: DataFrame, candidates: DataFrame) -> DataFrame:
    """At most one candidate per member and one member per candidate."""
    return best_matches(
        members, candidates, "seat",
        "bioguide_id", "member_surname", "fec_candidate_id", "fec_surname", MIN_SCORE,
    )


def boe_links(activity_matches: DataFrame) -> DataFrame:
    """One filer per legislator and one legislator per filer."""
    pairs = (
        activity_matches.where("openstates_id is not null and filer_id is not null")
        .select("filer_id", "openstates_id")
        .distinct()
    )
    return one_to_one(pairs, "openstates_id", "filer_id")


def federal_persons(members: DataFrame, candidates: DataFrame, state_map: DataFrame) -> DataFrame:
    """M2, federal: members with their candidate, then candidates that no member took.

    Members, candidates and matches are read by several branches, so they are staged.
    """
    fed_members = staged(federal_members(members, state_map), "federal-members")
    fec = staged(fec_seats(candidates), "fec-candidates")
    matches = staged(federal_matches(fed_members, fec), "federal-matches")
    elected = attach(
        fed_members, matches, {"bioguide_id": "bioguide_id"},
        {"fec_candidate_id": "fec_candidate_id", "match_confidence": "score"},
    ).select(
        person_key("bioguide", F.col("bioguide_id")).alias("person_key"),
        F.col("member_name").alias("canonical_name"),
        F.lit("federal").alias("level"),
        "bioguide_id",
        "fec_candidate_id",
        F.when(F.col("fec_candidate_id").isNotNull(), "state_district_jarowinkler").alias("match_method"),
        "match_confidence",
    )
    fec_only = without(fec, matches, {"fec_candidate_id": "fec_candidate_id"}).select(
        person_key("fec", F.col("fec_candidate_id")).alias("person_key"),
        F.col("fec_name").alias("canonical_name"),
        F.lit("federal").alias("level"),
        "fec_candidate_id",
    )
    return conform(PERSON, elected, fec_only)


def state_persons(people: DataFrame, activity: DataFrame, activity_matches: DataFrame) -> DataFrame:
    """M2, state: legislators with their filer, then filers that no legislator has."""
    links = staged(boe_links(activity_matches), "filer-links")
    legislators = attach(
        people, links, {"openstates_id": "openstates_id"}, {"ny_boe_filer_id": "filer_id"}
    ).select(
        person_key("openstates", F.col("openstates_id")).alias("person_key"),
        F.col("name").alias("canonical_name"),
        F.lit("state").alias("level"),
        "openstates_id",
        "ny_boe_filer_id",
        F.when(F.col("ny_boe_filer_id").isNotNull(), "district_jarowinkler").alias("match_method"),
    )
    unlinked = without(activity, links, {"filer_id": "filer_id"})
    filers = canonical_filers(unlinked).select(
        person_key("nyboe", F.col("filer_id")).alias("person_key"),
        F.col("candidate_name").alias("canonical_name"),
        F.lit("state").alias("level"),
        F.col("filer_id").alias("ny_boe_filer_id"),
    )
    return conform(PERSON, legislators, filers)


def local_persons(contributions: DataFrame) -> DataFrame:
    """M2, local: recipients of city contributions."""
    recipients = city_recipients(contributions).select(
        person_key("nyccfb", F.col("recipient_id")).alias("person_key"),
        F.col("recipient_name").alias("canonical_name"),
        F.lit("local").alias("level"),
        F.col("recipient_id").alias("nyc_cfb_recipient_id"),
    )
    return conform(PERSON, recipients)


def crosswalk(federal: DataFrame, state: DataFrame, local: DataFrame) -> DataFrame:
    """M2: one row per person, each keyed by its highest-priority ID.

    The levels are resolved independently. A model that joins by one kind of ID reads
    only the level that has it.
    """
    return federal.unionByName(state).unionByName(local)


def canonical_filers(activity: DataFrame) -> DataFrame:
    """A filer's governor line first, then the latest year, then the longest name."""
    order = [
        F.when(F.col("office") == "Governor", 0).otherwise(1).asc(),
        F.desc_nulls_first("election_year"),
        F.length("candidate_name").desc_nulls_first(),
        F.asc("candidate_name"),
        row_fingerprint(activity).asc(),
    ]
    return first_by(activity, ["filer_id"], order)


def city_recipients(contributions: DataFrame) -> DataFrame:
    """Candidates only; independent spenders and unknown offices are left out."""
    return (
        contributions.where("office_code <> 'IS'")
        .groupBy("recipient_id")
        .agg(F.max("recipient_name").alias("recipient_name"))
    )
