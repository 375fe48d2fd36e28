import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rostra.plans import build, identity, marts, quality, reads, staging

from fixtures import raw


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    return build.build_models(spark, raw(spark), out)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_every_model_is_built(tables):
    assert set(build.STAGING) | set(build.MODELS) <= set(tables)
    assert tables["stg_congress__house_committees"].count() == 0


def test_staging_keeps_the_newest_copy(tables):
    assert by(tables["stg_congress__members"], "bioguide_id")["W1"].member_name == "Wyden, Ron"
    assert by(tables["stg_fec__candidates"], "candidate_id")["S6OR"].name == "WYDEN, RON"
    assert tables["stg_fec__candidate_totals"].count() == 6


def test_contribution_amounts_are_rounded_then_filtered(tables, spark):
    amounts = sorted(r.amount for r in tables["stg_nyc_cfb__contributions"].collect())
    assert amounts == [1, 10, 10, 10, 500, 500]
    cents = staging.nyc_cfb_contributions(raw(spark)["nyc_cfb_contributions"], 2)
    assert Decimal("0.49") in {r.amount for r in cents.collect()}


def test_crosswalk(tables):
    people = tables["int_persons__id_crosswalk"].collect()
    assert len({p.person_key for p in people}) == len(people)
    member = {p.bioguide_id: p for p in people if p.bioguide_id}
    assert member["W1"].fec_candidate_id == "S6OR" and member["W1"].match_confidence == 100
    assert member["W1"].match_method == "state_district_jarowinkler"
    # Two members fit one candidate; the equal name wins and the other stays unmatched.
    assert member["S1"].fec_candidate_id == "H1NY" and member["S2"].fec_candidate_id is None
    # A compound surname still clears 85; an empty surname never matches.
    assert member["A1"].fec_candidate_id == "H2AK" and 85 <= member["A1"].match_confidence < 100
    assert member["N1"].fec_candidate_id is None
    fec_only = {p.fec_candidate_id for p in people if p.fec_candidate_id and not p.bioguide_id}
    assert fec_only == {"H3NY", "P1"}
    state = {p.openstates_id: p for p in people if p.openstates_id}
    assert state["ocd-1"].ny_boe_filer_id == "F1" and state["ocd-3"].ny_boe_filer_id is None
    filers = {p.ny_boe_filer_id: p.canonical_name for p in people if p.ny_boe_filer_id and not p.openstates_id}
    assert filers == {"F2": "Gov Ernor", "F3": "Ann Other"}
    local = {p.nyc_cfb_recipient_id for p in people if p.nyc_cfb_recipient_id}
    assert local == {"R1", "R4"}
    assert {p.person_key for p in people if p.bioguide_id == "W1"} == {md5("bioguide:W1")}


def test_activity_matches_keep_all_activity(tables):
    rows = tables["int_legislators__ny_boe_activity"].collect()
    linked = sorted((r.election_year, r.openstates_id) for r in rows if r.filer_id == "F1")
    assert linked == [(2022, "ocd-1"), (2024, "ocd-1")]
    assert {r.filer_id for r in rows} == {"F1", "F2", "F3"}
    # "State Senator" is not "senate", so it cannot match.
    assert all(r.openstates_id is None for r in rows if r.filer_id == "F3")


def test_members_and_legislators(tables):
    m = by(tables["dim_members"], "bioguide_id")
    assert m["W1"].display_name == "Senator Wyden, Ron (D-OR)" and m["W1"].chamber == "senate"
    assert m["S1"].display_name == "Representative Smith, Adam (D-NY-14)"
    assert m["A1"].display_name == "Representative Jones, Al (D-AK-0)"
    assert tables["dim_members"].schema["member_key"].metadata["comment"]
    leg = by(tables["dim_legislators"], "legislator_id")
    assert leg["ocd-1"].chamber == "senate" and leg["ocd-2"].chamber == "house"
    assert leg["ocd-3"].chamber is None and leg["ocd-1"].district == 12 and leg["ocd-1"].state == "NY"


def test_candidates(tables):
    c = {(r.source_id, r.cycle): r for r in tables["dim_candidates"].collect()}
    assert set(c) == {("S6OR", 2024), ("S6OR", 2022), ("S6OR", 2020), ("H1NY", 2024), ("H1NY", 2022)}
    assert c["S6OR", 2024].display_name == "Ron Wyden" and c["S6OR", 2024].is_incumbent
    assert c["S6OR", 2024].candidacy_key == md5("fec:S6OR:2024")
    assert c["H1NY", 2024].district == 14 and c["S6OR", 2024].district is None


def test_finance_and_conflict(tables):
    finance = {(r.fec_candidate_id, r.cycle): r for r in tables["fct_member_finance"].collect()}
    wyden = finance["S6OR", 2024]
    assert (wyden.pac_pct_of_total, wyden.individual_pct_of_total) == (Decimal("36.0"), Decimal("60.0"))
    assert finance["S6OR", 2020].pac_pct_of_total == 0 and finance["H1NY", 2024].pac_pct_of_total is None
    coi = {(r.member_key, r.cycle): r for r in tables["mart_conflict_of_interest"].collect()}
    assert set(coi) == {(md5("bioguide:W1"), 2024), (md5("bioguide:W1"), 2022), (md5("bioguide:S1"), 2024)}
    row = coi[md5("bioguide:W1"), 2024]
    assert row.risk_level == "Medium" and row.coi_score == Decimal("36.0")
    assert row.evidence_description == (
        "Received $1,800,000 from PACs and political committees (36.0% of $5,000,000 total raised in 2024). "
        "Sits on: Energy and Commerce and Health · Senate Committee on Finance. These committees oversee: "
        "Energy / Utilities / Telecom · Finance / Insurance / Real Estate."
    )
    assert coi[md5("bioguide:W1"), 2022].risk_level == "High"
    poor = coi[md5("bioguide:S1"), 2024]
    assert poor.risk_level == "Low" and poor.evidence_description is None
    assert (poor.committees_served, poor.regulated_industries) == ("Ceremonies", "")


def test_latest_congress_option(tables):
    mart = marts.mart_conflict_of_interest(
        tables["fct_member_finance"], tables["fct_committee_memberships"], latest_congress_only=True
    )
    assert {r.committees_served for r in mart.collect()} == {"Senate Committee on Finance", "Ceremonies"}


def test_contributions(tables):
    rows = tables["fct_contributions"].collect()
    assert len(rows) == 4
    keys = {r.contribution_key for r in rows}
    assert {md5(f"REF1|R1|2021|2021-01-15|John Doe|500|{n}") for n in (1, 2)} <= keys
    assert md5("REF1|R1|2021||John Doe|1|1") in keys and md5("REF1|R4|2021|2021-01-15||10|1") in keys
    assert all(r.person_key for r in rows)


def test_bills_sponsorships_votes(tables):
    bills = by(tables["dim_bills"], "source_bill_id")
    assert bills["hr22"].identifier == "HR 22" and bills["hr22"].bill_key == md5("congress:119:hr:22")
    assert bills["b1"].bill_number is None and bills["b1"].update_date == date(2025, 1, 2)
    s = tables["fct_bill_sponsorships"].collect()
    assert sorted((r.source_system, r.person_key is not None, r.bill_key is not None) for r in s) == [
        ("congress", True, False), ("congress", True, True), ("openstates", False, True), ("openstates", True, True),
    ]
    votes = tables["fct_votes"].collect()
    assert len(votes) == 7
    house = {r.vote_event_id: r for r in votes if r.source_system == "congress_house" and r.person_key}
    assert house["house:2025:7"].bill_key and not house["house:2025:8"].bill_key
    assert house["house:2025:9"].bill_key is None
    senate = next(r for r in votes if r.source_system == "congress_senate")
    assert senate.vote_key == md5("Baldwin (D-WI):senate:119:1:5:congress_senate")
    assert senate.vote_date == date(2025, 1, 9)


def test_dotted_bill_numbers_on_request(tables):
    votes = marts.fct_votes(
        tables["stg_openstates__bill_votes"], tables["stg_congress__house_votes"],
        tables["stg_congress__senate_votes"], tables["dim_bills"],
        tables["int_persons__state"], tables["int_persons__federal"], normalise_legis_num=True,
    )
    row = votes.where("vote_event_id = 'house:2025:9'").first()
    assert row.bill_key == md5("congress:119:hr:22")


def test_committees_and_districts(tables):
    c = by(tables["dim_committees"], "committee_id")
    assert (c["C1"].designation_full, c["C1"].organization_type_full) == ("Leadership PAC", "Labor organization")
    assert (c["C2"].designation_full, c["C2"].organization_type_full) == ("Z", None)
    d = by(tables["dim_districts"], "district_key")
    cd = d["cd-36-14"]
    assert (cd.state, cd.district_number, cd.pct_white, cd.pct_bachelors) == ("NY", 14, 0.5, 0.063)
    zero = d["cd-36-ZZ"]
    assert (zero.district_number, zero.pct_white, zero.pct_black) == (None, 0.0, None)
    assert d["state-36"].name == "New York"


def test_reads(tables, spark):
    members, key = tables["dim_members"], md5("bioguide:W1")
    page = reads.search_members(members, q="smi", state="ny", chamber="house").collect()
    assert [(r.name, r.total_count) for r in page] == [("Smith, Adam", 1)]
    assert reads.search_members(members, offset=50).count() == 0
    assert reads.count_members(members, party="demo").first()[0] == 5
    with pytest.raises(ValueError):
        reads.search_members(members, chamber="lords")
    with pytest.raises(ValueError):
        reads.search_members(members, limit=101)
    profile = reads.member_profile(members, tables["fct_committee_memberships"], key)
    assert [r.congress for r in profile["committees"].collect()] == [119, 118]
    with pytest.raises(reads.NotFound):
        reads.member_profile(members, tables["fct_committee_memberships"], "nobody")
    assert [r.cycle for r in reads.member_finance(members, tables["fct_member_finance"], key).collect()] == [2024, 2022, 2020]
    conflict = reads.member_conflict(members, tables["mart_conflict_of_interest"], key)
    assert conflict["latest"].first().cycle == 2024 and conflict["history"].count() == 2
    bill = md5("congress:119:hr:22")
    summaries = spark.createDataFrame(
        [(bill, "plain", "simple", "m", None)],
        "bill_key string, plain_summary string, eli5 string, model_id string, generated_at timestamp",
    )
    assert reads.bill_detail(tables["dim_bills"], summaries, bill).first().summary_status == "ready"
    other = md5("openstates:b1")
    assert reads.bill_detail(tables["dim_bills"], summaries, other).first().summary_status == "none"
    record = reads.member_record(
        members, tables["dim_bills"], tables["fct_bill_sponsorships"], tables["fct_votes"], summaries, md5("bioguide:S1")
    )
    assert [r.identifier for r in record["sponsored"].collect()] == ["HR 22"]
    assert [(r.vote_option, r.plain_summary) for r in record["votes"].collect()] == [("yes", "plain")]
    parts = reads.funding_breakdown(tables["fct_member_finance"]).where(F.col("member_key") == key)
    assert {r.source for r in parts.where("cycle = 2024").collect()} == {
        "Individual (itemized)", "Individual (small-dollar)", "PACs & committees",
    }
    series = reads.history_series(
        tables["fct_member_finance"].where(F.col("member_key") == key), ["total_receipts"]
    )
    assert [r.total_receipts for r in series.collect()] == [0.0, 100.0, 5000000.0]
    current = reads.current_committees(tables["fct_committee_memberships"], members).collect()
    assert sorted((r.committee_code, r.congress) for r in current) == [("HSXX", 119), ("SSFI", 119)]
    assert reads.latest_conflicts(tables["mart_conflict_of_interest"]).count() == 2


def test_quality_report(tables):
    report = {(r.check, r.relation, r.column): r for r in quality.report(tables, quality.CHECKS).collect()}
    assert len(report) == len(quality.CHECKS)
    failed = {k for k, r in report.items() if not r.passed}
    assert failed == {
        ("relationships", "fct_contributions", "candidacy_key"),
        ("accepted_values", "fct_votes", "vote_option"),
    }
    assert report["relationships", "fct_contributions", "candidacy_key"].severity == "warn"
    assert report["relationships", "fct_contributions", "candidacy_key"].failures == 4


def test_named_models_build_only_what_they_need(spark):
    got = build.build_models(spark, raw(spark), only={"fct_candidate_finance"})
    assert set(got) == {"stg_fec__candidate_totals", "fct_candidate_finance"}
    assert build.raw_needed({"dim_committees"}) == {"committees"}


def test_empty_raw_tables_give_empty_models(spark):
    got = build.build_models(spark, {}, only={"mart_conflict_of_interest", "fct_votes"})
    assert got["mart_conflict_of_interest"].count() == 0 and got["fct_votes"].count() == 0
