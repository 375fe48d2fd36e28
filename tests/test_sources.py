import json

import pytest
from pyspark.sql import functions as F

from rostra import seeds
from rostra.sources import committees, landing, rollcalls


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_pages_of_all_envelopes(spark, tmp_path):
    write(tmp_path / "c" / "p1.json", json.dumps({
        "results": [{"candidate_id": "H1", "name": "A, B", "unknown": 1}],
        "pagination": {"page": 1, "pages": 2},
    }, indent=1))
    write(tmp_path / "c" / "p2.json", json.dumps({"results": [{"candidate_id": "H2"}]}))
    write(tmp_path / "c" / "p3.json", json.dumps({"results": []}))
    got = landing.read_table_pages(spark, str(tmp_path / "c"), "candidates")
    assert sorted(r.candidate_id for r in got.collect()) == ["H1", "H2"]
    write(tmp_path / "m" / "p1.json", json.dumps({
        "members": [{"bioguideId": "W1", "terms": [{"congress": 119}]}], "pagination": {"next": None},
    }))
    member = landing.read_table_pages(spark, str(tmp_path / "m"), "members").first()
    assert member.bioguideId == "W1" and member.terms[0].congress == 119


def test_sponsorships_are_tagged_with_their_member(spark, tmp_path):
    page = json.dumps({"sponsoredLegislation": [{"congress": 119, "type": "HR", "number": "1"}]})
    write(tmp_path / "_bioguide_id=W1" / "p.json", page)
    write(tmp_path / "_bioguide_id=__HIVE_DEFAULT_PARTITION__" / "p.json", page)
    got = landing.read_table_pages(
        spark, str(tmp_path), "congress_member_sponsorships", "_bioguide_id"
    ).collect()
    assert [(r._bioguide_id, r.number) for r in got] == [("W1", "1")]


def test_matrix(spark, tmp_path):
    write(tmp_path / "d.json", json.dumps([
        ["NAME", "B01003_001E", "B19013_001E", "state", "congressional district"],
        ["District 1", "700000", None, "36", "01"],
        ["District 2", "710000", "50000", "36", "02"],
    ]))
    rows = landing.read_districts(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r.name, r.state, r.congressional_district) for r in rows] == [
        ("District 1", "36", "01"), ("District 2", "36", "02"),
    ]
    assert rows[0].total_population == "700000" and rows[0].median_household_income is None
    assert rows[0].pop_white_alone is None
    write(tmp_path / "s" / "s.json", json.dumps([["NAME", "state"]]))
    assert landing.read_states(spark, str(tmp_path / "s")).count() == 0


HEADER = ",".join(landing.ACTIVITY_HEADER) + "\n"


def test_activity_reads_all_files_and_a_byte_order_mark(spark, tmp_path):
    write(tmp_path / "a.csv", "﻿" + HEADER + "2022,80021,Friends,Ada Quill,Member of Assembly,7,,1200.50\n")
    write(tmp_path / "b.csv", HEADER + '2023,80022,"Committee, B",Lev Ostrow,State Senator,3,310.00,1\n')
    write(tmp_path / "notes.txt", "x\n")
    rows = landing.read_activity(spark, str(tmp_path)).orderBy("election_year").collect()
    assert [(r.election_year, r.committee_name) for r in rows] == [("2022", "Friends"), ("2023", "Committee, B")]
    assert rows[0].public_funds_received is None


def test_missing_activity_is_an_error(spark, tmp_path):
    with pytest.raises(landing.SourceError, match="no landing folder"):
        landing.read_activity(spark, str(tmp_path / "nowhere"))
    with pytest.raises(landing.SourceError, match="no CSV file"):
        landing.read_activity(spark, str(tmp_path))


def test_contribution_cycles(spark, tmp_path):
    header = "ELECTION,RECIPID,RECIPNAME,OFFICECD,FILING,SCHEDULE,REFNO,DATE,NAME,C_CODE,CITY,STATE,ZIP,OCCUPATION,EMPNAME,AMNT,MATCHAMNT,PAY_METHOD\n"
    row = "2021,R77,Mira Vale,5,1,A,T-9,03/02/2021,Otto Kern,IND,Queens,NY,11375,Baker,Kern & Sons,80.00,40.00,2\n"
    for cycle in (2021, 2023, 1999):
        write(tmp_path / f"cycle_year={cycle}" / "c.csv", header + row)
    got = landing.read_contributions(spark, str(tmp_path), [2021, 2023, 2009]).collect()
    assert sorted(r.cycle_year for r in got) == [2021, 2023]
    assert got[0].recipname == "Mira Vale" and got[0].amnt == "80.00" and got[0].zip == "11375"
    assert landing.read_contributions(spark, str(tmp_path), [2001]).count() == 0
    assert landing.read_contributions(spark, str(tmp_path)).count() == 3


def test_columns_are_found_by_name(spark, tmp_path):
    turned = list(reversed(landing.ACTIVITY_HEADER))
    write(tmp_path / "a.csv", HEADER + "2022,F1,C,N,O,D,1,2\n")
    write(tmp_path / "b.csv", ",".join([*[h.upper() for h in turned], "More"]) + "\n" + "2,1,D,O,N,C,F2,2023,x\n")
    write(tmp_path / "empty.csv", "")
    rows = landing.read_activity(spark, str(tmp_path)).orderBy("filer_id").collect()
    assert [tuple(r) for r in rows] == [
        ("2022", "F1", "C", "N", "O", "D", "1", "2"), ("2023", "F2", "C", "N", "O", "D", "1", "2"),
    ]
    write(tmp_path / "c.csv", "Election Year,Filer ID\n2022,F3\n")
    with pytest.raises(landing.SourceError, match="Committee Name"):
        landing.read_activity(spark, str(tmp_path))


def test_malformed_files_are_errors(spark, tmp_path):
    write(tmp_path / "p" / "1.json", json.dumps({"results": [{"candidate_id": "H1"}]}))
    write(tmp_path / "p" / "2.json", '{"results": [{"candidate_id": "H2"}, {"cand')
    write(tmp_path / "m" / "1.json", '[["NAME", "state"], ["x"')
    write(tmp_path / "2025" / "roll001.xml", HOUSE[: len(HOUSE) // 2])
    write(tmp_path / "c.json", "[]")
    write(tmp_path / "l.json", '{"A": [{"bioguide": "X1"')
    for read in (
        lambda: landing.read_table_pages(spark, str(tmp_path / "p"), "candidates"),
        lambda: landing.read_states(spark, str(tmp_path / "m")),
        lambda: rollcalls.house_votes(spark, str(tmp_path / "2025")),
        lambda: committees.read_memberships(spark, str(tmp_path / "l.json"), str(tmp_path / "c.json"), 1),
    ):
        with pytest.raises(Exception):
            read().collect()
    write(tmp_path / "q" / "1.json", json.dumps({"error": "over quota"}))
    with pytest.raises(Exception, match="results"):
        landing.read_table_pages(spark, str(tmp_path / "q"), "candidates").collect()


def test_odd_roll_call_names(spark, tmp_path):
    write(tmp_path / "2025" / "roll007.xml", HOUSE)
    write(tmp_path / "2025" / "copy.xml", HOUSE)
    got = rollcalls.house_votes(spark, f"{tmp_path}/2025").collect()
    assert {r.roll_number for r in got} == {7, None}
    assert [r.path.rsplit("/", 1)[1] for r in rollcalls.unnumbered(spark, f"{tmp_path}/2025").collect()] == ["copy.xml"]


HOUSE = """<?xml version="1.0"?>
<rollcall-vote><vote-metadata><congress>119</congress><session>1st</session>
<legis-num> H R 22 </legis-num><vote-question>On Passage</vote-question><vote-result></vote-result>
<action-date>3-Jan-2025</action-date></vote-metadata>
<vote-data>
<recorded-vote><legislator name-id="A000370" party="D" state="NC">Adams</legislator><vote>Yea</vote></recorded-vote>
<recorded-vote><legislator name-id="B000001" party="R" state="TX">Babin</legislator><vote>Not Voting</vote></recorded-vote>
<recorded-vote><vote>Nay</vote></recorded-vote>
</vote-data></rollcall-vote>"""

SENATE = """<?xml version="1.0"?>
<roll_call_vote><congress>119</congress><session>1</session><vote_number>00007</vote_number>
<vote_date>January 9, 2025,  02:54 PM</vote_date><question>On the Motion</question>
<vote_result>Agreed to</vote_result>
<document><document_type>{kind}</document_type><document_number>5</document_number></document>
<members><member><lis_member_id>S354</lis_member_id><member_full>Baldwin (D-WI)</member_full>
<party>D</party><state>WI</state><vote_cast>Guilty</vote_cast></member></members></roll_call_vote>"""


def test_house_roll_call(spark, tmp_path):
    write(tmp_path / "2025" / "roll007.xml", HOUSE)
    row = rollcalls.house_votes(spark, f"{tmp_path}/2025").first()
    assert (row.roll_number, row.year, row.congress, row.legis_num) == (7, 2025, "119", "H R 22")
    assert row.vote_result is None and row.action_date == "3-Jan-2025"
    assert [(v.bioguide_id, v.name, v.party, v.state, v.option) for v in row.member_votes] == [
        ("A000370", "Adams", "D", "NC", "yes"), ("B000001", "Babin", "R", "TX", "abstain"),
    ]


def test_senate_roll_call(spark, tmp_path):
    write(tmp_path / "a.xml", SENATE.format(kind="S."))
    write(tmp_path / "b.xml", SENATE.format(kind=""))
    rows = rollcalls.senate_votes(spark, str(tmp_path)).collect()
    assert {r.legis_num for r in rows} == {"S. 5", None}
    vote = rows[0].member_votes[0]
    assert (vote.lis_member_id, vote.name, vote.option) == ("S354", "Baldwin (D-WI)", "guilty")


def test_roll_call_without_votes(spark, tmp_path):
    write(tmp_path / "2025" / "roll001.xml", "<rollcall-vote><vote-metadata><congress>119</congress></vote-metadata></rollcall-vote>")
    assert rollcalls.house_votes(spark, f"{tmp_path}/2025").first().member_votes == []


def test_committee_memberships(spark, tmp_path):
    write(tmp_path / "committees.json", json.dumps([
        {"thomas_id": "SSXX", "name": "Committee on Rivers", "type": "senate",
         "subcommittees": [{"thomas_id": "04", "name": "Locks"}]},
        {"thomas_id": "HSXX", "name": "Committee on Roads", "type": "house"},
    ]))
    write(tmp_path / "members.json", json.dumps({
        "SSXX": [{"bioguide": "Q000001", "rank": 1, "title": "Ranking Member", "party": "minority"},
                 {"bioguide": "Q000002", "rank": 2, "party": "minority"}],
        "SSXX04": [{"bioguide": "Q000001", "rank": 1, "party": "minority"}],
        "HSXX": [{"bioguide": "Q000003", "rank": 1, "title": "Chairman"}, {"rank": 3}],
        "ZZ": [{"bioguide": "Z1"}],
    }))
    rows = committees.read_memberships(
        spark, str(tmp_path / "members.json"), str(tmp_path / "committees.json"), 119
    ).collect()
    assert len(rows) == 5
    sub = next(r for r in rows if r.subcommittee_code)
    assert (sub.committee_code, sub.committee_name, sub.subcommittee_code, sub.subcommittee_name) == (
        "SSXX", "Committee on Rivers", "SSXX04", "Locks",
    )
    unknown = next(r for r in rows if r.bioguide_id == "Z1")
    assert (unknown.committee_code, unknown.committee_name, unknown.chamber) == ("ZZ", "", "")
    first = next(r for r in rows if r.title == "Ranking Member")
    assert (first.congress, first.rank, first.chamber) == (119, 1, "senate")


def test_congress_years(spark):
    got = {r.congress: (r.first_year, r.second_year) for r in landing.congress_years(spark).collect()}
    assert got[111] == (2009, 2010) and got[119] == (2025, 2026) and len(got) == 9


def test_seeds_keep_leading_zeros(spark):
    states = seeds.load(spark, "state_abbreviations")
    assert states.count() == 56 and states.where("state_name = 'Alabama'").first().state_fips == "01"
    assert seeds.load(spark, "committee_industries").count() == 31
    path = str(seeds._HERE / "state_abbreviations.csv")
    assert sorted(map(tuple, seeds.load(spark, "state_abbreviations", path).collect())) == sorted(
        seeds.rows("state_abbreviations")
    )


def test_single_record_and_itemized_reads(spark):
    df = spark.createDataFrame(
        [("C1", 2024, "2024-01-01"), ("C1", 2024, "2024-02-01"), ("C1", 2022, "2022-01-01"), ("C2", 2024, None)],
        "candidate_id string, two_year_transaction_period int, d string",
    )
    newest = landing.itemized(df, "candidate_id", "C1", 2024, "d").collect()
    assert [r.d for r in newest] == ["2024-02-01", "2024-01-01"]
    assert landing.find_one(df, "candidate_id", "C2", "candidate").count() == 1
    with pytest.raises(landing.SourceError, match="'C9' not found"):
        landing.find_one(df, "candidate_id", "C9", "candidate")


def test_tagged_union(spark):
    parts = {"ny": spark.createDataFrame([("a",)], "id string"), "ca": spark.createDataFrame([("b",)], "id string")}
    assert sorted(map(tuple, landing.tagged_union(parts, "_state").collect())) == [("a", "ny"), ("b", "ca")]
