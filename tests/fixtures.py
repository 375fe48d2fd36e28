"""A small set of raw tables with the awkward rows of every source."""

from datetime import datetime

from rostra import schemas

OLD, NEW = datetime(2025, 1, 1), datetime(2025, 2, 1)


def _table(spark, name, rows, extra=""):
    ddl = f"{schemas.RAW[name]}{extra}, load_at timestamp"
    return spark.createDataFrame(rows, ddl)


def _candidate(cid, name, office, state, district, load=NEW, status="I"):
    return (cid, name, office, {"H": "House", "S": "Senate", "P": "President"}[office], state, district,
            "DEM", "Democratic Party", status, True, load)


def _totals(cid, cycle, office, receipts, pac, small=None, load=NEW):
    return (cid, cycle, None, office, None, None, None, None, receipts, 4800000.0, 200000.0, 2500000.0, pac, small, load)


def _member(bid, name, state, district, congress=119, load=NEW, party="Democratic"):
    return (bid, name, party, state, district, [(congress,)], "2025-01-01T00:00:00Z", load)


def _seat(bid, code, name, sub=None, congress=119, rank=1):
    return (bid, congress, "senate", code, name, sub, None, rank, "Member", "majority", NEW)


def _gift(rid, amount, office="1", date="01/15/2021", name="John Doe", load=NEW):
    return ("2021", rid, f"Recipient {rid}", office, "FULL", "ABC", "REF1", date, name, "IND", "Brooklyn", "NY",
            "11201", "Engineer", "ACME", amount, "0", "2", 2021, load)


def raw(spark):
    person = {"p1": [("Sponsor One", "person", True, "primary", ("ocd-1",)),
                     ("League", "organization", False, "cosponsor", (None,)),
                     ("Unknown", "person", False, "cosponsor", (None,))]}
    events = [("ve1", "Passage", "pass", "2025-03-01T12:00:00",
               [("Pat Lee", "yes", ("ocd-1",)), ("Sam Poe", "no", (None,))]),
              ("ve2", "Empty", "fail", "2025-03-02", None)]
    return {
        "members": _table(spark, "members", [
            _member("W1", "Wyden, Ron", "Oregon", None),
            _member("W1", "Old, Name", "Oregon", None, load=OLD),
            _member("S1", "Smith, Adam", "New York", 14, 118),
            _member("S2", "Smyth, Zed", "New York", 14),
            _member("A1", "Jones, Al", "Alaska", 0),
            _member("N1", ", Nobody", "New York", 3),
        ]),
        "candidates": _table(spark, "candidates", [
            _candidate("S6OR", "WYDEN, RON", "S", "OR", ""),
            _candidate("S6OR", "WRONG, OLD", "S", "OR", "", OLD),
            _candidate("H1NY", "SMITH, ADAM", "H", "NY", "14"),
            _candidate("H2AK", "JONES-O'NEIL, AL", "H", "AK", "00"),
            _candidate("H3NY", "PLATO", "H", "NY", "03", status="C"),
            _candidate("P1", "WYDEN, RON", "P", "OR", ""),
        ]),
        "candidate_totals": _table(spark, "candidate_totals", [
            _totals("S6OR", 2024, "S", 5000000.0, 1800000.0, 500000.0),
            _totals("S6OR", 2024, "S", 1.0, 1.0, None, OLD),
            _totals("S6OR", 2022, "S", 100.0, 60.0),
            _totals("S6OR", 2020, "S", 0.0, 5.0),
            _totals("H1NY", 2024, "H", 1000.0, None),
            _totals("H1NY", 2022, "H", None, 5.0),
            _totals("P1", 2024, "P", 9.0, 9.0),
        ], ", individual_unitemized_contributions double"),
        "committees": _table(spark, "committees", [
            ("C1", "One", "N", None, "D", "NY", None, "L", "Q", NEW),
            ("C2", "Two", "N", None, "Z", "NY", None, None, "Q", NEW),
        ]),
        "congress_committee_memberships": _table(spark, "congress_committee_memberships", [
            _seat("W1", "SSFI", "Senate Committee on Finance"),
            _seat("W1", "SSFI", "Senate Committee on Finance", "SSFI01"),
            _seat("W1", "SSEG", "Energy and Commerce and Health", congress=118),
            _seat("S1", "HSXX", "Ceremonies"),
            _seat("Z9", "HSXX", "Ceremonies"),
        ]),
        "people": _table(spark, "people", [
            ("ocd-1", "Pat Lee", "Dem", "ny", ("Senator", "upper", "12"), "2024-01-01", "2024-01-02", NEW),
            ("ocd-2", "Kim Leigh", None, "ny", ("Member", "lower", "12"), "2024-01-01", "2024-01-02", NEW),
            ("ocd-3", "No Role", None, "ny", None, "2024-01-01", "2024-01-02", NEW),
        ]),
        "ny_boe_activity": _table(spark, "ny_boe_activity", [
            ("2024", "F1", "Friends", "Patricia LEE", "State Senate", "12", "500.49", "", NEW),
            ("2022", "F1", "Friends", "Pat LEE", "State Senate", "12", "", "0.5", NEW),
            ("2022", "F2", "Ticket", "Gov Ernor", "Governor", None, "", "", NEW),
            ("2024", "F2", "Ticket", "Lieutenant Longname", "Lt. Governor", None, "", "", NEW),
            ("2024", "F3", "Other", "Ann Other", "State Senator", "12", "", "", NEW),
            ("2024", "F4", "Nobody", None, "Governor", None, "", "", NEW),
        ]),
        "nyc_cfb_contributions": _table(spark, "nyc_cfb_contributions", [
            _gift("R1", "500.49"), _gift("R1", "500.49"), _gift("R1", "0.50", date=""),
            _gift("R1", "0.49"), _gift("R1", "-5"), _gift("R1", None),
            _gift("R2", "10", office="IS"), _gift("R3", "10", office=None), _gift("R4", "10", name=None),
        ]),
        "bills": _table(spark, "bills", [
            ("b1", "HB 1", "Title", "http://x", "ny", "2025", "2025-01-01", "2025-01-02T03:04:05", person["p1"], events, NEW),
            ("b2", "HB 2", "Title", "http://x", "ny", "2025", "2025-01-01", "2025-01-02", [], None, NEW),
        ]),
        "congress_bills": _table(spark, "congress_bills", [
            (119, "HR", "22", "A bill", "House", "http://y", ("2025-01-15", "Referred"), "2025-01-16", NEW),
        ]),
        "congress_member_sponsorships": _table(spark, "congress_member_sponsorships", [
            ("S1", 119, "hr", "22", "A bill", "2025-01-03", ("Health",), ("2025-01-15", "Referred"), NEW),
            ("S1", 119, "HR", "23", "No bill", None, None, None, NEW),
        ]),
        "congress_house_votes": _table(spark, "congress_house_votes", [
            ("house", "119", "1", 7, 2025, "HR 22", "On Passage", "Passed", "3-Jan-2025",
             [("S1", "Smith", "D", "NY", "yes"), (None, "Ghost", "D", "NY", "no")], NEW),
            ("house", "119", "1", 8, 2025, "QUORUM", "Quorum", "Passed", "4-Jan-2025", [("S1", "Smith", "D", "NY", "present")], NEW),
            ("house", "119", "1", 9, 2025, "H. R. 22", "On Passage", "Passed", "5-Jan-2025", [("S1", "Smith", "D", "NY", "no")], NEW),
        ]),
        "congress_senate_votes": _table(spark, "congress_senate_votes", [
            ("senate", "119", "1", "5", "January 9, 2025,  02:54 PM", None, "Motion", "Agreed",
             [("S354", "Baldwin (D-WI)", "D", "WI", "guilty")], NEW),
        ]),
        "congressional_districts": _table(spark, "congressional_districts", [
            ("CD 14", "36", "14", "1000", "50000", "500", "250", "125", "63", "1000", NEW),
            ("CD ZZ", "36", "ZZ", "0", None, "0", None, "0", "0", "0", NEW),
        ]),
        "states": _table(spark, "states", [("New York", "36", "2000", "1", "1", "1", "1", "1", "1", NEW)]),
    }
