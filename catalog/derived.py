"""Raw civic tables derived from the given tables, whole and row by row.

A customer plays a member of congress, a part a candidate or a state bill, a line
item a reported total or a contribution, an order a federal bill or a committee seat,
an event a roll call. Seats and districts keep their size as the tables grow, but a
senator's seat is a whole state, which grows. ``FLAT`` holds one SQL text per table that Spark and the check
tool both run; ``raw_tables`` adds the nesting the sources have. Surnames are spelled
from a hash, so that some are equal, some alike and most are different.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import spark_sql


def surname(seed: str, length: str) -> str:
    return f"upper(translate(substr(md5({seed}), 1, {length}), '0123456789abcdef', 'aeioulnrstmkbdgp'))"


_MEMBER = f"""
select 'B' || cast(c_custkey as string) as bioguide_id,
       {surname("c_name", "cast(3 + c_custkey % 5 as int)")} || ', ' || c_mktsegment as name,
       case when c_custkey % 50 = 0 then null when c_custkey % 2 = LOAD - 1 then 'Democratic'
            else 'Republican' end as party,
       case when c_custkey % 97 = 0 then 'Nowhere' else s.state_name end as state,
       case when c_custkey % 9 = 0 then null else cast(floor(c_custkey / 560) as int) end as district,
       cast(110 + c_custkey % 10 as int) as latest_congress,
       '2024-01-' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') as update_date,
       [[micros]](LOAD) as load_at
from {{customer}} join {{states}} s on s.idx = c_custkey % 56
"""

_CANDIDATE = f"""
select 'C' || cast(p_partkey as string) as candidate_id,
       {surname("'Customer#' || lpad(cast(p_partkey as string), 9, '0')", "cast(3 + p_partkey % 4 as int)")}
           || case when p_partkey % 21 = 0 then '' else ', ' || upper(p_name) || '-x.y o''n' end as name,
       case when p_partkey % 31 = 0 then 'P' when p_partkey % 9 = 0 then 'S' else 'H' end as office,
       case when p_partkey % 9 = 0 then 'Senate' else 'House' end as office_full,
       case when p_partkey % 31 = 0 then null else s.state_abbr end as state,
       case when p_partkey % 9 = 0 then '' else '0' || cast(cast(floor(p_partkey / 560) as bigint) as string) end as district,
       substr(p_brand, 7, 3) as party,
       p_type as party_full,
       case p_size % (LOAD + 1) when 0 then 'I' when 1 then 'C' end as incumbent_challenge,
       p_size > 10 as has_raised_funds,
       [[micros]](LOAD) as load_at
from {{part}} join {{states}} s on s.idx = p_partkey % 56
"""


def _loaded_twice(template: str) -> str:
    return template.replace("LOAD", "1") + " union all " + template.replace("LOAD", "2")


FLAT = {
    "members": _loaded_twice(_MEMBER),
    "candidates": _loaded_twice(_CANDIDATE),
    "candidate_totals": """
select 'C' || cast(l_partkey as string) as candidate_id,
       cast(2010 + 2 * (year(l_shipdate) - 1995) as int) as cycle,
       case when l_partkey % 31 = 0 then 'P' when l_partkey % 9 = 0 then 'S' else 'H' end as office,
       case when l_tax = 0.08 and l_discount = 0.1 then 0.0 else l_extendedprice + l_quantity * 1000 end
           as receipts,
       l_extendedprice as disbursements,
       l_quantity as cash_on_hand_end_period,
       case when l_discount = 0.05 then null else l_extendedprice end as individual_itemized_contributions,
       l_tax * 100000 as individual_unitemized_contributions,
       case when l_tax = 0.03 then null else l_quantity * 1000 end as other_political_committee_contributions,
       [[micros]]([[epoch:l_shipdate]] + cast(round(l_extendedprice * 100) as bigint) * 100000
           + cast(l_quantity as bigint) * 1000
           + cast(round(l_discount * 100) as bigint) * 20 + cast(round(l_tax * 100) as bigint)) as load_at
from {lineitem}
""",
    "committees": """
select 'K' || cast(s_suppkey as string) as committee_id, s_name as name,
       substr('ABDJPUX', cast(1 + s_suppkey % 7 as int), 1) as designation,
       case when s_suppkey % 8 = 7 then null
            else substr('CLMTVWZ', cast(1 + s_suppkey % 8 as int), 1) end as organization_type,
       s.state_abbr as state, [[micros]](1) as load_at
from {supplier} join {states} s on s.idx = s_suppkey % 56
""",
    "memberships": """
select 'B' || cast(o_custkey as string) as bioguide_id,
       cast(110 + year(o_orderdate) - 1995 as int) as congress,
       case o_orderstatus when 'O' then 'house' when 'F' then 'senate' else 'joint' end as chamber,
       'K' || cast(o_orderkey % 9 as string) as committee_code,
       'Committee on ' || case cast(o_orderkey % 9 as int)
           when 0 then 'FINANCE' when 1 then 'Ways and Means and Health' when 2 then 'Rules'
           when 3 then 'Ceremonies' when 4 then 'Energy and Commerce'
           when 5 then 'Science Space Technology' when 6 then 'the judiciary'
           when 7 then 'Ethics' else 'Homeland Security, Labor and Budget' end as committee_name,
       case when o_orderkey % 11 = 0 then 'K' || cast(o_orderkey % 9 as string) || '01' end as subcommittee_code,
       case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 20 as int) end as rank,
       case when o_orderkey % 7 = 0 then 'Chair' end as title,
       [[micros]](o_orderkey) as load_at
from {orders}
""",
    "people": f"""
select 'P' || cast(s_suppkey as string) as id,
       'Pat ' || {surname("s_name", "cast(4 + s_suppkey % 4 as int)")} as name,
       case when s_suppkey % 3 = 0 then null else 'Party ' || cast(s_suppkey % 3 as string) end as party,
       'ny' as state,
       s_suppkey % 13 <> 0 as has_role,
       'Member' as role_title,
       case s_suppkey % 3 when 0 then 'upper' when 1 then 'lower' else 'both' end as role_class,
       case when s_suppkey % 17 = 0 then 'At Large' else cast(cast(floor(s_suppkey / 5) as bigint) as string) end as role_district,
       [[micros]](1) as load_at
from {{supplier}}
""",
    "ny_boe_activity": f"""
select cast(year(o_orderdate) as string) as election_year,
       'F' || cast(o_custkey as string) as filer_id,
       'Friends of ' || cast(o_custkey as string) as committee_name,
       'Alex ' || {surname("'Supplier#' || lpad(cast(cast(floor(o_custkey / 15) as bigint) as string), 9, '0')", "cast(4 + o_custkey % 3 as int)")}
           as candidate_name,
       case cast(o_orderkey % 5 as int) when 0 then 'Governor' when 1 then 'Member of Assembly'
           when 2 then 'State Senate' when 3 then 'State Senator' end as office,
       case when o_custkey % 17 = 0 then null else cast(cast(floor(o_custkey / 75) as bigint) as string) end as district,
       case when o_orderkey % 4 = 0 then '' else cast(o_totalprice as string) end as public_funds_received,
       cast(o_orderkey % 1000 as string) || '.5' as qualified_campaign_expenditures,
       [[micros]](o_orderkey) as load_at
from {{orders}}
""",
    "nyc_cfb_contributions": """
select cast(2017 + (l_orderkey % 3) * 4 as string) as election,
       'R' || cast(l_suppkey as string) as recipid,
       'Recipient ' || cast(l_suppkey as string) || ' ' || cast(l_orderkey % 3 as string) as recipname,
       case cast(l_orderkey % 7 as int) when 6 then 'IS' when 5 then null else '1' end as officecd,
       'T' || cast(l_orderkey % 2 as string) as refno,
       case when l_orderkey % 5 = 0 then '' else '01/15/' || cast(year(l_shipdate) as string) end as date,
       case when l_partkey % 3 = 0 then null else 'Donor ' || cast(l_partkey % 3 as string) || ' ' end as name,
       lpad(cast(l_partkey % 1000 as string), 5, '0') as zip,
       ' works ' || cast(l_partkey % 50 as string) as empname,
       cast(l_quantity * 0.25 as string) as amnt,
       cast(l_quantity * 0.5 as string) as matchamnt,
       cast(l_orderkey % 4 as string) as pay_method,
       [[micros]](l_orderkey * 1000000 + l_partkey % 1000000) as load_at
from {lineitem}
""",
    "bills": """
select 'ocd-' || cast(p_partkey as string) as id, 'HB ' || cast(p_partkey as string) as identifier,
       p_name as title, 'https://bills.example/' || cast(p_partkey as string) as openstates_url,
       'ny' as state, '2023-2024' as session,
       '2024-05-' || lpad(cast(1 + p_partkey % 28 as string), 2, '0') || 'T10:00:00' as updated_at,
       p_partkey as n, p_size as size, [[micros]](1) as load_at
from {part}
""",
    "congress_bills": """
select cast(111 + o_orderkey % 9 as int) as congress,
       case cast(o_orderkey % 6 as int) when 0 then 'hr' when 1 then 's' when 2 then 'hjres'
           when 3 then 'sjres' when 4 then 'hres' else 'sres' end as type,
       cast(o_orderkey as string) as number, o_orderpriority as title,
       case when o_orderkey % 2 = 0 then 'House' else 'Senate' end as origin_chamber,
       'https://api.example/' || cast(o_orderkey as string) as url,
       [[fmt_iso:o_orderdate]] as action_date, 'Referred ' || o_orderstatus as action_text,
       [[fmt_iso:o_orderdate]] as update_date, [[micros]](1) as load_at
from {orders}
""",
    "member_sponsorships": """
select 'B' || cast(o_custkey as string) as bioguide_id,
       cast(111 + o_orderkey % 9 as int) as congress,
       case cast(o_orderkey % 6 as int) when 0 then 'HR' when 1 then 'S' when 2 then 'HJRES'
           when 3 then 'SJRES' when 4 then 'HRES' else 'SRES' end as type,
       cast(o_orderkey + o_custkey % 2 as string) as number,
       case when o_orderkey % 10 = 0 then null else [[fmt_iso:o_orderdate]] end as introduced_date,
       [[micros]](o_orderkey) as load_at
from {orders}
""",
    "roll_calls": """
select event_id, user_id, ts, cast(111 + event_id % 9 as int) as congress,
       case when event_type = 'error' then 'QUORUM' else case cast(event_id % 6 as int)
           when 0 then 'HR' when 1 then 'S' when 2 then 'HJRES' when 3 then 'SJRES'
           when 4 then 'HRES' else 'SRES' end || ' ' || cast(event_id as string) end as legis_num,
       case event_type when 'click' then 'yes' when 'view' then 'no' when 'purchase' then 'abstain'
           when 'signup' then 'present' else 'guilty' end as choice,
       [[fmt_house:ts]] as house_date, [[fmt_senate:ts]] as senate_date,
       value > 50 as passed
from {events}
""",
    "congressional_districts": """
select 'District ' || cast(s_suppkey as string) as name, s.state_fips as state,
       case when s_suppkey % 17 = 0 then 'ZZ' else '' end || cast(s_suppkey as string) as number,
       case when s_suppkey % 19 = 0 then 0 else s_suppkey * 997 + 1009 end as total,
       cast(floor(abs(s_acctbal)) as bigint) as part_pop, [[micros]](1) as load_at
from {supplier} join {states} s on s.idx = s_suppkey % 56
""",
    "states": """
select n_name as name, s.state_fips as state, cast(n_nationkey as bigint) * 1000 + 77 as total,
       cast(n_nationkey as bigint) * 13 as part_pop, [[micros]](1) as load_at
from {nation} join {states} s on s.idx = n_nationkey
""",
}

# How many of the five population shares take part_pop divided by this number.
SHARE_DIVISORS = {
    "pop_white_alone": 1, "pop_black_alone": 2, "pop_hispanic_latino": 3,
    "pop_bachelors_degree": 4, "pop_health_insurance": 5,
}


# Rows of a nested table that one task makes.
ROWS_A_TASK = 100_000


def _lit(value, dtype: str = "string") -> Column:
    return F.lit(value).cast(dtype)


def _population() -> list[Column]:
    shares = [
        F.floor(F.col("part_pop") / d).cast("string").alias(name)
        for name, d in SHARE_DIVISORS.items()
    ]
    return [
        F.col("total").cast("string").alias("total_population"),
        F.col("part_pop").cast("string").alias("median_household_income"),
        *shares,
    ]


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Short rows that are about to become long ones, dealt into as many tasks as their number asks for.

    Millions of them fit one split of a file, and one task would nest, sort and write them all.
    """
    tasks = -(-rows.count() // ROWS_A_TASK)
    return rows.repartition(tasks, key) if tasks > 1 else rows


def _nested(name: str, key: str, shape: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: shape(_spread(spark_sql(spark, sf_dir, FLAT[name]), key))


def _flat(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark_sql(spark, sf_dir, FLAT[name])


def _from(name: str, shape: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: shape(spark_sql(spark, sf_dir, FLAT[name]))


def _with_nulls(df: DataFrame, *names: str) -> DataFrame:
    return df.select("*", *[_lit(None).alias(n) for n in names])


def _voter(offset: int, prefix: str, id_name: str, choice: Column) -> Column:
    number = (F.col("user_id") + offset).cast("string")
    return F.struct(
        F.concat(F.lit(prefix), number).alias(id_name),
        F.concat(F.lit("Voter "), number).alias("name"),
        _lit("I").alias("party"),
        _lit("NY").alias("state"),
        choice.alias("option"),
    )


def _ballots(prefix: str, id_name: str) -> Column:
    votes = F.array(
        _voter(0, prefix, id_name, F.col("choice")),
        _voter(1, prefix, id_name, F.lit("yes")),
        _voter(2, prefix, id_name, F.lit("no")),
    )
    return F.when(F.col("event_id") % 10 != 0, votes)


def _roll_call(chamber: str, session: Column, own: list[Column], votes: Column) -> Callable[[DataFrame], DataFrame]:
    return lambda calls: calls.select(
        F.lit(chamber).alias("chamber"),
        F.col("congress").cast("string").alias("congress"),
        session.alias("session"),
        *own,
        "legis_num",
        F.lit("On Passage").alias("vote_question"),
        F.when(F.col("passed"), "Passed").otherwise("Failed").alias("vote_result"),
        votes.alias("member_votes"),
        F.timestamp_micros(F.lit(1)).alias("load_at"),
    )


def _house(calls: DataFrame) -> DataFrame:
    own = [
        F.col("event_id").alias("roll_number"), F.lit(2024).alias("year"),
        F.col("house_date").alias("action_date"),
    ]
    session = F.when(F.col("event_id") % 2 == 0, "1st").otherwise("2nd")
    return _roll_call("house", session, own, _ballots("B", "bioguide_id"))(calls)


def _senate(calls: DataFrame) -> DataFrame:
    own = [
        F.col("event_id").cast("string").alias("vote_number"), F.col("senate_date").alias("vote_date"),
    ]
    return _roll_call("senate", F.lit("1"), own, _ballots("S", "lis_member_id"))(calls)


def _sponsor(name: Column, kind: str, primary: Column, person: Column) -> Column:
    return F.struct(
        name.alias("name"), F.lit(kind).alias("entity_type"), primary.alias("primary"),
        F.when(primary, "primary").otherwise("cosponsor").alias("classification"),
        F.struct(person.alias("id")).alias("person"),
    )


def _state_bills(bills: DataFrame) -> DataFrame:
    c = F.col
    person = F.concat(F.lit("P"), (c("n") % 120).cast("string"))
    sponsors = F.array(
        _sponsor(F.concat(F.lit("Sponsor "), person), "person", c("size") > 25, person),
        _sponsor(F.lit("League"), "organization", F.lit(False), _lit(None)),
    )

    def event(k: int, options: list[str]) -> Column:
        votes = [
            F.struct(
                F.concat(F.lit(f"Voter {i} "), person).alias("voter_name"),
                F.lit(option).alias("option"),
                F.struct(F.when(F.lit(i == 0), person).alias("id")).alias("voter"),
            )
            for i, option in enumerate(options)
        ]
        return F.struct(
            F.concat(F.lit(f"ve{k}-"), c("id")).alias("id"), F.lit(f"Motion {k}").alias("motion_text"),
            F.lit("pass").alias("result"), F.lit(f"2024-06-0{k}T00:00:00").alias("start_date"),
            F.array(*votes).alias("votes"),
        )

    events = F.array(event(1, ["yes", "no"]), event(2, ["yes", "excused"]))
    return bills.select(
        "id", "identifier", "title", "openstates_url", c("state").alias("_state"), "session",
        c("updated_at").alias("created_at"), "updated_at",
        F.when(c("n") % 10 != 0, sponsors).alias("sponsorships"),
        F.when(c("n") % 10 != 1, events).alias("votes"),
        "load_at",
    )


def _federal_bills(bills: DataFrame) -> DataFrame:
    c = F.col
    action = F.struct(c("action_date").alias("actionDate"), c("action_text").alias("text"))
    return bills.select(
        "congress", "type", "number", "title", c("origin_chamber").alias("originChamber"), "url",
        action.alias("latestAction"), c("update_date").alias("updateDate"), "load_at",
    )


def _sponsored(rows: DataFrame) -> DataFrame:
    c = F.col
    action = F.struct(c("introduced_date").alias("actionDate"), _lit("x").alias("text"))
    return rows.select(
        c("bioguide_id").alias("_bioguide_id"), "congress", "type", "number",
        _lit(None).alias("title"), c("introduced_date").alias("introducedDate"),
        F.struct(_lit("Health").alias("name")).alias("policyArea"),
        action.alias("latestAction"), "load_at",
    )


def _members(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.select(
        c("bioguide_id").alias("bioguideId"), "name", c("party").alias("partyName"), "state",
        "district", F.array(F.struct(c("latest_congress").alias("congress"))).alias("terms"),
        c("update_date").alias("updateDate"), "load_at",
    )


def _people(rows: DataFrame) -> DataFrame:
    c = F.col
    role = F.struct(
        c("role_title").alias("title"), c("role_class").alias("org_classification"),
        c("role_district").alias("district"),
    )
    return rows.select(
        "id", "name", "party", c("state").alias("_state"),
        F.when(c("has_role"), role).alias("current_role"),
        _lit("2024-01-01T00:00:00").alias("created_at"),
        _lit("2024-01-02T00:00:00").alias("updated_at"), "load_at",
    )


def _chamber_committees(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("committee_id").alias("systemCode"), "name", _lit(None).alias("url"), "load_at"
    )


# How each of the 17 raw tables is made; the nested columns are built row by row.
RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "members": _from("members", _members),
    "candidates": _flat("candidates"),
    "candidate_totals": _from(
        "candidate_totals",
        lambda df: _with_nulls(df, "name", "office_full", "state", "district", "party_full"),
    ),
    "committees": _from(
        "committees",
        lambda df: _with_nulls(
            df, "committee_type", "committee_type_full", "party", "filing_frequency"
        ),
    ),
    "house_committees": _from("committees", _chamber_committees),
    "senate_committees": _from("committees", _chamber_committees),
    "congress_committee_memberships": _from(
        "memberships", lambda df: _with_nulls(df, "subcommittee_name", "party")
    ),
    "people": _from("people", _people),
    "ny_boe_activity": _flat("ny_boe_activity"),
    "nyc_cfb_contributions": _from(
        "nyc_cfb_contributions",
        lambda df: _with_nulls(df, "filing", "schedule", "city", "state", "occupation", "c_code")
        .withColumn("cycle_year", F.lit(2021)),
    ),
    "bills": _nested("bills", "id", _state_bills),
    "congress_bills": _nested("congress_bills", "number", _federal_bills),
    "congress_member_sponsorships": _nested("member_sponsorships", "number", _sponsored),
    "congress_house_votes": _nested("roll_calls", "event_id", _house),
    "congress_senate_votes": _nested("roll_calls", "event_id", _senate),
    "congressional_districts": _from(
        "congressional_districts",
        lambda df: df.select(
            "name", "state", F.col("number").alias("congressional_district"), *_population(), "load_at"
        ),
    ),
    "states": _from("states", lambda df: df.select("name", "state", *_population(), "load_at")),
}


def raw_tables(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The named raw tables, lazily."""
    return {name: RAW[name](spark, sf_dir) for name in names}
