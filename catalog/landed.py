"""Source readers over payloads that Spark first writes from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostra import sinks
from rostra.operators import nested
from rostra.session import shared_dir
from rostra.sinks import ledger
from rostra.sources import committees, landing, rollcalls

from .basics import registered as _registered
from .tables import table

c = F.col

# Members whose map is one file.
MEMBERS_A_FILE = 20_000


@_registered(
    "select c_custkey, c_name, c_mktsegment, 'page' || (c_custkey % 3) as _state from customer where c_custkey is not null"
)
def page_json(spark: SparkSession, sf: str) -> DataFrame:
    """One landed page per customer pair of records, in a folder per owner."""
    path = shared_dir(spark, "pages")
    record = F.struct("c_custkey", "c_name", "c_mktsegment")
    pages = table(spark, sf, "customer").select(
        F.to_json(
            F.struct(
                F.array(record).alias("results"),
                F.struct(F.lit(1).alias("page"), F.lit(2).alias("pages")).alias("pagination"),
            )
        ).alias("value"),
        F.concat(F.lit("page"), (c("c_custkey") % 3).cast("string")).alias("_state"),
    )
    pages.write.partitionBy("_state").text(path)
    schema = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment").schema
    return landing.read_pages(spark, path, "results", schema, ["_state"], multi_line=False)


@_registered(
    "select 'Customer ' || c_custkey as name, cast(c_nationkey as varchar) as state, cast(c_custkey as varchar) as total_population, "
    "null::varchar as pop_white_alone from customer"
)
def census_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """One two-row matrix per customer: a header and a row of values."""
    path = shared_dir(spark, "matrix")
    header = F.array(*[F.lit(v) for v in ["NAME", "B01003_001E", "B02001_002E", "state"]])
    row = F.array(
        F.concat(F.lit("Customer "), c("c_custkey").cast("string")), c("c_custkey").cast("string"),
        F.lit(None).cast("string"), c("c_nationkey").cast("string"),
    )
    table(spark, sf, "customer").select(F.to_json(F.array(header, row)).alias("value")).write.text(path)
    columns = {
        "name": "NAME", "state": "state", "total_population": "total_population",
        "pop_white_alone": "pop_white_alone",
    }
    return landing.read_matrix(spark, path, columns, whole_file=False)


@_registered(
    "select cast(year(o_orderdate) as varchar) as election_year, 'F' || o_custkey as filer_id, 'Order ' || o_orderkey as committee_name, "
    "o_orderpriority as candidate_name, o_orderstatus as office, cast(o_custkey % 20 as varchar) as district, "
    "case when o_orderstatus = 'O' then null else cast(o_orderkey as varchar) end as public_funds_received, "
    "cast(o_orderkey % 7 as varchar) as qualified_campaign_expenditures from orders"
)
def csv_union(spark: SparkSession, sf: str) -> DataFrame:
    """Activity files in two column orders, one with a further column; an empty amount reads as NULL."""
    path = shared_dir(spark, "activity")
    values = [
        F.year("o_orderdate"), F.concat(F.lit("F"), c("o_custkey").cast("string")),
        F.concat(F.lit("Order "), c("o_orderkey").cast("string")), c("o_orderpriority"),
        c("o_orderstatus"), c("o_custkey") % 20,
        F.when(c("o_orderstatus") != "O", c("o_orderkey").cast("string")), c("o_orderkey") % 7,
    ]
    named = [v.cast("string").alias(h) for v, h in zip(values, landing.ACTIVITY_HEADER)]
    orders = table(spark, sf, "orders")
    orders.where("o_orderkey % 2 = 0").select(*named).write.csv(path, header=True)
    turned = [F.lit("n").alias("Notes"), *reversed(named)]
    orders.where("o_orderkey % 2 = 1").select(*turned).write.mode("append").csv(path, header=True)
    return landing.read_activity(spark, path)


@_registered(
    "select 'R' || l_suppkey as recipid, cast(l_orderkey as varchar) as refno, cast(l_quantity as varchar) as amnt, "
    "[2017, 2021, 2027][1 + l_linenumber % 3] as cycle_year from lineitem"
)
def cycle_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Contribution files in a folder per cycle, in two column orders; all landed cycles are read."""
    path = shared_dir(spark, "contributions")
    given = {
        "recipid": F.concat(F.lit("R"), c("l_suppkey").cast("string")),
        "refno": c("l_orderkey").cast("string"),
        "amnt": c("l_quantity").cast("string"),
        "cycle_year": F.array(F.lit(2017), F.lit(2021), F.lit(2027))[c("l_linenumber") % 3],
    }
    schema = landing.table_schema("nyc_cfb_contributions")
    named = [given.get(f.name, F.lit(None).cast("string")).alias(f.name) for f in schema.fields]
    lines = table(spark, sf, "lineitem")
    for rest, order in ((0, named), (1, named[::-1])):
        part = lines.where(c("l_suppkey") % 2 == rest).select(*order)
        part.write.partitionBy("cycle_year").mode("append").csv(path, header=True)
    read = landing.read_contributions(spark, path)
    return read.select("recipid", "refno", "amnt", "cycle_year")


@_registered(
    "select cast(111 + event_id % 9 as varchar) as congress, cast(event_id % 50 as int) as roll_number, "
    "cast(2020 + event_id % 2 as int) as year, event_id, 'HR ' || event_id as legis_num, 'B' || (user_id + v.i) as bioguide_id, "
    "'Voter ' || (user_id + v.i) as name, case v.i when 0 then 'yes' when 1 then 'abstain' else 'maybe' end as option "
    "from events cross join (values (0), (1), (2)) v(i)"
)
def xml_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Roll calls with three recorded votes each, in the House layout, in a folder per year and roll."""
    path = shared_dir(spark, "rollcalls")

    def vote(i: int, printed: str):
        number = (c("user_id") + i).cast("string")
        return F.struct(
            F.struct(
                F.concat(F.lit("Voter "), number).alias("_VALUE"),
                F.concat(F.lit("B"), number).alias("_name-id"),
                F.lit("D").alias("_party"), F.lit("NY").alias("_state"),
            ).alias("legislator"),
            F.lit(printed).alias("vote"),
        )

    event = c("event_id").cast("string")
    meta = F.struct(
        (c("event_id") % 9 + 111).cast("string").alias("congress"),
        F.lit("1").alias("session"),
        F.concat(F.lit("HR "), event).alias("legis-num"),
        F.lit("").alias("vote-question"),
        event.alias("vote-result"),
        F.lit("3-Jan-2025").alias("action-date"),
    )
    ballots = F.array(vote(0, "Yea"), vote(1, "Not Voting"), vote(2, "MAYBE"))
    calls = table(spark, sf, "events").select(
        meta.alias("vote-metadata"), F.struct(ballots.alias("recorded-vote")).alias("vote-data"),
        (c("event_id") % 2 + 2020).alias("year"), (c("event_id") % 50).alias("roll"),
    )
    calls = calls.repartition("year", "roll").write.partitionBy("year", "roll").format("xml")
    calls.option("rootTag", "votes").option("rowTag", "rollcall-vote").save(path)
    read = rollcalls.house_votes(spark, path)
    return read.select(
        "congress", "roll_number", "year", c("vote_result").cast("bigint").alias("event_id"), "legis_num",
        F.explode("member_votes").alias("v"),
    ).select(
        "congress", "roll_number", "year", "event_id", "legis_num", "v.bioguide_id", "v.name", "v.option"
    )


@_registered(
    "select cast(111 + event_id % 9 as varchar) as congress, cast(event_id as varchar) as vote_number, "
    "case when event_type <> 'error' then 'S. ' || event_id end as legis_num, 'S' || user_id as lis_member_id, "
    "case when event_type = 'click' then 'no' else 'present' end as option from events"
)
def senate_xml_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Roll calls in the Senate layout; some name no document."""
    path = shared_dir(spark, "senate")
    event = c("event_id").cast("string")
    member = F.struct(
        F.concat(F.lit("S"), c("user_id").cast("string")).alias("lis_member_id"),
        F.lit("Some One (D-NY)").alias("member_full"), F.lit("D").alias("party"),
        F.lit("NY").alias("state"),
        F.when(c("event_type") == "click", "Nay").otherwise("Present").alias("vote_cast"),
    )
    calls = table(spark, sf, "events").select(
        (c("event_id") % 9 + 111).cast("string").alias("congress"), F.lit("1").alias("session"),
        event.alias("vote_number"), F.lit("January 9, 2025,  02:54 PM").alias("vote_date"),
        F.struct(
            F.when(c("event_type") != "error", "S.").otherwise("").alias("document_type"),
            event.alias("document_number"),
        ).alias("document"),
        F.struct(F.array(member).alias("member")).alias("members"),
    )
    calls.write.format("xml").option("rootTag", "votes").option("rowTag", "roll_call_vote").save(path)
    read = rollcalls.senate_votes(spark, path)
    return read.select("congress", "vote_number", "legis_num", F.explode("member_votes").alias("v")).select(
        "congress", "vote_number", "legis_num", "v.lis_member_id", "v.option"
    )


@_registered(
    "select 'B' || c_custkey as bioguide_id, case c_custkey % 3 when 0 then 'K' || n_nationkey when 1 then 'K' || n_nationkey else 'X' end as committee_code, "
    "case when c_custkey % 3 = 2 then '' else n_name end as committee_name, "
    "case when c_custkey % 3 = 1 then 'K' || n_nationkey || '01' end as subcommittee_code, "
    "case when c_custkey % 3 = 1 then 'Sub of ' || n_name end as subcommittee_name, "
    "case when c_custkey % 3 = 2 then '' else 'senate' end as chamber from customer join nation on n_nationkey = c_nationkey"
)
def committee_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Customers sit on a nation's committee, on its subcommittee, or on an unknown one."""
    nation = c("n_nationkey").cast("string")
    sub = F.struct(F.lit("01").alias("thomas_id"), F.concat(F.lit("Sub of "), c("n_name")).alias("name"))
    lists = table(spark, sf, "nation").select(
        F.concat(F.lit("K"), nation).alias("thomas_id"), c("n_name").alias("name"),
        F.lit("senate").alias("type"), F.array(sub).alias("subcommittees"),
    )
    home = F.concat(F.lit("K"), c("c_nationkey").cast("string"))
    code = (
        F.when(c("c_custkey") % 3 == 0, home)
        .when(c("c_custkey") % 3 == 1, F.concat(home, F.lit("01")))
        .otherwise("X")
    )
    person = F.struct(
        F.concat(F.lit("B"), c("c_custkey").cast("string")).alias("bioguide"),
        F.lit(1).alias("rank"), F.lit("Chair").alias("title"), F.lit("majority").alias("party"),
    )
    nobody = F.struct(
        F.lit(None).cast("string").alias("bioguide"),
        F.lit(2).alias("rank"), F.lit("Chair").alias("title"), F.lit("majority").alias("party"),
    )
    maps = table(spark, sf, "customer").select(F.create_map(code, F.array(person, nobody)).alias("m"))
    rows = committees.flatten_memberships(maps, lists, 119)
    return rows.select(
        "bioguide_id", "committee_code", "committee_name", "subcommittee_code", "subcommittee_name",
        "chamber",
    )


@_registered(
    "select o_orderkey, cast(2009 + 2 * (o_orderkey % 9) as bigint) as first_year, cast(2010 + 2 * (o_orderkey % 9) as bigint) as second_year from orders"
)
def congress_years(spark: SparkSession, sf: str) -> DataFrame:
    first = landing.congress_start_year(c("o_orderkey") % 9 + 111)
    return table(spark, sf, "orders").select(
        "o_orderkey", first.alias("first_year"), (first + 1).alias("second_year")
    )


@_registered(
    "select 'C' || o_custkey as candidate_id, o_orderkey as cycle, cast(o_totalprice as double) as receipts, "
    "case when o_orderkey % 2 = 1 then cast(o_custkey as double) end as candidate_contribution from orders"
)
def raw_table(spark: SparkSession, sf: str) -> DataFrame:
    """A raw table of two loads, the second of which has a column more."""
    root = shared_dir(spark, "raw")
    orders = table(spark, sf, "orders")
    first = [
        F.concat(F.lit("C"), c("o_custkey").cast("string")).alias("candidate_id"),
        c("o_orderkey").cast("int").alias("cycle"), c("o_totalprice").cast("double").alias("receipts"),
    ]
    more = c("o_custkey").cast("double").alias("candidate_contribution")
    sinks.load_table(orders.where("o_orderkey % 2 = 0").select(*first), root, "candidate_totals")
    sinks.load_table(orders.where("o_orderkey % 2 = 1").select(*first, more), root, "candidate_totals")
    read = landing.raw_table(spark, root, "candidate_totals")
    return read.select("candidate_id", c("cycle").cast("bigint"), "receipts", "candidate_contribution")


@_registered(
    "select o_orderkey, o_orderdate from orders where o_custkey = 7 and o_orderstatus = 'O'"
)
def itemized_receipts(spark: SparkSession, sf: str) -> DataFrame:
    """Receipts of one candidate in one period, newest first."""
    receipts = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", c("o_custkey").cast("string").alias("candidate_id"),
        F.when(c("o_orderstatus") == "O", 2024).otherwise(2022).alias("two_year_transaction_period"),
    )
    found = landing.itemized(receipts, "candidate_id", "7", 2024, "o_orderdate")
    return found.select("o_orderkey", "o_orderdate")


@_registered("select c_custkey, c_name from customer where c_custkey = 5")
def single_record(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return landing.find_one(customers, "c_custkey", 5, "customer")


@_registered("select n_nationkey, n_name from nation")
def raw_file(spark: SparkSession, sf: str) -> DataFrame:
    """A raw file written twice holds what was written last."""
    path = f"{shared_dir(spark, 'raw-file')}/nations"
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    for rows in (nations.where("n_nationkey > 3"), nations):
        sinks.write_raw_file(rows, path)
    return spark.read.schema(nations.schema).parquet(path)


@_registered(
    "select 'P' || s_suppkey as id, s_name as name, 'upper' as chamber, 's' || (s_suppkey % 4) as _state from supplier where s_suppkey % 4 <> 3"
)
def table_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of one table in a folder per state; those in the folder without a state are skipped."""
    path = shared_dir(spark, "people-pages")
    person = F.struct(
        F.concat(F.lit("P"), c("s_suppkey").cast("string")).alias("id"), c("s_name").alias("name"),
        F.struct(F.lit("Senator").alias("title"), F.lit("upper").alias("org_classification")).alias("current_role"),
    )
    rest = (c("s_suppkey") % 4).cast("string")
    pages = table(spark, sf, "supplier").select(
        F.to_json(F.struct(F.array(person).alias("results"))).alias("value"),
        F.when(rest != "3", F.concat(F.lit("s"), rest)).alias("_state"),
    )
    pages.write.partitionBy("_state").text(path)
    read = landing.read_table_pages(spark, path, "people", tag="_state", multi_line=False)
    return read.select("id", "name", c("current_role.org_classification").alias("chamber"), "_state")


@_registered(
    "select 'B' || c_custkey as bioguide_id, cast(119 as bigint) as congress, 'K' || n_nationkey as committee_code, n_name as committee_name, "
    "case when c_custkey % 2 = 1 then 'K' || n_nationkey || '01' end as subcommittee_code, 'senate' as chamber, "
    "cast(c_custkey % 5 as bigint) as rank from customer join nation on n_nationkey = c_nationkey"
)
def membership_files(spark: SparkSession, sf: str) -> DataFrame:
    """A file with the list of committees, and files with the map of members per committee."""
    root = shared_dir(spark, "committee-files")
    nation = c("n_nationkey").cast("string")
    sub = F.struct(F.lit("01").alias("thomas_id"), F.concat(F.lit("Sub of "), c("n_name")).alias("name"))
    entry = F.struct(
        F.concat(F.lit("K"), nation).alias("thomas_id"), c("n_name").alias("name"), F.lit("senate").alias("type"),
        F.array(sub).alias("subcommittees"),
    )
    # Nations are 25 at every scale.
    listed = table(spark, sf, "nation").agg(F.to_json(F.collect_list(entry)).alias("value"))
    listed.coalesce(1).write.text(f"{root}/committees")
    person = F.struct(
        F.concat(F.lit("B"), c("c_custkey").cast("string")).alias("bioguide"),
        (c("c_custkey") % 5).cast("int").alias("rank"), F.lit("Member").alias("title"), F.lit("majority").alias("party"),
    )
    code = F.concat(F.lit("K"), c("c_nationkey").cast("string"), F.when(c("c_custkey") % 2 == 1, "01").otherwise(""))
    # A file is one map of the members in a range of keys, so files are few and their size is bounded.
    dealt = table(spark, sf, "customer").select(
        F.floor(c("c_custkey") / MEMBERS_A_FILE).alias("file"), code.alias("code"), person.alias("person")
    )
    of_code = dealt.groupBy("file", "code").agg(F.collect_list("person").alias("members"))
    maps = of_code.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("code", "members"))).alias("m"))
    maps.select(F.to_json("m").alias("value"), "file").write.partitionBy("file").text(f"{root}/members")
    read = committees.read_memberships(spark, f"{root}/members", f"{root}/committees", 119)
    return read.select(
        "bioguide_id", c("congress").cast("bigint"), "committee_code", "committee_name", "subcommittee_code", "chamber",
        c("rank").cast("bigint"),
    )


_MIXED = (
    "case event_id % 5 when 0 then '{{\"k\": ' || k || '}}' when 1 then '{{\"k\": [' || k || ', \"x\", ' || (k + 1) || ']}}' "
    "when 2 then '{{\"k\": {{\"v\": ' || k || '}}}}' when 3 then '{{\"other\": 1}}' else 'not json' end"
).replace("{{", "{").replace("}}", "}")


@_registered(
    "select event_id, case event_id % 5 when 0 then k end as k, case event_id % 5 when 2 then k end as inner_k, "
    "case event_id % 5 when 0 then 1 when 1 then 3 end as n_values, case event_id % 5 when 0 then k when 1 then 2 * k + 1 end as total "
    "from (select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events)"
)
def drifting_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """A field that is a number, a list or an object by turns, or missing."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    mixed = table(spark, sf, "events").withColumn("k", k).select("event_id", F.expr(_MIXED).alias("doc"))
    many = nested.one_or_many("doc", "$.k", "bigint")
    return mixed.select(
        "event_id", nested.drifting("doc", "$.k", "bigint").alias("k"), nested.drifting("doc", "$.k.v", "bigint").alias("inner_k"),
        F.size(many).cast("bigint").alias("n_values"),
        F.reduce(many, F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v, F.lit(0).cast("bigint"))).alias("total"),
    )


@_registered(
    "select 'states' as \"table\", 'N' || n_nationkey as key, n_name as name from nation union all "
    "select 'candidates', 'C' || s_suppkey, s_name from supplier"
)
def load_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources are loaded, then one of them is refreshed in full."""
    root = shared_dir(spark, "sources")
    nations = table(spark, sf, "nation").select(F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("state"), c("n_name").alias("name"))
    suppliers = table(spark, sf, "supplier").select(
        F.concat(F.lit("C"), c("s_suppkey").cast("string")).alias("Candidate ID"), c("s_name").alias("name")
    )
    readers = {"census": lambda: {"states": nations}, "fec": lambda: {"candidates": suppliers}}
    sinks.load_sources(readers, root)
    sinks.load_sources(readers, root, source="fec", full_refresh=True)
    candidates, states = (landing.raw_table(spark, root, n) for n in ("candidates", "states"))
    return states.select(F.lit("states").alias("table"), c("state").alias("key"), "name").unionByName(
        candidates.select(F.lit("candidates").alias("table"), c("candidate_id").alias("key"), "name")
    )


@_registered(
    "select 'R' || l_suppkey as recipid, cast(l_orderkey as varchar) || '/' || l_linenumber as refno, cast(l_quantity as varchar) as amnt from lineitem"
)
def period_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """Contributions have no key: a period that was loaded with half its rows is loaded again, twice."""
    root = shared_dir(spark, "periods")
    lines = table(spark, sf, "lineitem").select(
        F.concat(F.lit("R"), c("l_suppkey").cast("string")).alias("recipid"),
        F.concat(c("l_orderkey").cast("string"), F.lit("/"), c("l_linenumber").cast("string")).alias("refno"),
        c("l_quantity").cast("string").alias("amnt"), (c("l_orderkey") % 2).alias("half"), (c("l_orderkey") % 3).alias("third"),
    )
    name = "nyc_cfb_contributions"
    first = lambda period: {name: lines.where((c("half") == period) & (c("third") == 0)).drop("half", "third")}
    whole = lambda period: {name: lines.where(c("half") == period).drop("half", "third")}
    sinks.backfill(first, [0, 1], root)
    for _ in range(2):
        sinks.backfill(whole, [0, 1], root)
    return landing.raw_table(spark, root, name).select("recipid", "refno", "amnt")


@_registered(
    "select o_orderkey, case when o_orderkey % 3 = 0 then 'old' else 'new' end as note from orders"
)
def insert_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Rows are added under keys the table lacks, by two loads that overlap; earlier ones stay."""
    path = shared_dir(spark, "inserted")
    orders = table(spark, sf, "orders").select("o_orderkey")
    none = F.lit(None).cast("timestamp").alias("generated_at")
    orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("old").alias("note"), none).write.parquet(path)
    new = orders.select("o_orderkey", F.lit("new").alias("note"))
    for part in (new.where("o_orderkey % 2 = 0"), new.unionByName(new)):
        ledger.insert_absent(part, path, "o_orderkey")
    return ledger.read(spark, path, new.schema)
