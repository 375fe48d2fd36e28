"""Each operator on its own, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostra.functions import keys, labels, names, numbers
from rostra.operators import aggregates, dedup, joins, matching, nested, paging, unions
from rostra.plans import quality
from rostra.session import shared_dir
from rostra import sinks

from .derived import surname
from .tables import duck_sql, plain, spark_sql, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def registered(oracle: str | None):
    """Register a query under its function name, with its check SQL."""
    def add(query: Query) -> Query:
        name = query.__name__
        QUERIES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir))
        if oracle:
            ORACLE[name] = oracle
        return query

    return add


c = F.col

# -------------------------------------------------- projections, casts, filters


@registered(
    "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k, cast(ts as date) as day, "
    "case when try_cast(json_extract_string(props, '$.k') as bigint) is null then 'senate' else 'house' end as chamber, "
    "null::varchar as external_id from events where event_id is not null"
)
def stage_project_cast(spark, sf):
    k = numbers.try_to_number(F.get_json_object("props", "$.k"))
    return table(spark, sf, "events").where("event_id is not null").select(
        "event_id",
        k.alias("k"),
        c("ts").cast("date").alias("day"),
        labels.chamber_of(k).alias("chamber"),
        F.lit(None).cast("string").alias("external_id"),
    )


@registered(
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, floor(l_quantity * 0.05 + 0.5) as amount from lineitem "
    "where floor(l_quantity * 0.05 + 0.5) > 0"
)
def filter_positive_money(spark, sf):
    amount = numbers.money(c("l_quantity") * 0.05)
    return table(spark, sf, "lineitem").where(amount > 0).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", amount.alias("amount")
    )


@registered(
    "select event_id, user_id, "
    "case when props is null then null else json_extract_string(props, '$.k') end as district, "
    "case event_type when 'click' then 'senate' when 'view' then 'house' end as chamber from events"
)
def json_path(spark, sf):
    role = F.from_json("props", "struct<k:string>")
    return table(spark, sf, "events").select(
        "event_id", "user_id",
        role["k"].alias("district"),
        labels.decode(
            c("event_type"), {"click": "senate", "view": "house"}, F.lit(None).cast("string")
        ).alias("chamber"),
    )


@registered(
    "select o_orderkey, case o_orderstatus when 'F' then 'Final' when 'O' then 'Open' else o_orderstatus end as status_full, "
    "case o_orderpriority when '1-URGENT' then 'Urgent' when '5-LOW' then 'Low' else o_orderpriority end as priority_full from orders"
)
def decode_labels(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        labels.decode(c("o_orderstatus"), {"F": "Final", "O": "Open"}).alias("status_full"),
        labels.decode(c("o_orderpriority"), {"1-URGENT": "Urgent", "5-LOW": "Low"}).alias("priority_full"),
    )


@registered(
    "select c_custkey, case when c_acctbal / 100 >= 60 then 'High' when c_acctbal / 100 >= 30 then 'Medium' else 'Low' end "
    "as risk_level from customer"
)
def tier_case(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", labels.tier(c("c_acctbal") / 100).alias("risk_level")
    )


_PRINTED = (
    "case event_type when 'click' then 'Yea' when 'view' then 'NAY' when 'purchase' then 'Not Voting' "
    "when 'signup' then 'Present' else 'Guilty' end"
)


@registered(
    f"select event_id, case lower({_PRINTED}) when 'yea' then 'yes' when 'aye' then 'yes' when 'nay' then 'no' "
    f"when 'no' then 'no' when 'not voting' then 'abstain' when 'present' then 'present' else lower({_PRINTED}) end "
    "as vote_option from events"
)
def option_normalise(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", labels.vote_option(F.expr(_PRINTED)).alias("vote_option")
    )


_FULL = "upper(split_part(p_name, ' ', 2)) || '-x' || case when p_partkey % 5 = 0 then ' ' else ', ' end || upper(split_part(p_name, ' ', 1)) || ' o''n'"


@registered(
    f"select p_partkey, array_to_string(list_transform(regexp_extract_all(lower(trim(substr({_FULL}, strpos({_FULL}, ',') + 1)) "
    f"|| ' ' || trim(split_part({_FULL}, ',', 1))), '([a-z0-9'']+|[^a-z0-9'']+)'), lambda w: upper(w[1]) || w[2:]), '') as display_name "
    "from part"
)
def name_flip(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", names.flip_name(F.expr(_FULL.replace("''", "\\'"))).alias("display_name")
    )


@registered(
    "select c_custkey, case when c_custkey % 3 = 0 then 'Senator' else 'Representative' end || ' ' || c_name || ' (' || "
    "substr(nullif(c_mktsegment, 'BUILDING'), 1, 1) || '-' || n_name || case when c_custkey % 3 <> 0 then '-' || c_nationkey else '' end "
    "|| ')' as display_name from customer left join nation on n_nationkey = c_nationkey"
)
def display_name(spark, sf):
    chamber = F.when(c("c_custkey") % 3 == 0, "senate").otherwise("house")
    named = joins.attach(
        table(spark, sf, "customer"), table(spark, sf, "nation"),
        {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"},
    )
    return named.select(
        "c_custkey",
        names.display_name(
            labels.title_of(chamber), c("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING")),
            c("n_name"), chamber, c("c_nationkey"),
        ).alias("display_name"),
    )


# -------------------------------------------------- keys


@registered("select c_custkey, md5('bioguide:' || c_name) as person_key from customer")
def key_person(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", keys.person_key("bioguide", c("c_name")).alias("person_key")
    )


@registered(
    "select o_orderkey, md5('fec:' || o_custkey || ':' || year(o_orderdate)) as candidacy_key from orders"
)
def key_candidacy(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        keys.candidacy_key("fec", c("o_custkey"), F.year("o_orderdate")).alias("candidacy_key"),
    )


@registered(
    "select c_custkey, md5(upper(trim(c_name)) || '|' || c_nationkey || '|' || "
    "upper(trim(coalesce(nullif(c_mktsegment, 'BUILDING'), '')))) as donor_key from customer"
)
def key_donor(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        keys.donor_key(
            F.lower("c_name"), c("c_nationkey").cast("string"),
            F.nullif("c_mktsegment", F.lit("BUILDING")),
        ).alias("donor_key"),
    )


@registered(
    "select o_orderkey, md5(coalesce(nullif(o_orderpriority, '5-LOW'), '') || '|' || nullif(o_orderstatus, 'P') || '|' || "
    "year(o_orderdate) || '|' || coalesce(cast(cast(o_orderdate as date) as varchar), '') || '|' || coalesce(null::varchar, '') || '|' || o_custkey || '|' || 1) "
    "as contribution_key from orders"
)
def null_propagating_key(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        keys.contribution_key(
            F.nullif("o_orderpriority", F.lit("5-LOW")), F.nullif("o_orderstatus", F.lit("P")),
            F.year("o_orderdate"), c("o_orderdate").cast("date"), F.lit(None).cast("string"),
            c("o_custkey"), F.lit(1),
        ).alias("contribution_key"),
    )


@registered(
    "select o_orderkey, md5('congress:' || o_custkey || ':' || lower(o_orderstatus) || ':' || o_orderkey) as bill_key, "
    "upper(o_orderstatus) || ' ' || o_orderkey as identifier, lower(o_orderstatus) || o_orderkey as source_bill_id, "
    "md5(coalesce(nullif(o_orderstatus, 'O'), '') || ':' || o_orderpriority || ':' || 'congress') as sponsorship_key, "
    "md5(coalesce(nullif(o_orderstatus, 'O'), o_orderpriority) || ':' || 'house:' || year(o_orderdate) || ':' || o_orderkey || ':' || 'h') as vote_key, "
    "'senate:' || o_custkey || ':1:' || o_orderkey as senate_event, 'cd-' || o_custkey || '-' || o_orderkey as district_key "
    "from orders"
)
def composite_keys(spark, sf):
    status, number = c("o_orderstatus"), c("o_orderkey").cast("string")
    not_open = F.nullif("o_orderstatus", F.lit("O"))
    house = keys.house_vote_event(F.year("o_orderdate"), number)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        keys.federal_bill_key(c("o_custkey"), status, number).alias("bill_key"),
        keys.bill_identifier(status, number).alias("identifier"),
        keys.bill_source_id(status, number).alias("source_bill_id"),
        keys.sponsorship_key(not_open, c("o_orderpriority"), F.lit("congress")).alias("sponsorship_key"),
        keys.vote_key(not_open, c("o_orderpriority"), house, F.lit("h")).alias("vote_key"),
        keys.senate_vote_event(c("o_custkey"), F.lit(1), number).alias("senate_event"),
        keys.district_key(c("o_custkey").cast("string"), number).alias("district_key"),
    )


# -------------------------------------------------- one row per key, numbering


@registered(
    "select event_id, user_id, ts, event_type from events "
    "qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"
)
def latest_wins_one_key(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return dedup.latest_wins(rows, ["user_id"], "ts", [F.desc("event_id")])


@registered(
    "select event_id, user_id, event_type, value from events "
    "qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1"
)
def latest_wins_composite(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return dedup.latest_wins(rows, ["user_id", "event_type"], "ts", [F.desc("event_id")]).drop("ts")


@registered("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def reload_idempotent(spark, sf):
    """Load the orders twice, as a repeated backfill would, and read the newest copies."""
    root = shared_dir(spark, "reload")
    sinks.backfill(lambda period: {"orders": table(spark, sf, "orders")}, [1, 2], root)
    loaded = spark.read.parquet(f"{root}/orders")
    lowered = loaded.toDF(*[n.lower() for n in loaded.columns])
    return dedup.latest_wins(lowered, ["o_orderkey"]).drop("load_at")


@registered(
    "select l_returnflag, l_linestatus, l_quantity, l_discount, l_shipdate, row_number() over "
    "(partition by l_returnflag, l_linestatus, l_quantity, l_discount order by l_shipdate) as dedup_seq from lineitem"
)
def dedup_sequence(spark, sf):
    natural = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    rows = table(spark, sf, "lineitem").select(*natural, "l_shipdate")
    return dedup.dedup_sequence(rows, natural, "l_shipdate")


@registered(
    "select l_orderkey, l_linenumber, k, row_number() over (partition by k order by loaded) as dedup_seq from ("
    "select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then 'hot' else 'k' || l_suppkey end as k, "
    "l_orderkey * 10 + l_linenumber as loaded from lineitem)"
)
def dedup_sequence_hot(spark, sf):
    """A third of all rows have one key, each with a load time of its own; that key is cut."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(c("l_orderkey") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), c("l_suppkey").cast("string"))).alias("k"),
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("loaded"),
    )
    return dedup.dedup_sequence(rows, ["k"], "loaded", hot_rows=1000).drop("loaded")


@registered(
    "select o_custkey, o_orderkey, o_orderpriority from orders qualify row_number() over (partition by o_custkey "
    "order by case when o_orderpriority = '1-URGENT' then 0 else 1 end, year(o_orderdate) desc, length(o_orderpriority) desc, o_orderkey) = 1"
)
def priority_canonical(spark, sf):
    order = [
        F.when(c("o_orderpriority") == "1-URGENT", 0).otherwise(1).asc(),
        F.year("o_orderdate").desc(),
        F.length("o_orderpriority").desc(),
        F.asc("o_orderkey"),
    ]
    return dedup.first_by(table(spark, sf, "orders"), ["o_custkey"], order).select(
        "o_custkey", "o_orderkey", "o_orderpriority"
    )


@registered(
    "with d as (select distinct o_custkey as filer_id, l_suppkey as person_id from orders join lineitem on l_orderkey = o_orderkey), "
    "a as (select * from d qualify row_number() over (partition by person_id order by filer_id) = 1) "
    "select * from a qualify row_number() over (partition by filer_id order by person_id) = 1"
)
def two_sided_link(spark, sf):
    links = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "lineitem"), c("o_orderkey") == c("l_orderkey"))
        .select(c("o_custkey").alias("filer_id"), c("l_suppkey").alias("person_id"))
        .distinct()
    )
    return dedup.one_to_one(links, "person_id", "filer_id")


# -------------------------------------------------- fuzzy matching

# Customers and suppliers in blocks that keep their size as the tables grow.
_LEFT_NAMES = (
    f"select c_custkey, cast(floor(c_custkey / 150) as bigint) as block, {surname('c_name', 'cast(3 + c_custkey % 4 as int)')} as l_name "
    "from {customer}"
)
_RIGHT_NAMES = (
    "select s_suppkey, cast(floor(s_suppkey / 10) as bigint) as block, "
    + surname("'Customer#' || lpad(cast(s_suppkey * 15 as string), 9, '0')", "cast(3 + s_suppkey % 5 as int)")
    + " as r_name from {supplier}"
)
_SIDES = f"l as ({duck_sql(_LEFT_NAMES)}), r as ({duck_sql(_RIGHT_NAMES)})"
_SCORE = "cast(floor(round(100 * jaro_winkler_similarity(l_name, r_name), 6)) as int)"


def _sides(spark, sf):
    return spark_sql(spark, sf, _LEFT_NAMES), spark_sql(spark, sf, _RIGHT_NAMES)


@registered(
    "with n as (select distinct p_brand || '/' || p_size as block, p_name as l_name from part), "
    "p as (select a.block, a.l_name, b.l_name as r_name from n a join n b on a.block = b.block and a.l_name < b.l_name) "
    f"select block, l_name, r_name, round(jaro_winkler_similarity(l_name, r_name), 6) as similarity, {_SCORE} as score "
    f"from p where {_SCORE} >= 85"
)
def fuzzy_block_pairs(spark, sf):
    """Distinct part names alike within one brand and size."""
    parts = table(spark, sf, "part").select(
        F.concat("p_brand", F.lit("/"), c("p_size").cast("string")).alias("seat"), "p_name"
    )
    pairs = matching.name_pairs(parts, parts, "seat", "p_name", "p_name")
    return pairs.where("l_name < r_name").withColumn("similarity", F.round("similarity", 6))


@registered(
    f"with {_SIDES} select c_custkey, l.block, l_name, s_suppkey, r_name from l left join r on l.block = r.block and {_SCORE} >= 85"
)
def fuzzy_left_join(spark, sf):
    left, right = _sides(spark, sf)
    return matching.fuzzy_left_join(left, right, "block", "l_name", "r_name")


@registered(
    f"with {_SIDES}, p as (select c_custkey, s_suppkey, {_SCORE} as score from l join r on l.block = r.block where {_SCORE} >= 85), "
    "a as (select * from p qualify row_number() over (partition by c_custkey order by score desc, s_suppkey) = 1) "
    "select * from a qualify row_number() over (partition by s_suppkey order by score desc, c_custkey) = 1"
)
def one_to_one_match(spark, sf):
    left, right = _sides(spark, sf)
    return matching.best_matches(left, right, "block", "c_custkey", "l_name", "s_suppkey", "r_name")


# -------------------------------------------------- joins


@registered(
    "select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey "
    "and o_orderpriority = '1-URGENT' and year(o_orderdate) = 1998)"
)
def unmatched_anti(spark, sf):
    urgent = table(spark, sf, "orders").where(
        (c("o_orderpriority") == "1-URGENT")
        & (c("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        & (c("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.without(customers, urgent, {"c_custkey": "o_custkey"})


@registered(
    "select o_orderkey, l_linenumber, l_partkey, l_extendedprice, o_custkey from orders join lineitem on l_orderkey = o_orderkey"
)
def inner_fanout(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey")


@registered(
    "select c_custkey, c_nationkey, n_name, n_regionkey from customer left join (select * from nation where n_regionkey <> 2) "
    "on n_nationkey = c_nationkey"
)
def left_lookup(spark, sf):
    nations = table(spark, sf, "nation").where("n_regionkey <> 2")
    return joins.lookup(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nations,
        {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "n_regionkey": "n_regionkey"},
    )


@registered(
    "select c_custkey, c_nationkey as nationkey, count_suppliers from customer left join "
    "(select s_nationkey, count(*) as count_suppliers from supplier group by 1) on s_nationkey = c_nationkey"
)
def using_join(spark, sf):
    suppliers = table(spark, sf, "supplier").groupBy(c("s_nationkey").alias("nationkey")).agg(
        F.count("*").alias("count_suppliers")
    )
    customers = table(spark, sf, "customer").select("c_custkey", c("c_nationkey").alias("nationkey"))
    return customers.join(suppliers, "nationkey", "left")


@registered(
    "select o_orderkey, o_custkey, c_name, c_mktsegment from orders left join customer "
    "on cast(split_part(c_name, '#', 2) as bigint) = o_custkey and c_mktsegment = 'BUILDING'"
)
def right_filtered_left_join(spark, sf):
    customers = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.split_part("c_name", F.lit("#"), F.lit(2)).cast("bigint").alias("number"),
        "c_name", "c_mktsegment",
    )
    return joins.attach(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"), customers,
        {"o_custkey": "number"}, {"c_name": "c_name", "c_mktsegment": "c_mktsegment"},
    )


_KEYWORDS = [("RING", "Jewels"), ("widget", "Tools"), ("et", "Small"), ("Old", "Antiques"), ("b_lt", "Fasteners")]
_KEYWORD_SQL = "(values " + ", ".join(f"('{k}', '{v}')" for k, v in _KEYWORDS) + ") as k(keyword, category)"


@registered(
    f"select p_partkey, p_name, min(category) as category from part left join {_KEYWORD_SQL} "
    "on lower(p_name) like '%' || lower(keyword) || '%' group by p_partkey, p_name"
)
def keyword_theta_min(spark, sf):
    keywords = spark.createDataFrame(_KEYWORDS, "keyword string, category string")
    matched = joins.keyword_pairs(
        table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", keywords, "keyword"
    )
    return matched.groupBy("p_partkey", "p_name").agg(F.min("category").alias("category"))


@registered(
    "select p_partkey, min(word) as word, count(*) as n_words from part left join "
    "(select distinct unnest(string_split(p_name, ' ')) as word from part) on contains(lower(p_name), lower(word)) group by p_partkey"
)
def keyword_long_list(spark, sf):
    """Every word of every part name is a keyword; the list goes through the equi-join."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    words = parts.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    matched = joins.keyword_pairs(parts, "p_name", words, "word", small_rows=0)
    return matched.groupBy("p_partkey").agg(F.min("word").alias("word"), F.count("*").alias("n_words"))


@registered(
    "select doc_id, lang, case when l.doc_id is not null then 'ready' else 'none' end as summary_status, quality "
    "from documents d left join labels l using (doc_id)"
)
def left_status_flag(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.with_flag(
        docs, table(spark, sf, "labels"), "doc_id", ["quality"], "summary_status"
    )


@registered("select distinct d.doc_id, d.source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def insert_absent(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return sinks.new_rows(docs.unionByName(docs), table(spark, sf, "labels"), "doc_id")


# -------------------------------------------------- aggregates


@registered(
    "select o_custkey, coalesce(string_agg(distinct nullif(o_orderstatus, 'P'), ' · ' order by nullif(o_orderstatus, 'P')), '') as statuses, "
    "coalesce(string_agg(distinct o_orderpriority, ' · ' order by o_orderpriority), '') as priorities from orders group by o_custkey"
)
def listagg_distinct_ordered(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return aggregates.joined_distinct(
        orders, ["o_custkey"], {"statuses": "o_orderstatus", "priorities": "o_orderpriority"}
    )


@registered("select s_nationkey, max(s_name) as canonical_name from supplier group by s_nationkey")
def max_name_per_group(spark, sf):
    return table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.max("s_name").alias("canonical_name"))


@registered(
    "select n_name, total, buildings, case when total = 0 then 0.0 else ((2000 * buildings + total) // (2 * total)) / 1000.0 end as pct, "
    "case when rich = 0 then 0.0 else ((2000 * buildings + rich) // (2 * rich)) / 1000.0 end as per_rich "
    "from (select n_name, count(*) as total, count_if(c_mktsegment = 'BUILDING') as buildings, count_if(c_acctbal > 9900) as rich "
    "from customer join nation on n_nationkey = c_nationkey group by n_name)"
)
def geo_rates(spark, sf):
    counts = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("total"),
        F.count_if(c("c_mktsegment") == "BUILDING").alias("buildings"),
        F.count_if(c("c_acctbal") > 9900).alias("rich"),
    )
    named = counts.join(table(spark, sf, "nation"), c("n_nationkey") == c("c_nationkey"))
    return named.select(
        "n_name", "total", "buildings",
        numbers.share(c("buildings"), c("total")).alias("pct"),
        numbers.share(c("buildings"), c("rich")).alias("per_rich"),
    )


# -------------------------------------------------- nested data and unions


@registered(
    "select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no "
    "from documents"
)
def flatten_single(spark, sf):
    lines = F.transform(
        F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("line_no"), line.alias("line"))
    )
    return nested.flatten(table(spark, sf, "documents"), lines, "s", ["doc_id"]).select(
        "doc_id", "s.line", "s.line_no"
    )


@registered(
    "select conv_id, turn, line_no, unnest(string_split(line, ' ')) as word from (select conv_id, turn, "
    "unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from conversations)"
)
def flatten_double(spark, sf):
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.struct(i.alias("line_no"), F.split(line, " ", -1).alias("words")),
    )
    flat = nested.flatten_twice(
        table(spark, sf, "conversations"), lines, "e", "words", "word", ["conv_id", "turn"]
    )
    return flat.select("conv_id", "turn", "e.line_no", "word")


@registered(
    "select 'c' || c_custkey as party_id, c_name as name, 'customer' as kind, c_nationkey as nation, c_mktsegment as segment, "
    "null::double as balance from customer union all select 's' || s_suppkey, s_name, 'supplier', s_nationkey, null, s_acctbal from supplier"
)
def union_conformed(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.concat(F.lit("c"), c("c_custkey").cast("string")).alias("party_id"),
        c("c_name").alias("name"), F.lit("customer").alias("kind"),
        c("c_nationkey").alias("nation"), c("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), c("s_suppkey").cast("string")).alias("party_id"),
        c("s_name").alias("name"), F.lit("supplier").alias("kind"),
        c("s_nationkey").alias("nation"), c("s_acctbal").alias("balance"),
    )
    return unions.conform(
        "party_id string, name string, kind string, nation int, segment string, balance double",
        customers, suppliers,
    )


@registered(
    "with s as (select l_orderkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as q, "
    "cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as p, cast(sum(cast(l_tax as decimal(18,2))) as double) as t "
    "from lineitem group by l_orderkey) select l_orderkey, 'quantity' as source, q as amount from s where q <> 0 "
    "union all select l_orderkey, 'price', p from s where p <> 0 union all select l_orderkey, 'tax', t from s where t <> 0"
)
def unpivot_breakdown(spark, sf):
    cents = "decimal(18,2)"
    sums = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(c("l_quantity").cast(cents)).alias("q"),
        F.sum(c("l_extendedprice").cast(cents)).alias("p"),
        F.sum(c("l_tax").cast(cents)).alias("t"),
    )
    return nested.breakdown(sums, ["l_orderkey"], {"q": "quantity", "p": "price", "t": "tax"})


# -------------------------------------------------- pages and histories


@registered(
    "select c_custkey, c_name, c_mktsegment, count(*) over () as total_count from customer "
    "where c_name ilike '%0_1%' and c_mktsegment = 'BUILDING' order by c_name, c_custkey limit 20 offset 3"
)
def paged_search_total(spark, sf):
    found = paging.contains_if_given(table(spark, sf, "customer"), "c_name", "0_1")
    found = paging.equals_if_given(found, "c_mktsegment", "BUILDING")
    found = paging.equals_if_given(found, "c_nationkey", None)
    return paging.page(
        found.select("c_custkey", "c_name", "c_mktsegment"),
        [F.asc_nulls_last("c_name"), F.asc("c_custkey")], 20, 3, "total_count",
    )


@registered(
    "select o_orderkey, nullif(o_totalprice, 0) as price, nullif(o_orderpriority, '1-URGENT') as priority from orders "
    "order by nullif(o_orderpriority, '1-URGENT') desc nulls last, o_totalprice desc nulls last, o_orderkey limit 50"
)
def topn_nulls_last(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_totalprice", F.lit(0)).alias("price"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"),
    )
    order = [F.desc_nulls_last("priority"), F.desc_nulls_last("price"), F.asc("o_orderkey")]
    return paging.top(rows, order, 50)


_PER_YEAR = (
    "select o_custkey, year(o_orderdate) as cycle, count(*) as orders, "
    "cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total from {orders} group by 1, 2"
)


@registered(
    f"with y as ({duck_sql(_PER_YEAR)}) select *, cycle = max(cycle) over (partition by o_custkey) as is_latest from y"
)
def latest_and_history(spark, sf):
    per_year = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("cycle")).agg(
        F.count("*").alias("orders"),
        F.sum(c("o_totalprice").cast("decimal(18,2)")).alias("total"),
    )
    newest = per_year.groupBy("o_custkey").agg(F.max("cycle").alias("newest"))
    return per_year.join(newest, "o_custkey").select(
        "o_custkey", "cycle", "orders", "total", (c("cycle") == c("newest")).alias("is_latest")
    )


@registered(
    "select o_custkey, o_orderkey, cycle from (select *, max(cast(cycle = wanted as int)) over (partition by o_custkey) as has, "
    "row_number() over (partition by o_custkey order by cycle desc, o_orderkey) as rn from (select o_custkey, o_orderkey, "
    "year(o_orderdate) as cycle, 1995 + o_custkey % 7 as wanted from orders join customer on c_custkey = o_custkey)) "
    "where case when has = 1 then cycle = wanted else rn <= 10 end"
)
def current_else_first(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("cycle"))
    parents = table(spark, sf, "customer").select(
        c("c_custkey").alias("o_custkey"), (c("c_custkey") % 7 + 1995).alias("wanted")
    )
    return paging.current_else_first(
        rows, parents, "o_custkey", "cycle", "wanted", [F.desc("cycle"), F.asc("o_orderkey")]
    )


# -------------------------------------------------- data quality

_CHECKS = [
    quality.unique("orders", "o_orderkey"),
    quality.unique("orders", "o_custkey", where="o_orderpriority = '1-URGENT'", severity="warn"),
    *quality.not_null("orders", "o_orderkey", "o_orderstatus"),
    quality.accepted("orders", "o_orderstatus", ["F", "O"], severity="warn"),
    quality.relates("orders", "o_custkey", "customer", severity="warn"),
]


@registered(
    "with r as (select 'unique' as \"check\", 'o_orderkey' as \"column\", 'error' as severity, count(*) as failures from "
    "(select 1 from orders where o_orderkey is not null group by o_orderkey having count(*) > 1) union all "
    "select 'unique', 'o_custkey', 'warn', count(*) from (select 1 from orders where o_orderpriority = '1-URGENT' "
    "group by o_custkey having count(*) > 1) union all "
    "select 'not_null', 'o_orderkey', 'error', count_if(o_orderkey is null) from orders union all "
    "select 'not_null', 'o_orderstatus', 'error', count_if(o_orderstatus is null) from orders union all "
    "select 'accepted_values', 'o_orderstatus', 'warn', count_if(o_orderstatus not in ('F', 'O')) from orders union all "
    "select 'relationships', 'o_custkey', 'warn', count(*) from orders where o_custkey not in "
    "(select c_custkey from customer where c_mktsegment <> 'BUILDING')) "
    "select \"check\", 'orders' as relation, \"column\", severity, cast(failures as bigint) as failures, failures = 0 as passed from r"
)
def dq_report(spark, sf):
    relations = {
        "orders": table(spark, sf, "orders"),
        "customer": table(spark, sf, "customer")
        .where("c_mktsegment <> 'BUILDING'")
        .select(c("c_custkey").alias("o_custkey")),
    }
    return quality.report(relations, _CHECKS)
