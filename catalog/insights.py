"""Donor edges, shared donors, finance per candidacy, similar rows, committee directory."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostra.operators import name_index
from rostra.operators.similar_rows import most_similar
from rostra.plans import donors, reads, serving
from rostra.schemas import BILL_SUMMARIES
from rostra.session import shared_dir, staged
from rostra.sinks import merged

from .models import ORACLE as MODEL_ORACLE, check, model, relations
from .tables import plain, table

Query = Callable[[SparkSession, str], DataFrame]

# Loads a table is dealt into, and the order in which they arrive; some arrive twice.
LOADS, ARRIVALS = 4, (2, 0, 3, 0, 1, 2)
SMALL = 6  # amounts are small in these data


def _in_loads(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Contributions as they arrive: named loads, out of order and with repeats."""
    gifts = relations(spark, sf_dir, "stg_nyc_cfb__contributions")["stg_nyc_cfb__contributions"]
    dealt = gifts.select(*donors.ATTRIBUTED, F.pmod(F.xxhash64("load_at"), F.lit(LOADS)).alias("load"))
    every = staged(dealt, "gifts", by=["load"])
    return [(f"load-{n}", every.where(F.col("load") == n).drop("load")) for n in ARRIVALS]


def _stored_edges(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "donor-edges")
    for name, rows in _in_loads(spark, sf_dir):
        donors.merge_edges(path, rows, buckets=16, batch=name)
    return path


def edges_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(merged.read_merged(spark, _stored_edges(spark, sf_dir)).drop(merged.BUCKET))


def shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = merged.read_merged(spark, _stored_edges(spark, sf_dir))
    candidacy = hashlib.md5(b"nyc_cfb:R1:2017").hexdigest()
    return plain(donors.shared_donors(edges, candidacy))


def finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("fct_candidate_finance", "stg_nyc_cfb__contributions", "stg_ny_boe__activity", "fct_donor_candidate_edges")
    r = relations(spark, sf_dir, *names)
    return plain(donors.fct_candidacy_finance(*[r[n] for n in names], small=SMALL))


def finance_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, sums = shared_dir(spark, "donor-edges"), shared_dir(spark, "candidacy-sums")
    for name, rows in _in_loads(spark, sf_dir):
        donors.merge_edges(edges, rows, buckets=16, batch=name)
        donors.merge_finance(sums, rows, buckets=4, batch=name, small=SMALL)
    return plain(donors.stored_finance(spark, sums, edges))


def similar_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by how often they did what on which day."""
    events = table(spark, sf_dir, "events").withColumn("slot", F.concat_ws("/", "event_type", F.col("ts").cast("date")))
    return most_similar(events, "user_id", "slot", F.lit(1), part="event_type")


def _published(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named marts in their layouts for reads by key."""
    root = shared_dir(spark, "serving")
    return serving.publish(spark, relations(spark, sf_dir, *names), root, f"rostra_{uuid.uuid4().hex}", buckets=8)


def voting_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of one member from bucketed bills, sponsorships and votes."""
    r = _published(spark, sf_dir, "dim_members", "dim_bills", "fct_bill_sponsorships", "fct_votes")
    key, none = hashlib.md5(b"bioguide:B7").hexdigest(), spark.createDataFrame([], BILL_SUMMARIES)
    found = reads.member_record(
        r["dim_members"], r["dim_bills"], r["fct_bill_sponsorships"], r["fct_votes"], none, key
    )
    return found["votes"].select("bill_key", "vote_event_id", "vote_date", "vote_option", "identifier")


def finance_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finance of one member from a mart in ranges of members."""
    r = _published(spark, sf_dir, "dim_members", "fct_member_finance")
    found = reads.member_finance(r["dim_members"], r["fct_member_finance"], hashlib.md5(b"bioguide:B7").hexdigest())
    return plain(found.select("cycle", "total_receipts", "total_disbursements", "cash_on_hand", "pac_pct_of_total"))


def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members by a part of their name with wildcards in it, through the index."""
    members = _published(spark, sf_dir, "dim_members")["dim_members"]
    index = shared_dir(spark, "name-index")
    name_index.build_index(members, "member_key", "name", index)
    return reads.search_members(members, q="A%, auto_o", chamber="house", limit=100, name_index_path=index)


QUERIES: dict[str, Query] = {
    "committee_directory": model("int_congress__committees"),
    "donor_edges": model("fct_donor_candidate_edges"),
    "donor_edges_by_load": edges_by_load,
    "shared_donors": shared,
    "finance_rollup": finance,
    "finance_rollup_by_load": finance_by_load,
    "similar_legislators": model("mart_similar_legislators"),
    "similar_users": similar_users,
    "voting_record_bucketed": voting_record,
    "finance_history_clustered": finance_history,
    "search_members_indexed": indexed_search,
}

_EDGE = (
    "select md5(upper(trim(coalesce(name, ''))) || '|' || zip || '|' || upper(trim(empname))) as donor_key, "
    "md5('nyc_cfb:' || recipid || ':' || cycle) as candidacy_key, cast(sum(amount) as double) as total_amount, "
    "count(*) as contribution_count, min(day) as first_date, max(day) as last_date from gift where officecd <> 'IS' group by 1, 2"
)

_CITY = (
    "select md5('nyc_cfb:' || recipid || ':' || cycle) as candidacy_key, 'nyc_cfb' as coverage, cast(sum(amount) as double) as total_raised, "
    "null::double as total_spent, null::double as cash_on_hand, null::double as public_funds_received, "
    "cast(sum(matchable) as double) as matchable_amount_total, count(*) as contribution_count, "
    "count(distinct upper(trim(coalesce(name, ''))) || '|' || zip || '|' || upper(trim(empname))) as unique_donor_count, "
    "((200 * sum(amount) + count(*)) // (2 * count(*))) / 100.0 as avg_contribution, "
    f"100.0 * count(*) filter (amount < {SMALL}) / count(*) as pct_small_dollar from gift where officecd <> 'IS' group by recipid, cycle"
)

_NEAREST = (
    "norms as (select r, sum(v * v) as n2 from entries group by r), "
    "pairs as (select a.r, b.r as o, sum(a.v * b.v) as dot from entries a join entries b on a.c = b.c and a.r <> b.r group by 1, 2 having dot > 0), "
    "scored as (select p.r, o, dot / sqrt(cast(a.n2 as double) * b.n2) as similarity from pairs p join norms a on a.r = p.r join norms b on b.r = o), "
    "best as (select *, row_number() over (partition by r order by similarity desc, o) as rank from scored qualify rank <= 5) "
)

ORACLE: dict[str, str] = {
    "committee_directory": check(
        "select c.chamber, committee_id as committee_code, name as committee_name, null::varchar as url "
        "from raw_committees cross join (values ('house'), ('senate')) c(chamber)"
    ),
    "donor_edges": check(_EDGE),
    "donor_edges_by_load": check(_EDGE),
    "shared_donors": check(
        f"select b.candidacy_key, count(distinct a.donor_key) as shared_donors, sum(b.total_amount) as shared_donor_dollars "
        f"from ({_EDGE}) a join ({_EDGE}) b on a.donor_key = b.donor_key and a.candidacy_key <> b.candidacy_key "
        "where a.candidacy_key = md5('nyc_cfb:R1:2017') group by 1"
    ),
    "finance_rollup": check(
        "select md5('fec:' || candidate_id || ':' || cycle) as candidacy_key, 'fec' as coverage, rec / 100.0 as total_raised, "
        "spent / 100.0 as total_spent, cash / 100.0 as cash_on_hand, null::double as public_funds_received, "
        "null::double as matchable_amount_total, null::bigint as contribution_count, null::bigint as unique_donor_count, "
        f"null::double as avg_contribution, null::double as pct_small_dollar from tot where office in ('H', 'S') union all {_CITY} union all "
        "select md5('ny_boe:' || filer_id || ':' || election_year), 'ny_boe', null, sum(qualified_campaign_expenditures), null, "
        "sum(public_funds_received), null, null, null, null, null from activity group by filer_id, election_year"
    ),
    "finance_rollup_by_load": check(_CITY),
    "similar_legislators": check("").rstrip() + (
        ",\nentries as (select person_key as r, vote_event_id as c, sum(case vote_option when 'yes' then 1 else -1 end) as v from vote "
        f"where person_key is not null and vote_option in ('yes', 'no') group by 1, 2 having v <> 0), {_NEAREST}"
        "select r as person_key, rank, o as similar_person_key, similarity from best"
    ),
    "similar_users": (
        "with entries as (select user_id as r, event_type || '/' || cast(ts as date) as c, count(*) as v from events group by 1, 2), "
        f"{_NEAREST} select r as user_id, rank, o as other, similarity from best"
    ),
    "voting_record_bucketed": MODEL_ORACLE["voting_record"],
    "finance_history_clustered": MODEL_ORACLE["finance_history"],
    "search_members_indexed": check(
        "select member_key, bioguide_id, name, display_name, party, state, chamber, district, title, latest_congress, "
        "count(*) over () as total_count from member where name ilike '%a%, auto_o%' and chamber = 'house' "
        "order by name, member_key limit 100"
    ),
}
