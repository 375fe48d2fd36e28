"""Staging, identity, mart and read models over the derived raw tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rostra import seeds
from rostra.plans import build, quality, reads
from rostra.schemas import BILL_SUMMARIES
from rostra.session import frugal, shared_dir

from .derived import FLAT, SHARE_DIVISORS, raw_tables
from .tables import INDUSTRIES_SQL, STATES_SQL, duck_sql, plain

Query = Callable[[SparkSession, str], DataFrame]


def relations(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    raw = raw_tables(spark, sf_dir, build.raw_needed(set(names)))
    return build.build_models(spark, raw, only=set(names))


def model(name: str) -> Query:
    return lambda spark, sf_dir: plain(relations(spark, sf_dir, name)[name])


def picked(name: str, *columns: str) -> Query:
    return lambda spark, sf_dir: plain(relations(spark, sf_dir, name)[name].select(*columns))


# ---------------------------------------------------------------- check SQL

_ALIKE = "cast(floor(round(100 * jaro_winkler_similarity({a}, {b}), 6)) as int)"
_SHARES = ", ".join(
    f"cast(floor(part_pop / {d}) as bigint) as {name}" for name, d in SHARE_DIVISORS.items()
)


def _share(part: str) -> str:
    """Half-up thousandths in whole numbers."""
    return f"case when total = 0 then 0.0 else ((2000 * {part} + total) // (2 * total)) / 1000.0 end"


def _cents(x: str) -> str:
    return f"cast(round(({x}) * 100) as bigint)"


def _tenths(part: str, whole: str) -> str:
    return f"case when {whole} = 0 and {part} is not null then 0 else ({part} * 2000 + {whole}) // (2 * {whole}) end"


_INITCAP = (
    "array_to_string(list_transform(regexp_extract_all(lower({x}), '([a-z0-9'']+|[^a-z0-9'']+)'), "
    "lambda w: upper(w[1]) || w[2:]), '')"
)

CTES = {
    "states": f"select * from {STATES_SQL}",
    "industries": f"select * from {INDUSTRIES_SQL}",
    "raw_members": duck_sql(FLAT["members"]),
    "raw_candidates": duck_sql(FLAT["candidates"]),
    "raw_totals": duck_sql(FLAT["candidate_totals"]),
    "raw_committees": duck_sql(FLAT["committees"]),
    "raw_seats": duck_sql(FLAT["memberships"]),
    "raw_people": duck_sql(FLAT["people"]),
    "raw_activity": duck_sql(FLAT["ny_boe_activity"]),
    "raw_gifts": duck_sql(FLAT["nyc_cfb_contributions"]),
    "raw_state_bills": duck_sql(FLAT["bills"]),
    "raw_fed_bills": duck_sql(FLAT["congress_bills"]),
    "raw_sponsored": duck_sql(FLAT["member_sponsorships"]),
    "raw_calls": duck_sql(FLAT["roll_calls"]),
    "raw_districts": duck_sql(FLAT["congressional_districts"]),
    "raw_states": duck_sql(FLAT["states"]),
    "mem": """
        select r.*, s.state_abbr as abbr, upper(trim(split_part(r.name, ',', 1))) as surname,
               case when district is null then 'S' else 'H' || district end as seat,
               case when district is null then 'senate' else 'house' end as chamber
        from (select distinct on (bioguide_id) * from raw_members order by bioguide_id, load_at desc) r
        left join states s on s.state_name = r.state""",
    "cand": """
        select *, try_cast(nullif(district, '') as bigint) as seat_no,
               upper(trim(split_part(name, ',', 1))) as surname,
               case office when 'H' then 'H' || try_cast(nullif(district, '') as bigint) when 'S' then 'S' end as seat
        from (select distinct on (candidate_id) * from raw_candidates order by candidate_id, load_at desc)""",
    "tot": f"""
        select candidate_id, cycle, office, {_cents("receipts")} as rec,
               {_cents("disbursements")} as spent, {_cents("cash_on_hand_end_period")} as cash,
               {_cents("individual_itemized_contributions")} as item,
               {_cents("individual_unitemized_contributions")} as small,
               {_cents("other_political_committee_contributions")} as pac, load_at
        from (select distinct on (candidate_id, cycle) * from raw_totals
              order by candidate_id, cycle, load_at desc)""",
    "fed_scores": f"""
        select bioguide_id, candidate_id, {_ALIKE.format(a="mem.surname", b="cand.surname")} as score
        from mem join cand on mem.abbr = cand.state and mem.seat = cand.seat""",
    "fed_first": """
        select *, row_number() over (partition by bioguide_id order by score desc, candidate_id) as mine
        from fed_scores where score >= 85""",
    "fed_match": """
        select bioguide_id, candidate_id, score from (
            select *, row_number() over (partition by candidate_id order by score desc, bioguide_id) as theirs
            from fed_first where mine = 1) where theirs = 1""",
    "activity": """
        select cast(election_year as int) as election_year, filer_id, committee_name, candidate_name,
               office, district,
               round(try_cast(nullif(public_funds_received, '') as decimal(18, 2))) as public_funds_received,
               floor(cast(qualified_campaign_expenditures as double) + 0.5) as qualified_campaign_expenditures,
               load_at
        from raw_activity""",
    "state_match": f"""
        select a.*, p.id as openstates_id, p.name as legislator_name, p.party as legislator_party
        from activity a left join raw_people p
          on p.has_role and p.role_district = a.district
         and (lower(a.office) like '%assembly%' or lower(a.office) like '%senate%')
         and {_ALIKE.format(a="upper(split_part(a.candidate_name, ' ', -1))", b="upper(split_part(p.name, ' ', -1))")} >= 85""",
    "link": """
        select filer_id, openstates_id from (
            select *, row_number() over (partition by filer_id order by openstates_id) as b from (
                select *, row_number() over (partition by openstates_id order by filer_id) as a
                from (select distinct filer_id, openstates_id from state_match where openstates_id is not null))
            where a = 1) where b = 1""",
    "gift": """
        select *, cast(floor(cast(amnt as double) + 0.5) as bigint) as amount,
               cast(floor(cast(matchamnt as double) + 0.5) as bigint) as matchable,
               cast(election as int) as cycle, try_strptime(date, '%m/%d/%Y')::date as day
        from raw_gifts where floor(cast(amnt as double) + 0.5) > 0""",
    "xwalk": """
        select md5('bioguide:' || m.bioguide_id) as person_key, m.name as canonical_name, 'federal' as level,
               m.bioguide_id, f.candidate_id as fec_candidate_id, null::varchar as openstates_id,
               null::varchar as ny_boe_filer_id, null::varchar as nyc_cfb_recipient_id,
               case when f.candidate_id is not null then 'state_district_jarowinkler' end as match_method,
               f.score as match_confidence
        from mem m left join fed_match f on f.bioguide_id = m.bioguide_id
        union all
        select md5('fec:' || candidate_id), name, 'federal', null, candidate_id, null, null, null, null, null
        from cand where candidate_id not in (select candidate_id from fed_match)
        union all
        select md5('openstates:' || p.id), p.name, 'state', null, null, p.id, l.filer_id, null,
               case when l.filer_id is not null then 'district_jarowinkler' end, null
        from raw_people p left join link l on l.openstates_id = p.id
        union all
        select md5('nyboe:' || filer_id), candidate_name, 'state', null, null, null, filer_id, null, null, null
        from (select distinct on (filer_id) * from activity
              where filer_id not in (select filer_id from link)
              order by filer_id, (office = 'Governor') is true desc, election_year desc,
                       length(candidate_name) desc, candidate_name)
        union all
        select md5('nyccfb:' || recipid), max(recipname), 'local', null, null, null, null, recipid, null, null
        from gift where officecd <> 'IS' group by recipid""",
    "member": """
        select x.person_key as member_key, m.bioguide_id, x.fec_candidate_id, m.name, m.party, m.abbr as state,
               m.chamber, m.district, case m.chamber when 'senate' then 'Senator' else 'Representative' end as title,
               m.latest_congress,
               case m.chamber when 'senate' then 'Senator' else 'Representative' end || ' ' || m.name || ' (' ||
                   substr(m.party, 1, 1) || '-' || m.abbr || coalesce('-' || m.district, '') || ')' as display_name,
               cast(m.update_date as date) as updated_at
        from mem m left join xwalk x on x.bioguide_id = m.bioguide_id""",
    "finance": f"""
        select m.member_key, m.bioguide_id, t.candidate_id as fec_candidate_id, t.cycle, rec, spent, cash, item,
               small, pac, {_tenths("pac", "rec")} as pac_t, {_tenths("(item + small)", "rec")} as ind_t
        from tot t join member m on m.fec_candidate_id = t.candidate_id where t.office in ('H', 'S')""",
    "seat": """
        select m.member_key, s.congress, s.chamber, s.committee_code, s.committee_name, s.title as role_title, s.rank,
               (select min(industry_category) from industries i
                where contains(lower(s.committee_name), lower(i.committee_keyword))) as industry_category
        from (select distinct on (bioguide_id, congress, committee_code, rank, title) * from raw_seats
              where subcommittee_code is null
              order by bioguide_id, congress, committee_code, rank, title, load_at desc) s
        join member m on m.bioguide_id = s.bioguide_id""",
    "served": """
        select member_key, coalesce(string_agg(distinct committee_name, ' · ' order by committee_name), '') as committees_served,
               coalesce(string_agg(distinct industry_category, ' · ' order by industry_category), '') as regulated_industries
        from seat group by member_key""",
    "bill": """
        select md5('openstates:' || id) as bill_key, id as source_bill_id, 'openstates' as source_system,
               'state' as level, upper(state) as state, null::int as congress, session, null::varchar as bill_type,
               null::varchar as bill_number, identifier, title, null::varchar as abstract, openstates_url as url,
               null::date as latest_action_date, null::varchar as latest_action_text,
               cast(cast(updated_at as timestamp) as date) as update_date
        from raw_state_bills
        union all
        select md5('congress:' || congress || ':' || type || ':' || number), type || number, 'congress', 'federal',
               null, congress, null, upper(type), number, upper(type) || ' ' || number, title, null, url,
               cast(action_date as date), action_text, cast(update_date as date)
        from raw_fed_bills""",
    "state_sponsor": """
        select 'ocd-' || n as bill_id, 'Sponsor P' || n % 120 as sponsor_name, 'person' as entity_type,
               size > 25 as is_primary, case when size > 25 then 'primary' else 'cosponsor' end as classification,
               'P' || n % 120 as openstates_person_id
        from raw_state_bills where n % 10 <> 0
        union all
        select 'ocd-' || n, 'League', 'organization', false, 'cosponsor', null from raw_state_bills where n % 10 <> 0""",
    "state_vote": """
        select 'ocd-' || n as bill_id, 've' || e.k || '-ocd-' || n as vote_event_id, 'Motion ' || e.k as motion_text,
               'pass' as result, make_date(2024, 6, e.k) as vote_date, 'Voter ' || v.i || ' P' || n % 120 as voter_name,
               case when v.i = 0 then 'P' || n % 120 end as openstates_person_id,
               case when v.i = 0 then 'yes' when e.k = 1 then 'no' else 'excused' end as vote_option
        from raw_state_bills cross join (values (1), (2)) e(k) cross join (values (0), (1)) v(i)
        where n % 10 <> 1""",
    "ballot": """
        select c.*, 'Voter ' || (user_id + v.i) as voter_name, user_id + v.i as voter,
               case v.i when 0 then choice when 1 then 'yes' else 'no' end as vote_option,
               case when passed then 'Passed' else 'Failed' end as result,
               split_part(legis_num, ' ', 1) as kind, split_part(legis_num, ' ', 2) as num
        from raw_calls c cross join (values (0), (1), (2)) v(i) where event_id % 10 <> 0""",
    "vote": """
        select x.person_key, b.bill_key, v.vote_event_id, 'openstates' as source_system, null::varchar as chamber,
               v.vote_date, v.vote_option, v.result as vote_result, v.motion_text, v.voter_name
        from state_vote v left join bill b on b.source_bill_id = v.bill_id and b.source_system = 'openstates'
        left join xwalk x on x.openstates_id = v.openstates_person_id
        union all
        select x.person_key, b.bill_key, 'house:2024:' || event_id, 'congress_house', 'house', cast(ts as date),
               vote_option, result, 'On Passage', voter_name
        from ballot v left join bill b on b.bill_type = kind and b.bill_number = num and b.congress = v.congress
        left join xwalk x on x.bioguide_id = 'B' || v.voter
        union all
        select null, b.bill_key, 'senate:' || v.congress || ':1:' || event_id, 'congress_senate', 'senate',
               cast(ts as date), vote_option, result, 'On Passage', voter_name
        from ballot v left join bill b on b.bill_type = kind and b.bill_number = num and b.congress = v.congress""",
    "sponsorship": """
        select x.person_key, b.bill_key, 'openstates' as source_system, sponsor_name, is_primary, classification,
               null::date as introduced_date
        from state_sponsor s left join bill b on b.source_bill_id = s.bill_id and b.source_system = 'openstates'
        left join xwalk x on x.openstates_id = s.openstates_person_id where entity_type = 'person'
        union all
        select x.person_key, b.bill_key, 'congress', null, null, null, cast(introduced_date as date)
        from (select distinct on (bioguide_id, congress, type, number) * from raw_sponsored
              order by bioguide_id, congress, type, number, load_at desc) s
        left join bill b on b.bill_type = s.type and b.bill_number = s.number and b.congress = s.congress
        left join xwalk x on x.bioguide_id = s.bioguide_id""",
    "conflict": """
        select f.member_key, cycle, pac_t / 10.0 as coi_score,
               case when pac_t >= 600 then 'High' when pac_t >= 300 then 'Medium' else 'Low' end as risk_level,
               rec / 100.0 as total_receipts, pac / 100.0 as pac_contributions,
               item / 100.0 as individual_itemized_contributions,
               small / 100.0 as individual_unitemized_contributions,
               null::double as party_contributions, null::double as candidate_self_funding,
               committees_served, regulated_industries,
               'Received $' || format('{:,}', (pac + 50) // 100) || ' from PACs and political committees (' ||
                   (pac_t // 10) || '.' || (pac_t % 10) || '% of $' || format('{:,}', (rec + 50) // 100) ||
                   ' total raised in ' || cycle || '). ' ||
                   case when committees_served is null then 'No committee assignment data available yet.'
                        else 'Sits on: ' || committees_served || '. These committees oversee: ' ||
                             regulated_industries || '.' end as evidence_description
        from finance f left join served s on s.member_key = f.member_key where rec > 0""",
}


def check(body: str) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in CTES.items()) + "\n" + body


_POP = ["total_population", "median_household_income", *SHARE_DIVISORS]
_MONEY = "rec / 100.0 as {r}, spent / 100.0 as {s}, cash / 100.0 as cash_on_hand"


# ---------------------------------------------------------------- reads over models


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = relations(spark, sf_dir, "dim_members")["dim_members"]
    return reads.search_members(
        members, q="r", chamber="house", party="demo", limit=25, offset=25
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = relations(spark, sf_dir, "dim_members", "fct_committee_memberships")
    return reads.current_committees(
        r["fct_committee_memberships"].select(
            "member_key", "congress", "committee_code", "committee_name", "rank", "role_title"
        ).withColumn("congress", F.col("congress")),
        r["dim_members"],
    ).select("member_key", "congress", "committee_code", "committee_name")


def latest_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    conflicts = relations(spark, sf_dir, "mart_conflict_of_interest")["mart_conflict_of_interest"]
    return plain(
        reads.latest_conflicts(conflicts).select("member_key", "cycle", "coi_score", "risk_level")
    )


def funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    finance = relations(spark, sf_dir, "fct_member_finance")["fct_member_finance"]
    return reads.funding_breakdown(finance)


def _checked(spark: SparkSession, sf_dir: str, watch: quality.Watch | None = None) -> DataFrame:
    """All declared checks. Each relation is made and written once, checked, and deleted when no other needs it."""
    names = {c.relation for c in quality.CHECKS} | {c.parent for c in quality.CHECKS if c.parent}
    progress = quality.Progress(quality.CHECKS, watch)
    with frugal(spark):
        raw = raw_tables(spark, sf_dir, build.raw_needed(names))
        build.build_models(spark, raw, only=names, watch=watch, keep=True, progress=progress)
    return progress.result(spark)


def dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks on all relations."""
    return _checked(spark, sf_dir)


def dq_watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same checks, those of single rows counted while the relations are written."""
    return _checked(spark, sf_dir, quality.Watch(quality.CHECKS))


def bill_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills loaded twice under one stamp with other content: all three models read the same copy."""
    bills = raw_tables(spark, sf_dir, ["bills"])["bills"]
    # Votes and sponsors of the second copy are marked like its title.
    sponsors = F.transform("sponsorships", lambda x: x.withField("name", F.concat(F.lit("2"), x["name"])))
    votes = F.transform("votes", lambda x: x.withField("motion_text", F.concat(F.lit("2"), x["motion_text"])))
    second = bills.withColumns({
        "title": F.concat(F.lit("2"), "title"), "sponsorships": sponsors, "votes": votes,
    })
    raw = {"bills": bills.unionByName(second).withColumn("load_at", F.lit("2024-01-01").cast("timestamp"))}
    r = build.build_models(spark, raw, only={
        "stg_openstates__bills", "stg_openstates__bill_sponsorships", "stg_openstates__bill_votes",
    })

    def marks(name: str, column: str, to: str) -> DataFrame:
        own = F.substring(column, 1, 1) == "2"
        return r[name].groupBy("bill_id").agg(F.collect_set(own).alias(to))

    titles = marks("stg_openstates__bills", "title", "t")
    sponsored = marks("stg_openstates__bill_sponsorships", "sponsor_name", "s")
    voted = marks("stg_openstates__bill_votes", "motion_text", "v")
    joined = titles.join(sponsored, "bill_id", "left").join(voted, "bill_id", "left")
    same = (F.coalesce("s", "t") == F.col("t")) & (F.coalesce("v", "t") == F.col("t"))
    return joined.select("bill_id", same.alias("agree"))


MEMBER = "md5('bioguide:B7')"


def _one_member(spark: SparkSession, sf_dir: str, *names: str) -> tuple[dict[str, DataFrame], str]:
    """Relations for a member page, and the key of a member that every scale has."""
    key = hashlib.md5(b"bioguide:B7").hexdigest()
    return relations(spark, sf_dir, "dim_members", *names), key


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, key = _one_member(spark, sf_dir, "fct_committee_memberships")
    found = reads.member_profile(r["dim_members"], r["fct_committee_memberships"], key)
    person = found["profile"].select("member_key", "bioguide_id", "name", "display_name", "latest_congress")
    return person.join(found["committees"].drop("industry_category"))


def finance_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, key = _one_member(spark, sf_dir, "fct_member_finance")
    found = reads.member_finance(r["dim_members"], r["fct_member_finance"], key)
    return plain(found.select("cycle", "total_receipts", "total_disbursements", "cash_on_hand", "pac_pct_of_total"))


def voting_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, key = _one_member(spark, sf_dir, "dim_bills", "fct_bill_sponsorships", "fct_votes")
    none = spark.createDataFrame([], BILL_SUMMARIES)
    found = reads.member_record(
        r["dim_members"], r["dim_bills"], r["fct_bill_sponsorships"], r["fct_votes"], none, key
    )
    return found["votes"].select("bill_key", "vote_event_id", "vote_date", "vote_option", "identifier")


def bill_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    bills = relations(spark, sf_dir, "dim_bills")["dim_bills"]
    key = hashlib.md5(b"openstates:ocd-7").hexdigest()
    ready = spark.createDataFrame([(key, "short", "shorter", "m", None)], BILL_SUMMARIES)
    found = reads.bill_detail(bills, ready, key)
    return found.select("bill_key", "identifier", "title", "state", "url", "plain_summary", "summary_status")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, key = _one_member(spark, sf_dir, "fct_member_finance")
    found = reads.member_finance(r["dim_members"], r["fct_member_finance"], key)
    return reads.history_series(found, ["total_receipts", "pac_contributions"])


def written_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts as built into a folder, with the column comments that came back with them."""
    raw = raw_tables(spark, sf_dir, build.raw_needed({"dim_districts"}))
    built = build.build_models(spark, raw, out_dir=shared_dir(spark, "marts"), only={"dim_districts"})
    return built["dim_districts"].select("district_key", "geo_level", "total_population")


def column_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written bills next to the comment that their key column came back with."""
    raw = raw_tables(spark, sf_dir, build.raw_needed({"dim_bills"}))
    built = build.build_models(spark, raw, out_dir=shared_dir(spark, "marts"), only={"dim_bills"})["dim_bills"]
    comment = built.schema["bill_key"].metadata.get("comment")
    return built.select("bill_key", "level", F.lit(comment).alias("comment"))


QUERIES: dict[str, Query] = {
    "stg_members": model("stg_congress__members"),
    "stg_candidates": picked(
        "stg_fec__candidates", "candidate_id", "name", "office", "office_full", "state", "district",
        "party", "party_full", "incumbent_challenge", "has_raised_funds",
    ),
    "stg_candidate_totals": picked(
        "stg_fec__candidate_totals", "candidate_id", "cycle", "office", "total_receipts",
        "total_disbursements", "cash_on_hand", "individual_itemized_contributions",
        "individual_unitemized_contributions", "pac_contributions", "party_contributions", "name", "office_full", "state", "district", "party_full", "candidate_self_funding",
    ),
    "stg_committee_memberships": picked(
        "stg_congress__committee_memberships", "bioguide_id", "congress", "chamber",
        "committee_code", "committee_name", "rank", "role_title", "subcommittee_code", "subcommittee_name",
    ),
    "stg_ny_boe_activity": picked(
        "stg_ny_boe__activity", "election_year", "filer_id", "candidate_name", "office", "district",
        "public_funds_received", "qualified_campaign_expenditures", "committee_name",
    ),
    "stg_contributions": picked(
        "stg_nyc_cfb__contributions", "election_cycle", "recipient_id", "recipient_name",
        "office_code", "transaction_ref", "contribution_date", "contributor_name", "zip",
        "employer_name", "amount", "matchable_amount", "payment_method", "cycle_year", "filing_period", "schedule", "contributor_type", "city", "state", "occupation",
    ),
    "stg_congress_bills": picked(
        "stg_congress__bills", "congress", "bill_type", "bill_number", "title", "origin_chamber",
        "api_url", "latest_action_date", "latest_action_text", "update_date",
    ),
    "stg_house_votes": picked(
        "stg_congress__house_votes", "congress", "session", "chamber", "roll_number", "year",
        "legis_num", "vote_question", "vote_result", "vote_date", "bioguide_id", "voter_name",
        "vote_option", "party", "state",
    ),
    "stg_senate_votes": picked(
        "stg_congress__senate_votes", "congress", "session", "vote_number", "vote_date",
        "lis_member_id", "voter_name", "vote_option", "vote_result", "chamber", "legis_num", "vote_question", "party", "state",
    ),
    "stg_state_bill_votes": picked(
        "stg_openstates__bill_votes", "bill_id", "vote_event_id", "motion_text", "result",
        "vote_date", "voter_name", "openstates_person_id", "vote_option",
    ),
    "stg_state_bill_sponsorships": picked(
        "stg_openstates__bill_sponsorships", "bill_id", "sponsor_name", "entity_type",
        "is_primary", "classification", "openstates_person_id",
    ),
    "stg_districts": model("stg_census__congressional_districts"),
    "int_legislators_ny_boe_activity": picked(
        "int_legislators__ny_boe_activity", "election_year", "filer_id", "candidate_name", "office",
        "district", "public_funds_received", "openstates_id", "legislator_name", "legislator_party", "committee_name", "qualified_campaign_expenditures",
    ),
    "int_persons_id_crosswalk": model("int_persons__id_crosswalk"),
    "dim_members": model("dim_members"),
    "dim_legislators": model("dim_legislators"),
    "dim_candidates": model("dim_candidates"),
    "dim_bills": model("dim_bills"),
    "dim_committees": model("dim_committees"),
    "dim_districts": model("dim_districts"),
    "fct_contributions": picked(
        "fct_contributions", "contribution_key", "candidacy_key", "person_key", "donor_key",
        "source_system", "cycle", "contribution_date", "amount", "matchable_amount",
        "contributor_name", "employer_name", "zip", "payment_method", "recipient_id",
        "recipient_name", "contributor_type", "occupation", "city", "state",
    ),
    "fct_candidate_finance": model("fct_candidate_finance"),
    "fct_member_finance": model("fct_member_finance"),
    "fct_committee_memberships": model("fct_committee_memberships"),
    "fct_bill_sponsorships": model("fct_bill_sponsorships"),
    "fct_votes": model("fct_votes"),
    "mart_conflict_of_interest": model("mart_conflict_of_interest"),
    "search_members": search,
    "current_committees": profiles,
    "latest_conflict": latest_conflict,
    "funding_breakdown": funding,
    "dq_models": dq,
    "dq_watched": dq_watched,
    "bill_copies": bill_copies,
    "member_profile": profile,
    "finance_history": finance_history,
    "voting_record": voting_record,
    "bill_detail": bill_page,
    "history_series": series,
    "written_model": written_model,
    "column_comments": column_comments,
    "stg_states": model("stg_census__states"),
    "stg_committees": model("stg_fec__committees"),
    "stg_people": picked("stg_openstates__people", "openstates_id", "name", "party", "state", "created_at"),
    "stg_state_bills": picked("stg_openstates__bills", "bill_id", "identifier", "title", "state", "session"),
    "stg_bill_sponsorships": picked(
        "stg_congress__bill_sponsorships", "bioguide_id", "congress", "bill_type", "bill_number",
        "introduced_date", "policy_area", "latest_action_date", "latest_action_text", "title",
    ),
    "stg_house_committees": model("stg_congress__house_committees"),
    "stg_senate_committees": model("stg_congress__senate_committees"),
}

ORACLE: dict[str, str] = {
    "stg_members": check(
        "select bioguide_id, name as member_name, party, state, district, latest_congress, chamber, "
        "null::varchar as fec_candidate_id, cast(update_date as date) as updated_at from mem"
    ),
    "stg_candidates": check(
        "select candidate_id, name, office, office_full, state, district, party, party_full, "
        "incumbent_challenge, has_raised_funds from cand"
    ),
    "stg_candidate_totals": check(
        f"select candidate_id, cycle, office, {_MONEY.format(r='total_receipts', s='total_disbursements')}, "
        "item / 100.0 as individual_itemized_contributions, small / 100.0 as individual_unitemized_contributions, "
        "pac / 100.0 as pac_contributions, null::double as party_contributions, null::double as candidate_self_funding, "
        "null::varchar as name, null::varchar as office_full, null::varchar as state, null::varchar as district, null::varchar as party_full from tot"
    ),
    "stg_committee_memberships": check(
        "select distinct on (bioguide_id, congress, committee_code, rank, title) bioguide_id, congress, chamber, "
        "committee_code, committee_name, rank, title as role_title, null::varchar as subcommittee_code, "
        "null::varchar as subcommittee_name from raw_seats where subcommittee_code is null "
        "order by bioguide_id, congress, committee_code, rank, title, load_at desc"
    ),
    "stg_ny_boe_activity": check(
        "select election_year, filer_id, candidate_name, office, district, "
        "cast(public_funds_received as double) as public_funds_received, qualified_campaign_expenditures, committee_name from activity"
    ),
    "stg_contributions": check(
        "select cycle as election_cycle, recipid as recipient_id, recipname as recipient_name, officecd as office_code, "
        "refno as transaction_ref, day as contribution_date, name as contributor_name, zip, empname as employer_name, "
        "cast(amount as double) as amount, cast(matchable as double) as matchable_amount, "
        "pay_method as payment_method, 2021 as cycle_year, null::varchar as filing_period, null::varchar as schedule, null::varchar as contributor_type, "
        "null::varchar as city, null::varchar as state, null::varchar as occupation from gift"
    ),
    "stg_congress_bills": check(
        "select congress, type as bill_type, number as bill_number, title, origin_chamber, url as api_url, "
        "cast(action_date as date) as latest_action_date, action_text as latest_action_text, "
        "cast(update_date as date) as update_date from raw_fed_bills"
    ),
    "stg_house_votes": check(
        "select congress, cast(1 + event_id % 2 as int) as session, 'house' as chamber, cast(event_id as int) as roll_number, 2024 as year, legis_num, "
        "'On Passage' as vote_question, result as vote_result, cast(ts as date) as vote_date, "
        "'B' || voter as bioguide_id, voter_name, vote_option, 'I' as party, 'NY' as state from ballot"
    ),
    "stg_senate_votes": check(
        "select congress, 1 as session, cast(event_id as int) as vote_number, date_trunc('minute', ts)::timestamp as vote_date, "
        "'S' || voter as lis_member_id, voter_name, vote_option, result as vote_result, 'senate' as chamber, legis_num, "
        "'On Passage' as vote_question, 'I' as party, 'NY' as state from ballot"
    ),
    "stg_state_bill_votes": check(
        "select bill_id, vote_event_id, motion_text, result, vote_date, voter_name, openstates_person_id, "
        "vote_option from state_vote"
    ),
    "stg_state_bill_sponsorships": check(
        "select bill_id, sponsor_name, entity_type, is_primary, classification, openstates_person_id from state_sponsor"
    ),
    "stg_districts": check(
        "select name as district_name, state as state_fips, number as district_number, total as total_population, "
        f"part_pop as median_household_income, {_SHARES} from raw_districts"
    ),
    "int_legislators_ny_boe_activity": check(
        "select election_year, filer_id, candidate_name, office, district, "
        "cast(public_funds_received as double) as public_funds_received, openstates_id, legislator_name, "
        "legislator_party, committee_name, qualified_campaign_expenditures from state_match"
    ),
    "int_persons_id_crosswalk": check("select * from xwalk"),
    "dim_members": check("select * from member"),
    "dim_legislators": check(
        "select x.person_key, m.bioguide_id as legislator_id, m.name, m.party, 'federal' as level, m.abbr as state, "
        "m.chamber, cast(m.district as bigint) as district, "
        "case m.chamber when 'senate' then 'Senator' else 'Representative' end as title "
        "from mem m left join xwalk x on x.bioguide_id = m.bioguide_id union all "
        "select x.person_key, p.id, p.name, p.party, 'state', upper(p.state), "
        "case when has_role then case role_class when 'upper' then 'senate' when 'lower' then 'house' end end, "
        "case when has_role then try_cast(role_district as bigint) end, case when has_role then role_title end "
        "from raw_people p left join xwalk x on x.openstates_id = p.id"
    ),
    "dim_candidates": check(
        "select md5('fec:' || c.candidate_id || ':' || t.cycle) as candidacy_key, x.person_key, "
        + _INITCAP.format(
            x="trim(substr(c.name, strpos(c.name, ',') + 1)) || ' ' || trim(split_part(c.name, ',', 1))"
        )
        + " as display_name, c.party_full as party, 'federal' as level, c.office_full as office, c.state, "
        "c.seat_no as district, t.cycle, c.incumbent_challenge, c.incumbent_challenge = 'I' as is_incumbent, "
        "'fec' as source_system, c.candidate_id as source_id from cand c join tot t on t.candidate_id = c.candidate_id "
        "left join xwalk x on x.fec_candidate_id = c.candidate_id where c.office in ('H', 'S')"
    ),
    "dim_bills": check("select * from bill"),
    "dim_committees": check(
        "select committee_id, name, null::varchar as committee_type, null::varchar as committee_type_full, designation, "
        "case designation when 'A' then 'Authorized by candidate' when 'B' then 'Lobbyist/registrant PAC' "
        "when 'D' then 'Leadership PAC' when 'J' then 'Joint fundraising committee' "
        "when 'P' then 'Principal campaign committee' when 'U' then 'Unauthorized' else designation end as designation_full, "
        "state, null::varchar as party, organization_type, "
        "case organization_type when 'C' then 'Corporation' when 'L' then 'Labor organization' "
        "when 'M' then 'Membership organization' when 'T' then 'Trade association' when 'V' then 'Cooperative' "
        "when 'W' then 'Corporation without capital stock' else organization_type end as organization_type_full, "
        "null::varchar as filing_frequency from raw_committees"
    ),
    "dim_districts": check(
        "select *, " + ", ".join(
            f"case when total_population = 0 then 0.0 else "
            f"((2000 * {pop} + total_population) // (2 * total_population)) / 1000.0 end as {name}"
            for name, pop in [
                ("pct_white", "pop_white_alone"), ("pct_black", "pop_black_alone"),
                ("pct_hispanic", "pop_hispanic_latino"), ("pct_bachelors", "pop_bachelors_degree"),
                ("pct_insured", "pop_health_insurance"),
            ]
        )
        + " from (select 'cd-' || d.state || '-' || d.number as district_key, 'congressional_district' as geo_level, "
        "s.state_abbr as state, try_cast(d.number as bigint) as district_number, d.name, total as total_population, "
        f"part_pop as median_household_income, {_SHARES} from raw_districts d left join states s on s.state_fips = d.state "
        "union all select 'state-' || d.state, 'state', s.state_abbr, null, d.name, total, part_pop, "
        + ", ".join(f"cast(floor(part_pop / {d}) as bigint)" for d in SHARE_DIVISORS.values())
        + " from raw_states d left join states s on s.state_fips = d.state)"
    ),
    "fct_contributions": check(
        "select md5(refno || '|' || recipid || '|' || cycle || '|' || coalesce(day::varchar, '') || '|' || "
        "coalesce(name, '') || '|' || amount || '|' || seq) as contribution_key, "
        "md5('nyc_cfb:' || recipid || ':' || cycle) as candidacy_key, person_key, "
        "md5(upper(trim(coalesce(name, ''))) || '|' || zip || '|' || upper(trim(empname))) as donor_key, "
        "'nyc_cfb' as source_system, cycle, day as contribution_date, cast(amount as double) as amount, "
        "cast(matchable as double) as matchable_amount, name as contributor_name, empname as employer_name, zip, "
        "pay_method as payment_method, recipid as recipient_id, recipname as recipient_name, "
        "null::varchar as contributor_type, null::varchar as occupation, null::varchar as city, null::varchar as state "
        "from (select *, row_number() over (partition by refno, recipid, cycle, day, name, amount order by load_at) as seq "
        "from gift where officecd <> 'IS') g left join xwalk x on x.nyc_cfb_recipient_id = g.recipid"
    ),
    "fct_candidate_finance": check(
        "select md5('fec:' || candidate_id || ':' || cycle) as candidacy_key, 'fec' as coverage, "
        f"{_MONEY.format(r='total_raised', s='total_spent')}, null::double as public_funds_received, "
        "null::double as matchable_amount_total, null::bigint as contribution_count, null::bigint as unique_donor_count, "
        "null::double as avg_contribution, null::double as pct_small_dollar from tot where office in ('H', 'S')"
    ),
    "fct_member_finance": check(
        "select member_key, bioguide_id, fec_candidate_id, cycle, "
        f"{_MONEY.format(r='total_receipts', s='total_disbursements')}, pac / 100.0 as pac_contributions, "
        "pac_t / 10.0 as pac_pct_of_total, ind_t / 10.0 as individual_pct_of_total, "
        "item / 100.0 as individual_itemized_contributions, small / 100.0 as individual_unitemized_contributions, "
        "null::double as party_contributions, null::double as candidate_self_funding from finance"
    ),
    "fct_committee_memberships": check("select distinct * from seat"),
    "fct_bill_sponsorships": check(
        "select md5(coalesce(person_key, '') || ':' || coalesce(bill_key, '') || ':' || source_system) "
        "as sponsorship_key, * from sponsorship"
    ),
    "fct_votes": check(
        "select md5(coalesce(person_key, voter_name) || ':' || vote_event_id || ':' || source_system) as vote_key, * from vote"
    ),
    "mart_conflict_of_interest": check("select * from conflict"),
    "search_members": check(
        "select member_key, bioguide_id, name, display_name, party, state, chamber, district, title, latest_congress, "
        "count(*) over () as total_count from member where name ilike '%r%' and chamber = 'house' "
        "and party ilike '%demo%' order by name, member_key limit 25 offset 25"
    ),
    "current_committees": check(
        "select member_key, congress, committee_code, committee_name from ("
        "select s.*, m.latest_congress, max(cast(s.congress = m.latest_congress as int)) over (partition by s.member_key) as has, "
        "row_number() over (partition by s.member_key order by s.congress desc, s.rank asc nulls last, s.committee_name) as rn "
        "from (select distinct * from seat) s join member m on m.member_key = s.member_key) "
        "where case when has = 1 then congress = latest_congress else rn <= 10 end"
    ),
    "latest_conflict": check(
        "select distinct on (member_key) member_key, cycle, coi_score, risk_level from conflict order by member_key, cycle desc"
    ),
    "funding_breakdown": check(
        "select * from ("
        "select member_key, cycle, 'Individual (itemized)' as source, item / 100.0 as amount from finance union all "
        "select member_key, cycle, 'Individual (small-dollar)', small / 100.0 from finance union all "
        "select member_key, cycle, 'PACs & committees', pac / 100.0 from finance) where amount <> 0"
    ),
}

ORACLE |= {
    "bill_copies": check("select id as bill_id, true as agree from raw_state_bills"),
    "member_profile": check(
        "select m.member_key, bioguide_id, name, display_name, latest_congress, committee_name, role_title, rank, congress "
        f"from member m join (select distinct * from seat) s on s.member_key = m.member_key where m.member_key = {MEMBER}"
    ),
    "finance_history": check(
        f"select cycle, {_MONEY.format(r='total_receipts', s='total_disbursements')}, pac_t / 10.0 as pac_pct_of_total "
        f"from finance where member_key = {MEMBER}"
    ),
    "voting_record": check(
        "select v.bill_key, v.vote_event_id, v.vote_date, v.vote_option, b.identifier from vote v "
        f"join bill b on b.bill_key = v.bill_key where person_key = {MEMBER} "
        "order by v.vote_date desc nulls last, v.vote_event_id limit 50"
    ),
    "bill_detail": check(
        "select bill_key, identifier, title, state, url, 'short' as plain_summary, 'ready' as summary_status "
        "from bill where bill_key = md5('openstates:ocd-7')"
    ),
    "history_series": check(
        f"select cycle, rec / 100.0 as total_receipts, pac / 100.0 as pac_contributions from finance where member_key = {MEMBER}"
    ),
    "stg_states": check(
        "select name as state_name, state as state_fips, total as total_population, "
        f"part_pop as median_household_income, {_SHARES} from raw_states"
    ),
    "stg_committees": check(
        "select committee_id, name, null::varchar as committee_type, null::varchar as committee_type_full, designation, "
        "state, null::varchar as party, organization_type, null::varchar as filing_frequency from raw_committees"
    ),
    "stg_people": check(
        "select id as openstates_id, name, party, state, timestamp '2024-01-01 00:00:00' as created_at from raw_people"
    ),
    "stg_state_bills": check("select id as bill_id, identifier, title, state, session from raw_state_bills"),
    "stg_bill_sponsorships": check(
        "select distinct on (bioguide_id, congress, type, number) bioguide_id, congress, type as bill_type, "
        "number as bill_number, cast(introduced_date as date) as introduced_date, 'Health' as policy_area, "
        "cast(introduced_date as date) as latest_action_date, 'x' as latest_action_text, null::varchar as title from raw_sponsored "
        "order by bioguide_id, congress, type, number, load_at desc"
    ),
    "stg_house_committees": check("select committee_id as committee_code, name as committee_name, null::varchar as url from raw_committees"),
    "stg_senate_committees": check("select committee_id as committee_code, name as committee_name, null::varchar as url from raw_committees"),
}
_DISTRICTS = ORACLE["dim_districts"].removeprefix(check(""))
ORACLE["column_comments"] = check(
    "select bill_key, level, 'Stable key of a state or federal bill.' as comment from bill"
)
ORACLE["written_model"] = check(f"select district_key, geo_level, total_population from ({_DISTRICTS})")


# The relations of the quality report, by the query whose check SQL yields them.
_CHECKED_BY = {
    "stg_fec__candidates": "stg_candidates",
    "stg_fec__candidate_totals": "stg_candidate_totals",
    "stg_congress__members": "stg_members",
    "stg_congress__bills": "stg_congress_bills",
    "stg_openstates__bill_sponsorships": "stg_state_bill_sponsorships",
    "stg_openstates__bill_votes": "stg_state_bill_votes",
    "stg_nyc_cfb__contributions": "stg_contributions",
    "stg_ny_boe__activity": "stg_ny_boe_activity",
    "stg_census__congressional_districts": "stg_districts",
    "stg_census__states": "stg_states",
    "stg_fec__committees": "stg_committees",
    "stg_congress__house_committees": "stg_house_committees",
    "stg_congress__senate_committees": "stg_senate_committees",
    "stg_congress__bill_sponsorships": "stg_bill_sponsorships",
    "stg_congress__house_votes": "stg_house_votes",
    "stg_congress__senate_votes": "stg_senate_votes",
    "stg_openstates__people": "stg_people",
    "stg_openstates__bills": "stg_state_bills",
    "int_persons__id_crosswalk": "int_persons_id_crosswalk",
}


def _failures(c: quality.Check) -> str:
    column = c.columns[0]
    if c.kind == "not_null":
        return f"select count(*) from {c.relation} where {column} is null"
    if c.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in c.values)
        return f"select count(*) from {c.relation} where {column} not in ({values})"
    if c.kind == "relationships":
        return (
            f"select count(*) from {c.relation} where {column} is not null "
            f"and {column} not in (select {column} from {c.parent} where {column} is not null)"
        )
    return (
        f"select count(*) from (select 1 from {c.relation} where "
        + " and ".join(f"{x} is not null" for x in c.columns)
        + f" group by {', '.join(c.columns)} having count(*) > 1)"
    )


def _dq_check() -> str:
    prefix = check("")
    names = {c.relation for c in quality.CHECKS} | {c.parent for c in quality.CHECKS if c.parent}
    bodies = {r: ORACLE[_CHECKED_BY.get(r, r)].removeprefix(prefix) for r in sorted(names - set(seeds.SCHEMAS))}
    views = "".join(f",\n{r} as materialized ({body})" for r, body in bodies.items())
    views += ",\nstate_abbreviations as (select state_name, state_abbr, state_fips from states)"
    lines = [
        f"select '{c.kind}' as \"check\", '{c.relation}' as relation, '{c.column}' as \"column\", "
        f"'{c.severity}' as severity, ({_failures(c)}) as failures"
        for c in quality.CHECKS
    ]
    return (
        prefix.rstrip() + views + "\nselect *, failures = 0 as passed from ("
        + "\nunion all ".join(lines) + ")"
    )


ORACLE["dq_models"] = ORACLE["dq_watched"] = _dq_check()
