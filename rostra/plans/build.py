"""Raw tables to staging, identity and marts, in dependency order (K6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import schemas, seeds
from ..sinks import document, materialise_table
from ..session import drop_scratch, scratch_mark, scratch_since, staged
from . import donors, identity, marts, staging
from .quality import Progress, Watch

# model -> (staging function, raw table)
STAGING = {
    "stg_census__congressional_districts": (staging.congressional_districts, "congressional_districts"),
    "stg_census__states": (staging.states, "states"),
    "stg_congress__bills": (staging.congress_bills, "congress_bills"),
    "stg_congress__bill_sponsorships": (
        staging.congress_bill_sponsorships, "congress_member_sponsorships",
    ),
    "stg_congress__members": (staging.congress_members, "members"),
    "stg_congress__committee_memberships": (
        staging.congress_committee_memberships, "congress_committee_memberships",
    ),
    "stg_congress__house_committees": (staging.house_committees, "house_committees"),
    "stg_congress__senate_committees": (staging.senate_committees, "senate_committees"),
    "stg_congress__house_votes": (staging.house_votes, "congress_house_votes"),
    "stg_congress__senate_votes": (staging.senate_votes, "congress_senate_votes"),
    "stg_fec__candidates": (staging.fec_candidates, "candidates"),
    "stg_fec__candidate_totals": (staging.fec_candidate_totals, "candidate_totals"),
    "stg_fec__committees": (staging.fec_committees, "committees"),
    "stg_ny_boe__activity": (staging.ny_boe_activity, "ny_boe_activity"),
    "stg_nyc_cfb__contributions": (staging.nyc_cfb_contributions, "nyc_cfb_contributions"),
    "stg_openstates__bills": (staging.openstates_bills, "bills"),  # of newest_bills, as two others
    "stg_openstates__people": (staging.openstates_people, "people"),
    "stg_openstates__bill_sponsorships": (staging.openstates_bill_sponsorships, "bills"),
    "stg_openstates__bill_votes": (staging.openstates_bill_votes, "bills"),
}

# model -> (function, names of the relations it takes), in dependency order.
MODELS = {
    "int_legislators__ny_boe_activity": (
        identity.legislator_activity, ["stg_ny_boe__activity", "stg_openstates__people"],
    ),
    "int_persons__federal": (
        identity.federal_persons,
        ["stg_congress__members", "stg_fec__candidates", "state_abbreviations"],
    ),
    "int_persons__state": (
        identity.state_persons,
        ["stg_openstates__people", "stg_ny_boe__activity", "int_legislators__ny_boe_activity"],
    ),
    "int_persons__local": (identity.local_persons, ["stg_nyc_cfb__contributions"]),
    "int_persons__id_crosswalk": (
        identity.crosswalk, ["int_persons__federal", "int_persons__state", "int_persons__local"],
    ),
    "dim_members": (
        marts.dim_members, ["stg_congress__members", "int_persons__federal", "state_abbreviations"],
    ),
    "dim_legislators": (
        marts.dim_legislators,
        ["stg_congress__members", "stg_openstates__people", "int_persons__federal",
         "int_persons__state", "state_abbreviations"],
    ),
    "dim_candidates": (
        marts.dim_candidates,
        ["stg_fec__candidates", "stg_fec__candidate_totals", "int_persons__federal"],
    ),
    "dim_bills": (marts.dim_bills, ["stg_openstates__bills", "stg_congress__bills"]),
    "dim_committees": (marts.dim_committees, ["stg_fec__committees"]),
    "dim_districts": (
        marts.dim_districts,
        ["stg_census__congressional_districts", "stg_census__states", "state_abbreviations"],
    ),
    "fct_contributions": (
        marts.fct_contributions, ["stg_nyc_cfb__contributions", "int_persons__local"],
    ),
    "fct_candidate_finance": (marts.fct_candidate_finance, ["stg_fec__candidate_totals"]),
    "fct_member_finance": (marts.fct_member_finance, ["stg_fec__candidate_totals", "dim_members"]),
    "fct_committee_memberships": (
        marts.fct_committee_memberships,
        ["stg_congress__committee_memberships", "dim_members", "committee_industries"],
    ),
    "fct_bill_sponsorships": (
        marts.fct_bill_sponsorships,
        ["stg_openstates__bill_sponsorships", "stg_congress__bill_sponsorships", "dim_bills",
         "int_persons__state", "int_persons__federal"],
    ),
    "fct_votes": (
        marts.fct_votes,
        ["stg_openstates__bill_votes", "stg_congress__house_votes", "stg_congress__senate_votes",
         "dim_bills", "int_persons__state", "int_persons__federal"],
    ),
    "mart_conflict_of_interest": (
        marts.mart_conflict_of_interest, ["fct_member_finance", "fct_committee_memberships"],
    ),
    "int_congress__committees": (
        marts.committee_directory, ["stg_congress__house_committees", "stg_congress__senate_committees"],
    ),
    "fct_donor_candidate_edges": (donors.fct_donor_candidate_edges, ["stg_nyc_cfb__contributions"]),
    "fct_candidacy_finance": (
        donors.fct_candidacy_finance,
        ["fct_candidate_finance", "stg_nyc_cfb__contributions", "stg_ny_boe__activity", "fct_donor_candidate_edges"],
    ),
    "mart_similar_legislators": (marts.mart_similar_legislators, ["fct_votes"]),
}

# Column descriptions stored with the tables (K8).
COMMENTS = {
    "person_key": "Resolved person; md5 of the highest-priority source ID.",
    "member_key": "person_key of an elected federal official.",
    "bill_key": "Stable key of a state or federal bill.",
    "candidacy_key": "Candidate in one cycle.",
    "donor_key": "Likely donor: name, zip and employer.",
    "unique_donor_count": "Distinct donors of a candidacy.",
    "similarity": "Cosine of two persons' votes, above 0 to 1.",
    "contribution_key": "One contribution; repeats are numbered.",
    "sponsorship_key": "Person, bill and source.",
    "vote_key": "Person or printed name, roll call and source.",
    "coi_score": "PAC and committee money in percent of all receipts.",
    "risk_level": "High from 60, Medium from 30, else Low.",
    "evidence_description": "The score in words.",
    "match_confidence": "Whole-number name similarity, 0 to 100.",
}


def empty_raw(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], f"{schemas.RAW[table]}, load_at timestamp")


def build_models(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out_dir: str | None = None,
    only: set[str] | None = None,
    watch: Watch | None = None,
    keep: bool = False,
    progress: Progress | None = None,
) -> dict[str, DataFrame]:
    """All relations by name.

    With ``out_dir`` the identity models and marts are written there and read back, so
    the crosswalk is resolved once and a lost executor never costs more than one model.
    ``only`` limits the work to the named models and what they need. Without ``out_dir``
    models stay lazy, but for those that several others read, named ones being read once more by the caller: they are
    staged in the shared folder. With ``keep`` all named relations are, so that none is made twice.
    A raw table that was never loaded counts as empty. ``watch`` counts the checks of models that are written.
    With ``progress`` its checks run as soon as they can, and what no check or model reads any more is deleted: the
    result has the relations that are left.
    """
    needed = set(STAGING) | set(MODELS) if only is None else _closure(only)
    relations: dict[str, DataFrame] = {
        name: seeds.load(spark, name) for name in seeds.SCHEMAS if only is None or name in needed
    }
    named = only or ()
    bill_models = [name for name in STAGING if name in needed and STAGING[name][1] == "bills"]
    folders: dict[str, set[str]] = {}  # of the scratch folders, those that a relation's plan reads
    start, order = scratch_mark(), _order(needed)
    for at, name in enumerate(order):
        mark = scratch_mark()
        if name in STAGING:
            function, table = STAGING[name]
            source = raw[table] if table in raw else empty_raw(spark, table)
            inputs: list[str] = []
            if table == "bills":
                # Up to three models read the newest copies, which are picked once.
                if NEWEST_BILLS not in relations:
                    newest = staging.newest_bills(source)
                    relations[NEWEST_BILLS] = staged(newest, "newest-bills") if len(bill_models) > 1 else newest
                    folders[NEWEST_BILLS] = set(scratch_since(mark))
                    mark = scratch_mark()
                source, inputs = relations[NEWEST_BILLS], [NEWEST_BILLS]
            df = function(source)
            written = name in named and bool(keep or readers_of(name, needed))
            if written:
                df = staged(watch.on(name, df) if watch else df, name)
        else:
            function, inputs = MODELS[name]
            df = document(function(*[relations[i] for i in inputs]), COMMENTS)
            written = bool(out_dir or (keep and name in named) or readers_of(name, needed) + (name in named) > 1)
            if written and watch:
                df = watch.on(name, df)
            if out_dir:
                df = materialise_table(df, f"{out_dir}/{name}")
            elif written:
                df = staged(df, name)
        relations[name] = df
        own = scratch_since(mark)
        folders[name] = set(own[-1:]) if written and not out_dir else set(own).union(*[folders.get(i, ()) for i in inputs])
        if progress:
            progress.made(relations)
            _drop_unread(spark, relations, folders, scratch_since(start), order[at + 1:], progress)
    relations.pop(NEWEST_BILLS, None)
    return relations


NEWEST_BILLS = "newest_bills"


def _order(needed: set[str]) -> list[str]:
    """Each relation that no model reads, after those that it is the first to read."""
    order: dict[str, None] = {}

    def add(name: str) -> None:
        for i in MODELS[name][1] if name in MODELS else ():
            if (i in STAGING or i in MODELS) and i not in order:
                add(i)
        order.setdefault(name)

    for name in [*STAGING, *MODELS]:
        if name in needed and not readers_of(name, needed):
            add(name)
    return list(order)


def _drop_unread(
    spark: SparkSession,
    relations: dict[str, DataFrame],
    folders: dict[str, set[str]],
    made: list[str],
    to_come: list[str],
    progress: Progress,
) -> None:
    """Forget the relations that neither models to come nor open checks read, and delete the folders that no other reads."""
    read = progress.waits_for().union(*[MODELS[m][1] for m in to_come if m in MODELS])
    if any(name in STAGING and STAGING[name][1] == "bills" for name in to_come):
        read.add(NEWEST_BILLS)
    for name in [n for n in relations if n in folders and n not in read]:
        del relations[name]
    left = set().union(*[folders[n] for n in relations if n in folders])
    drop_scratch(spark, set(made) - left)


def readers_of(name: str, needed: set[str]) -> int:
    """How many of the needed models read a relation."""
    return sum(name in inputs for model, (_, inputs) in MODELS.items() if model in needed)


def _closure(names: set[str]) -> set[str]:
    wanted = set(names)
    for name, (_, inputs) in reversed(MODELS.items()):
        if name in wanted:
            wanted.update(inputs)
    return wanted


def raw_needed(names: set[str]) -> set[str]:
    """Raw tables the named models are built from."""
    return {STAGING[name][1] for name in _closure(names) if name in STAGING}
