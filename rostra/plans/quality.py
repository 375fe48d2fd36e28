"""Data-quality report.

Not-null and accepted-value checks of a relation share one aggregate pass. Unique
and relationship checks first count per value, on the map side, so a hot value
travels as one row. ``Progress`` runs the checks while the relations are made, so that a
relation can be deleted as soon as nothing reads it any more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..session import drop_scratch, scratch_mark, scratch_since, staged

# Values whose hash occurs twice are told apart by a join up to so many hashes, else all values are counted.
SHARED_HASHES = 1_000_000


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | accepted_values | relationships
    relation: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    parent: str = ""
    where: str = ""
    severity: str = "error"

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def unique(relation: str, *columns: str, **kw) -> Check:
    return Check("unique", relation, columns, **kw)


def not_null(relation: str, *columns: str) -> list[Check]:
    return [Check("not_null", relation, (c,)) for c in columns]


def accepted(relation: str, column: str, values: Sequence[str], **kw) -> Check:
    return Check("accepted_values", relation, (column,), values=tuple(values), **kw)


def relates(relation: str, column: str, parent: str, **kw) -> Check:
    return Check("relationships", relation, (column,), parent=parent, **kw)


_ROW_KINDS = ("not_null", "accepted_values")

_REPORT = (
    "check string, relation string, column string, severity string, failures bigint, passed boolean"
)


def _violates(check: Check) -> Column:
    column = F.col(check.columns[0])
    if check.kind == "not_null":
        bad = column.isNull()
    else:
        bad = column.isNotNull() & ~column.isin(list(check.values))
    return bad & F.expr(check.where) if check.where else bad


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = df.agg(*[F.count_if(_violates(c)).alias(f"f{i}") for i, c in enumerate(checks)])
    entries = F.array(
        *[_entry(c, F.col(f"f{i}")) for i, c in enumerate(checks)]
    )
    return counts.select(F.explode(entries).alias("e")).select("e.*")


def _entry(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(check.relation).alias("relation"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def _present(df: DataFrame, check: Check) -> DataFrame:
    rows = df.where(check.where) if check.where else df
    return rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check.columns]))


def _value_counts(df: DataFrame, check: Check) -> DataFrame:
    return _present(df, check).groupBy(*check.columns).agg(F.count("*").alias("_n"))


def _unique_check(df: DataFrame, check: Check) -> DataFrame:
    """Number of values that occur more than once; NULLs do not count."""
    return _value_counts(df, check).agg(F.count_if(F.col("_n") > 1).alias("f")).select(
        _entry(check, F.col("f")).alias("e")
    ).select("e.*")


def _repeated(df: DataFrame, check: Check) -> int:
    """Number of values that occur more than once, as ``_unique_check`` counts them, in two jobs at most.

    Hashes travel instead of values. Only values whose hash occurs more than once are then counted themselves.
    """
    mark = scratch_mark()
    present = _present(df, check).select(*check.columns, F.xxhash64(*check.columns).alias("_hash"))
    shared = staged(present.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash"), "shared-hashes")
    many = shared.count()
    if many > SHARED_HASHES:
        found = _unique_check(df, check).first()["failures"]
    elif many:
        again = present.join(F.broadcast(shared), "_hash", "left_semi").groupBy(*check.columns).agg(F.count("*").alias("_n"))
        found = again.where("_n > 1").count()
    else:
        found = 0
    drop_scratch(df.sparkSession, scratch_since(mark))
    return found


def _packed(df: DataFrame, name: str) -> DataFrame:
    """Texts of a column as bytes: 16 and a mark for what is spelled like an md5 key, else their own and another mark."""
    if not isinstance(df.schema[name].dataType, StringType):
        return df
    value, mark = F.col(name), lambda x: F.unhex(F.lit(x))
    key = F.concat(mark("00"), F.unhex(value))
    return df.withColumn(name, F.when(value.rlike(r"\A[0-9a-f]{32}\z"), key).otherwise(F.concat(mark("01"), value.cast("binary"))))


def _relationship_check(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Number of rows whose value the parent does not have; NULLs pass."""
    column = check.columns[0]
    values, known = _present(df, check).select(column), parent.select(column)
    if values.schema[column].dataType == known.schema[column].dataType:
        values, known = _packed(values, column), _packed(known, column)
    counts = values.groupBy(column).agg(F.count("*").alias("_n"))
    missing = counts.join(known.distinct(), column, "left_anti")
    return missing.agg(F.sum("_n").alias("f")).select(_entry(check, F.col("f")).alias("e")).select("e.*")


class Watch:
    """Counts not-null and accepted-value checks of relations while they are written.

    ``on`` attaches the counters to a relation that is going to be written whole; ``counts`` has their results
    once it is, and ``report`` then leaves the relation alone for these checks.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if c.kind in _ROW_KINDS]
        self._seen: dict[str, Observation] = {}

    def on(self, relation: str, df: DataFrame) -> DataFrame:
        own = [c for c in self.checks if c.relation == relation]
        if not own:
            return df
        self._seen[relation] = Observation(f"checks of {relation}")
        return df.observe(self._seen[relation], *[F.count_if(_violates(c)).alias(f"f{i}") for i, c in enumerate(own)])

    def counts(self, relation: str) -> list[int] | None:
        """Failures of the relation's checks in their order; None if it was not watched."""
        if relation not in self._seen:
            return None
        found = self._seen[relation].get
        return [found[f"f{i}"] for i in range(len(found))]


def _watched_rows(spark: SparkSession, checks: Sequence[Check], failures: Sequence[int]) -> DataFrame:
    rows = [(c.kind, c.relation, c.column, c.severity, n) for c, n in zip(checks, failures, strict=True)]
    return spark.createDataFrame(rows, _REPORT.removesuffix(", passed boolean"))


def report(relations: Mapping[str, DataFrame], checks: Sequence[Check], watch: Watch | None = None) -> DataFrame:
    """(check, relation, column, severity, failures, passed), one row per check.

    Relations that ``watch`` saw being written are not read again for the checks it counted.
    """
    parts: list[DataFrame] = []
    for relation in dict.fromkeys(c.relation for c in checks):
        own = [c for c in checks if c.relation == relation]
        df = relations[relation]
        simple = [c for c in own if c.kind in _ROW_KINDS]
        counted = watch.counts(relation) if watch and simple else None
        if counted is not None:
            parts.append(_watched_rows(df.sparkSession, simple, counted))
        elif simple:
            parts.append(_row_checks(df, simple))
        for c in own:
            if c.kind == "unique":
                parts.append(_unique_check(df, c))
            elif c.kind == "relationships":
                parts.append(_relationship_check(df, relations[c.parent], c))
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("passed", F.col("failures") == 0)


class Progress:
    """Runs every check once the relations it reads are there, and tells which are still waited for.

    ``made`` is called after each relation, ``result`` at the end. Unique checks run one by one, so that no more than one
    relation's values travel at a time.
    """

    def __init__(self, checks: Sequence[Check], watch: Watch | None = None):
        self.checks, self.watch = list(checks), watch
        self._open = list(range(len(self.checks)))
        self._failures: dict[int, int] = {}

    def made(self, relations: Mapping[str, DataFrame]) -> None:
        """Run the checks that have not run and whose relations are all there."""
        ready = [n for n in self._open if _reads(self.checks[n]) <= relations.keys()]
        self._open = [n for n in self._open if n not in set(ready)]
        for relation in dict.fromkeys(self.checks[n].relation for n in ready):
            own = [n for n in ready if self.checks[n].relation == relation]
            simple = [n for n in own if self.checks[n].kind in _ROW_KINDS]
            counted = self.watch.counts(relation) if self.watch and simple else None
            if counted is None and simple:
                found = relations[relation].agg(*[F.count_if(_violates(self.checks[n])) for n in simple]).first()
                counted = list(found)
            self._failures.update(zip(simple, counted or [], strict=True))
            for n in own:
                check = self.checks[n]
                if check.kind == "unique":
                    self._failures[n] = _repeated(relations[relation], check)
                elif check.kind == "relationships":
                    found = _relationship_check(relations[relation], relations[check.parent], check)
                    self._failures[n] = found.first()["failures"]

    def waits_for(self) -> set[str]:
        """Relations that checks read which have not run."""
        return set().union(*[_reads(self.checks[n]) for n in self._open])

    def result(self, spark: SparkSession) -> DataFrame:
        """The rows that ``report`` gives."""
        if self._open:
            raise ValueError(f"relations that were not made: {sorted(self.waits_for())}")
        rows = _watched_rows(spark, self.checks, [self._failures[n] for n in range(len(self.checks))])
        return rows.withColumn("passed", F.col("failures") == 0)


def _reads(check: Check) -> set[str]:
    return {check.relation, check.parent} - {""}


# The constraints the relations are declared to meet.
CHECKS: list[Check] = [
    unique("state_abbreviations", "state_name"),
    unique("state_abbreviations", "state_abbr"),
    unique("state_abbreviations", "state_fips"),
    *not_null("state_abbreviations", "state_name", "state_abbr", "state_fips"),
    unique("stg_fec__candidates", "candidate_id"),
    *not_null("stg_fec__candidates", "candidate_id", "name"),
    unique("stg_fec__committees", "committee_id"),
    *not_null("stg_fec__committees", "committee_id", "name"),
    unique("stg_fec__candidate_totals", "candidate_id", "cycle"),
    *not_null("stg_fec__candidate_totals", "candidate_id", "cycle"),
    unique("stg_congress__members", "bioguide_id"),
    *not_null("stg_congress__members", "bioguide_id", "member_name", "state"),
    unique("stg_congress__house_committees", "committee_code"),
    *not_null("stg_congress__house_committees", "committee_code", "committee_name"),
    unique("stg_congress__senate_committees", "committee_code"),
    *not_null("stg_congress__senate_committees", "committee_code", "committee_name"),
    unique("stg_openstates__people", "openstates_id"),
    *not_null("stg_openstates__people", "openstates_id", "name", "state"),
    unique("stg_openstates__bills", "bill_id"),
    *not_null("stg_openstates__bills", "bill_id", "identifier", "state"),
    *not_null("stg_openstates__bill_sponsorships", "bill_id"),
    *not_null("stg_openstates__bill_votes", "bill_id", "vote_event_id"),
    *not_null("stg_congress__bills", "congress", "bill_type", "bill_number"),
    *not_null("stg_congress__bill_sponsorships", "bioguide_id", "congress"),
    *not_null("stg_congress__house_votes", "congress", "roll_number"),
    *not_null("stg_congress__senate_votes", "congress", "vote_number"),
    *not_null("stg_census__congressional_districts", "district_name", "state_fips", "district_number"),
    unique("stg_census__states", "state_fips"),
    *not_null("stg_census__states", "state_name", "state_fips"),
    *not_null("stg_ny_boe__activity", "election_year", "filer_id", "candidate_name"),
    *not_null("stg_nyc_cfb__contributions", "election_cycle", "recipient_id", "amount"),
    unique("int_persons__id_crosswalk", "person_key"),
    *not_null("int_persons__id_crosswalk", "person_key"),
    unique("int_persons__id_crosswalk", "bioguide_id", where="bioguide_id is not null"),
    unique("int_persons__id_crosswalk", "fec_candidate_id", where="fec_candidate_id is not null"),
    unique(
        "int_persons__id_crosswalk", "nyc_cfb_recipient_id", where="nyc_cfb_recipient_id is not null"
    ),
    unique("dim_candidates", "candidacy_key"),
    *not_null("dim_candidates", "candidacy_key", "display_name"),
    accepted("dim_candidates", "level", ["federal", "state", "local"]),
    accepted("dim_candidates", "source_system", ["fec", "ny_boe", "nyc_cfb"]),
    unique("dim_legislators", "legislator_id"),
    *not_null("dim_legislators", "legislator_id", "person_key"),
    accepted("dim_legislators", "chamber", ["house", "senate"]),
    unique("dim_districts", "district_key"),
    *not_null("dim_districts", "district_key"),
    accepted("dim_districts", "geo_level", ["congressional_district", "state"]),
    unique("dim_committees", "committee_id"),
    *not_null("dim_committees", "committee_id"),
    unique("fct_contributions", "contribution_key"),
    *not_null("fct_contributions", "contribution_key", "candidacy_key", "donor_key", "amount"),
    # City candidacies are not in the federal candidate dimension, so this can only warn.
    relates("fct_contributions", "candidacy_key", "dim_candidates", severity="warn"),
    unique("dim_bills", "bill_key"),
    *not_null("dim_bills", "bill_key"),
    accepted("dim_bills", "source_system", ["openstates", "congress"]),
    accepted("dim_bills", "level", ["state", "federal"]),
    unique("fct_bill_sponsorships", "sponsorship_key"),
    *not_null("fct_bill_sponsorships", "sponsorship_key"),
    relates("fct_bill_sponsorships", "bill_key", "dim_bills", severity="warn"),
    unique("fct_votes", "vote_key"),
    *not_null("fct_votes", "vote_key"),
    accepted("fct_votes", "vote_option", ["yes", "no", "abstain", "present"], severity="warn"),
    relates("fct_votes", "bill_key", "dim_bills", severity="warn"),
    unique("fct_candidate_finance", "candidacy_key"),
    *not_null("fct_candidate_finance", "candidacy_key"),
    relates("fct_candidate_finance", "candidacy_key", "dim_candidates", severity="warn"),
    accepted("fct_candidate_finance", "coverage", ["fec", "ny_boe", "nyc_cfb"]),
]
