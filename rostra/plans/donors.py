"""Donors and the candidacies they fund: edges, shared donors, finance per candidacy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import keys
from ..operators.unions import conform
from ..sinks import merged
from .staging import null

# Fixed value: contributions below this many dollars are small.
SMALL_DOLLAR = 200

EDGE_KEYS = ("donor_key", "candidacy_key")

# Columns of contributions that the models here read.
ATTRIBUTED = (
    "office_code", "contributor_name", "zip", "employer_name", "recipient_id", "election_cycle", "amount",
    "matchable_amount", "contribution_date", "load_at",
)


def attributed(contributions: DataFrame) -> DataFrame:
    """Contributions to candidates with the keys of donor and candidacy."""
    c = F.col
    return contributions.where("office_code <> 'IS'").select(
        keys.donor_key(c("contributor_name"), c("zip"), c("employer_name")).alias("donor_key"),
        keys.candidacy_key("nyc_cfb", c("recipient_id"), c("election_cycle")).alias("candidacy_key"),
        "amount", "matchable_amount", "contribution_date", "load_at",
    )


def edge_measures() -> merged.Measures:
    return {
        "total_amount": ("sum", F.col("amount")),
        "contribution_count": ("sum", F.lit(1).cast("bigint")),
        "first_date": ("min", F.col("contribution_date")),
        "last_date": ("max", F.col("contribution_date")),
    }


def fct_donor_candidate_edges(contributions: DataFrame) -> DataFrame:
    """One row per donor and candidacy."""
    return merged.aggregated(attributed(contributions), EDGE_KEYS, edge_measures())


def merge_edges(path: str, contributions: DataFrame, buckets: int = 64, batch: str | None = None) -> list[int]:
    """X1, load by load: folders by donor, rows in them by candidacy, so that both kinds of reads can skip."""
    return merged.merge_into(
        path, attributed(contributions), EDGE_KEYS, edge_measures(), by=["donor_key"], buckets=buckets, batch=batch,
        sort=["candidacy_key"],
    )


def shared_donors(edges: DataFrame, candidacy: str) -> DataFrame:
    """Other candidacies that the donors of one fund, by number of shared donors and their money.

    The candidacy's donors are a list of their own, and edges are kept where that list has their donor: no pair
    of edges is made, however many candidacies a donor funds. Over stored edges the list also
    chooses the folders that are read.
    """
    on = [c for c in (merged.BUCKET, "donor_key") if c in edges.columns]
    own = edges.where(F.col("candidacy_key") == candidacy).select(*on)
    others = edges.where(F.col("candidacy_key") != candidacy).join(own, on, "left_semi")
    return (
        others.groupBy("candidacy_key")
        .agg(F.count_distinct("donor_key").alias("shared_donors"), F.sum("total_amount").alias("shared_donor_dollars"))
        .orderBy(F.desc("shared_donors"), "candidacy_key")
    )


def finance_measures(small: int = SMALL_DOLLAR) -> merged.Measures:
    return {
        "total_raised": ("sum", F.col("amount")),
        "matchable_amount_total": ("sum", F.col("matchable_amount")),
        "contribution_count": ("sum", F.lit(1).cast("bigint")),
        "small_count": ("sum", (F.col("amount") < small).cast("bigint")),
        "donors": ("sketch", F.col("donor_key")),
    }


def merge_finance(
    path: str, contributions: DataFrame, buckets: int = 16, batch: str | None = None, small: int = SMALL_DOLLAR
) -> list[int]:
    """X3, load by load: sums per candidacy and a sketch of its donors."""
    return merged.merge_into(
        path, attributed(contributions), ["candidacy_key"], finance_measures(small), by=["candidacy_key"],
        buckets=buckets, batch=batch,
    )


FINANCE = (
    "candidacy_key string, coverage string, total_raised decimal(18,2), total_spent decimal(18,2), "
    "cash_on_hand decimal(18,2), public_funds_received decimal(18,2), matchable_amount_total decimal(18,2), "
    "contribution_count bigint, unique_donor_count bigint, avg_contribution decimal(18,2), pct_small_dollar double"
)


def _averaged(sums: DataFrame, donors: Column) -> DataFrame:
    n = F.col("contribution_count")
    return sums.select(
        "candidacy_key", F.lit("nyc_cfb").alias("coverage"), "total_raised", null("decimal(18,2)").alias("total_spent"),
        null("decimal(18,2)").alias("cash_on_hand"), null("decimal(18,2)").alias("public_funds_received"),
        "matchable_amount_total", "contribution_count", donors.cast("bigint").alias("unique_donor_count"),
        F.round(F.col("total_raised") / n, 2).alias("avg_contribution"),
        (100.0 * F.col("small_count") / n).alias("pct_small_dollar"),
    )


def candidacy_finance(sums: DataFrame, edges: DataFrame) -> DataFrame:
    """Finance of city candidacies from merged sums; donors are counted exactly, one edge each."""
    donors = edges.groupBy("candidacy_key").agg(F.count("*").alias("unique_donors"))
    return _averaged(sums.join(donors, "candidacy_key"), F.col("unique_donors"))


def estimated_finance(sums: DataFrame) -> DataFrame:
    """X3 without the edges: the number of donors is estimated from their sketch, some 1.6 percent off."""
    return _averaged(sums, F.hll_sketch_estimate("donors"))


def state_finance(activity: DataFrame) -> DataFrame:
    """What the state reports for a candidacy: public funds and expenditures."""
    return activity.groupBy(
        keys.candidacy_key("ny_boe", F.col("filer_id"), F.col("election_year")).alias("candidacy_key")
    ).agg(
        F.lit("ny_boe").alias("coverage"), F.sum("qualified_campaign_expenditures").alias("total_spent"),
        F.sum("public_funds_received").alias("public_funds_received"),
    )


def fct_candidacy_finance(
    federal: DataFrame, contributions: DataFrame, activity: DataFrame, edges: DataFrame, small: int = SMALL_DOLLAR
) -> DataFrame:
    """Finance per candidacy of all levels; what a level does not report is NULL."""
    sums = merged.aggregated(attributed(contributions), ["candidacy_key"], finance_measures(small))
    return conform(FINANCE, federal, candidacy_finance(sums, edges), state_finance(activity))


def stored_finance(spark: SparkSession, finance_path: str, edges_path: str) -> DataFrame:
    """X3 from the stored aggregates."""
    return candidacy_finance(merged.read_merged(spark, finance_path), merged.read_merged(spark, edges_path))
