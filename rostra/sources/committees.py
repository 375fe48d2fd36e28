"""Committee metadata and membership lists to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import broadcast_if_small
from .landing import required

# Fields of the published committee and membership lists.
COMMITTEES = (
    "thomas_id string, name string, type string, "
    "subcommittees array<struct<thomas_id:string,name:string>>"
)
MEMBERS = "map<string,array<struct<bioguide:string,rank:int,title:string,party:string>>>"


def committee_lookup(committees: DataFrame) -> DataFrame:
    """One row per committee or subcommittee code, a subcommittee with its parent."""
    empty = F.lit("")
    parents = committees.select(
        F.coalesce("thomas_id", empty).alias("code"),
        F.coalesce("name", empty).alias("name"),
        F.coalesce("type", empty).alias("chamber"),
        F.lit(None).cast("string").alias("parent_code"),
        F.lit(None).cast("string").alias("parent_name"),
    )
    subs = committees.select("*", F.explode("subcommittees").alias("s")).select(
        F.concat(F.coalesce("thomas_id", empty), F.coalesce("s.thomas_id", empty)).alias("code"),
        F.coalesce("s.name", empty).alias("name"),
        F.coalesce("type", empty).alias("chamber"),
        F.coalesce("thomas_id", empty).alias("parent_code"),
        F.coalesce("name", empty).alias("parent_name"),
    )
    return parents.unionByName(subs)


def flatten_memberships(memberships: DataFrame, committees: DataFrame, congress: int) -> DataFrame:
    """``memberships`` has one column ``m``: a map of code to members.

    Rows without a person are dropped; an unknown code gets an empty name and chamber.
    """
    people = (
        memberships.select(F.explode("m").alias("code", "members"))
        .select("code", F.explode("members").alias("p"))
        .where("p.bioguide <> ''")
    )
    info = committee_lookup(committees).withColumnRenamed("code", "_code")
    joined = people.join(broadcast_if_small(info), F.col("code") == F.col("_code"), "left")
    is_sub = F.col("parent_code").isNotNull() & (F.col("parent_code") != "")
    known = {c: F.coalesce(F.col(c), F.lit("")) for c in ["name", "chamber", "parent_name"]}
    return joined.select(
        F.col("p.bioguide").alias("bioguide_id"),
        F.lit(congress).alias("congress"),
        known["chamber"].alias("chamber"),
        F.when(is_sub, F.col("parent_code")).otherwise(F.col("code")).alias("committee_code"),
        F.when(is_sub, known["parent_name"]).otherwise(known["name"]).alias("committee_name"),
        F.when(is_sub, F.col("code")).alias("subcommittee_code"),
        F.when(is_sub, known["name"]).alias("subcommittee_name"),
        F.col("p.rank").alias("rank"),
        F.col("p.title").alias("title"),
        F.col("p.party").alias("party"),
    )


def read_memberships(
    spark: SparkSession, members_path: str, committees_path: str, congress: int
) -> DataFrame:
    """S7 from two landed JSON files: a list of committees and a map of members.

    A file that cannot be parsed is an error.
    """
    committees = spark.read.schema(COMMITTEES).json(committees_path, multiLine=True, mode="FAILFAST")
    text = spark.read.text(members_path, wholetext=True)
    members = F.from_json("value", MEMBERS, {"mode": "FAILFAST"})
    memberships = text.select(required(members, "the membership list is empty").alias("m"))
    return flatten_memberships(memberships, committees, congress)
