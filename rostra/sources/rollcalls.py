"""Roll-call XML files to rows with nested votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.labels import vote_option

# Element and attribute names of the two published layouts.
HOUSE_XML = (
    "`vote-metadata` struct<congress:string,session:string,`legis-num`:string,"
    "`vote-question`:string,`vote-result`:string,`action-date`:string>, "
    "`vote-data` struct<`recorded-vote`:array<struct<"
    "legislator:struct<_VALUE:string,`_name-id`:string,_party:string,_state:string>,"
    "vote:string>>>"
)
SENATE_XML = (
    "congress string, session string, vote_number string, vote_date string, question string, "
    "vote_result string, document struct<document_type:string,document_number:string>, "
    "members struct<member:array<struct<lis_member_id:string,member_full:string,party:string,"
    "state:string,vote_cast:string>>>"
)


# A file ``roll007.xml``, or any file in a folder ``roll=7``.
ROLL_FILE = r"/roll=?0*(\d+)(?:\.xml|/[^/]*)$"


def _xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST")
    return reader.option("pathGlobFilter", "*.xml").option("recursiveFileLookup", True).schema(schema).load(path)


def unnumbered(spark: SparkSession, path: str) -> DataFrame:
    """House files whose name has no roll number."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", True).load(path)
    return files.select("path").where(~F.col("path").rlike(ROLL_FILE))


def _text(value: Column) -> Column:
    """Stripped text; an empty element is NULL."""
    return F.nullif(F.trim(value), F.lit(""))


def house_votes(spark: SparkSession, path: str) -> DataFrame:
    """``.../<year>/roll<NNN>.xml`` or ``.../year=<year>/roll=<N>/*.xml``; both numbers come from the address.

    A file under another name gives NULL there (``unnumbered`` lists them); one that cannot be
    parsed is an error.
    """
    xml = _xml(spark, path, "rollcall-vote", HOUSE_XML)
    address = F.input_file_name()
    meta = {
        name: _text(F.col(f"`vote-metadata`.`{name.replace('_', '-')}`"))
        for name in ["congress", "session", "legis_num", "vote_question", "vote_result", "action_date"]
    }
    votes = F.filter(
        F.col("`vote-data`.`recorded-vote`"), lambda v: v["legislator"].isNotNull()
    )
    member_votes = F.transform(
        votes,
        lambda v: F.struct(
            v["legislator"]["_name-id"].alias("bioguide_id"),
            v["legislator"]["_VALUE"].alias("name"),
            v["legislator"]["_party"].alias("party"),
            v["legislator"]["_state"].alias("state"),
            vote_option(v["vote"]).alias("option"),
        ),
    )
    return xml.select(
        F.lit("house").alias("chamber"),
        meta["congress"].alias("congress"),
        meta["session"].alias("session"),
        F.regexp_extract(address, ROLL_FILE, 1).try_cast("int").alias("roll_number"),
        F.regexp_extract(address, r"/(?:year=)?(\d{4})/(?:roll=[^/]*/)?[^/]*$", 1).try_cast("int").alias("year"),
        *[meta[n].alias(n) for n in ["legis_num", "vote_question", "vote_result", "action_date"]],
        F.coalesce(member_votes, F.array().cast(member_votes_type("bioguide_id"))).alias("member_votes"),
    )


def senate_votes(spark: SparkSession, path: str) -> DataFrame:
    """The bill number is set only where document type and number are both given."""
    xml = _xml(spark, path, "roll_call_vote", SENATE_XML)
    kind, number = _text(F.col("document.document_type")), _text(F.col("document.document_number"))
    member_votes = F.transform(
        F.col("members.member"),
        lambda m: F.struct(
            m["lis_member_id"].alias("lis_member_id"),
            m["member_full"].alias("name"),
            m["party"].alias("party"),
            m["state"].alias("state"),
            vote_option(m["vote_cast"]).alias("option"),
        ),
    )
    plain = [
        _text(F.col(c)).alias(c) for c in ["congress", "session", "vote_number", "vote_date"]
    ]
    return xml.select(
        F.lit("senate").alias("chamber"),
        *plain,
        F.concat(kind, F.lit(" "), number).alias("legis_num"),
        _text(F.col("question")).alias("vote_question"),
        _text(F.col("vote_result")).alias("vote_result"),
        F.coalesce(member_votes, F.array().cast(member_votes_type("lis_member_id"))).alias("member_votes"),
    )


def member_votes_type(id_name: str) -> str:
    return f"array<struct<{id_name}:string,name:string,party:string,state:string,option:string>>"
