"""Merkle manifest of a data set: a hash tree per group of rows, one root over all, a proof for every row.

A row's hash covers the named columns. The rows of a group are numbered in order, and every
``arity`` consecutive nodes become one, level by level, until one is left: the hash of their hashes,
also where the last run is shorter. The groups' roots, in the order of the groups, become the root
of all in the same way.

The numbers are written as digits. Rows of one block (``arity ** digits`` of them) are brought together
once; then the last digit is grouped away, each node holding its children as nested structs, then the
next digit, and so on, all within the partitions of the blocks. The blocks are the leaves of the next
tier. From the highest tier down, each block's nested struct is turned into one array of its leaves with their
siblings on the way, and exploded; blocks get the steps above them by a grouped union. No row is
joined with its proof, and no block or task holds more than the rows of a block at once.

NULL is a group of its own and comes first, as a NULL identifier does in its group. Rows with equal identifiers
are ordered by their hash; repeated rows keep their own leaves. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rostra.llm.common import prepare, table
from rostra.session import staged

ARITY, DIGITS = 2, 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<before:string,after:string>"


def digest(*texts: str | Column) -> Column:
    """Lower-case hex sha256 of the texts one after another."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that neighbours cannot run into each other; '-' for NULL."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_hash(values: Sequence[Column]) -> Column:
    return digest(*map(field, values))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows``, which must be staged, with rank (from 0) and size (rows) in the group ``g``.

    Sorted by range and numbered by the rows of the ranges before, so that a group may have any size.
    Rows that agree in all columns of the order are told apart by their place, so they are cut as well.
    """
    keys = [F.col("g").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], "__place"]
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = staged(placed.withColumn("__place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__place", 33)
    # One row per range, and one more per further group in it.
    starts = placed.groupBy("g", part.alias("__part")).agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    earlier = Window.partitionBy("g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        F.col("g").alias("__g"), "__part", "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__base"),
        F.sum("__n").over(Window.partitionBy("g")).alias("size"),
    )
    same = (part == starts["__part"]) & placed["g"].eqNullSafe(starts["__g"])
    rank = F.col("__base") + F.col("__place") - F.col("__first")
    return placed.join(starts, same).select(*rows.columns, rank.alias("rank"), "size")


def _whole(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def _shared(size: Column, by: int) -> Column:
    """Nodes left of ``size`` when each ``by`` of them become one."""
    return _whole(size + (by - 1), by)


def _rolled(nodes: DataFrame, arity: int, digits: int) -> DataFrame:
    """One row per block of nodes (g, rank, size, h, node): g, rank, size, below, h, node with the children."""
    block = arity**digits
    digit = lambda k: _whole(F.col("rank"), arity**k) % arity
    rows = nodes.select(
        "g", _whole(F.col("rank"), block).alias("block"), F.col("size").alias("below"), "h", "node",
        *[digit(k).cast("int").alias(f"d{k}") for k in range(digits)],
    ).repartition("g", "block")
    for k in range(digits):
        higher = [f"d{j}" for j in range(digits - 1, k, -1)]
        kids = F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("d"), "h", "node")))
        rows = rows.groupBy("g", "block", "below", *higher).agg(kids.alias("kids"))
        joined = digest(F.array_join(F.col("kids.h"), ""))
        alone = _shared(F.col("below"), arity**k) == 1
        rows = rows.select(
            "g", "block", "below", *higher, F.when(alone, F.col("kids")[0]["h"]).otherwise(joined).alias("h"),
            F.struct("kids").alias("node"),
        )
    return rows.select("g", F.col("block").alias("rank"), _shared(F.col("below"), block).alias("size"), "below", "h", "node")


def tiers(nodes: DataFrame, arity: int = ARITY, digits: int = DIGITS) -> list[DataFrame]:
    """Blocks of the nodes, blocks of those, and so on until each group has one; written one by one."""
    made = [staged(_rolled(nodes, arity, digits), "merkle-blocks")]
    while (made[-1].agg(F.max("size")).first()[0] or 0) > 1:
        above = made[-1].select("g", "rank", "size", "h", F.lit(0).alias("node"))
        made.append(staged(_rolled(above, arity, digits), "merkle-blocks"))
    return made


def _unfolded(node: Column, level: int, rank: Column, steps: Column, below: Column, arity: int) -> Column:
    """Array of (rank, h, node, steps) of the leaves under a node whose children are at ``level``."""
    kids = node["kids"]

    def one(kid: Column) -> Column:
        text = lambda keep: F.array_join(F.transform(F.filter(kids, keep), lambda k: k["h"]), "")
        step = F.struct(
            text(lambda k: k["d"] < kid["d"]).alias("before"), text(lambda k: k["d"] > kid["d"]).alias("after")
        )
        none = F.array().cast(f"array<{STEP}>")
        here = F.concat(F.when(_shared(below, arity**level) == 1, none).otherwise(F.array(step)), steps)
        place = rank * arity + kid["d"]
        if level == 0:
            return F.array(F.struct(place.alias("rank"), kid["h"].alias("h"), kid["node"].alias("node"), here.alias("steps")))
        # A list of one names what is computed so far; written out, it would double with every level.
        named = F.array(F.struct(place.alias("rank"), here.alias("steps")))
        under = F.transform(named, lambda up: _unfolded(kid["node"], level - 1, up["rank"], up["steps"], below, arity))
        return F.flatten(under)

    return F.flatten(F.transform(kids, one))


def proofs(blocks: list[DataFrame], paths: DataFrame, arity: int = ARITY, digits: int = DIGITS) -> DataFrame:
    """(g, rank, h, node, steps, above) of every leaf of the lowest tier.

    ``paths`` has g, steps and above (any struct) of each group's own root.
    """
    paths = paths.select("g", F.lit(0).cast("long").alias("rank"), "steps", "above")
    for tier in reversed(blocks):
        kinds = {f.name: f.dataType for f in [*paths.schema.fields, *tier.schema.fields]}
        missing = lambda name: F.lit(None).cast(kinds[name]).alias(name)
        both = tier.select("g", "rank", "below", "node", missing("steps"), missing("above")).union(
            paths.select("g", "rank", missing("below"), missing("node"), "steps", "above")
        )
        held = both.groupBy("g", "rank").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("below", "node", "steps", "above")]
        )
        leaves = _unfolded(F.col("node"), digits - 1, F.col("rank"), F.col("steps"), F.col("below"), arity)
        paths = held.select("g", "above", F.explode(leaves).alias("leaf")).select("g", "leaf.*", "above")
    return paths


def folded(leaf: str | Column, steps: str | Column) -> Column:
    """The root that a leaf hash and its siblings lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(steps, start, lambda h, s: digest(s["before"], h, s["after"]))


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    group_col: str = "lang",
    id_col: str = "doc_id",
    carry: dict[str, Column] | None = None,
    arity: int = ARITY,
    digits: int = DIGITS,
) -> DataFrame:
    """One row per row of ``docs``: id, grp, rank, leaf, steps, subroot, root, and the columns ``carry``.

    ``steps`` are the siblings from the leaf to the root: the hashes before and after the node's own, level by level.
    """
    carry = carry or {}
    leaves = docs.select(
        F.col(group_col).alias("g"), F.col(id_col).alias("id"), leaf_hash([F.col(c) for c in columns]).alias("h"),
        F.struct(F.col(id_col).alias("id"), *[v.alias(k) for k, v in carry.items()]).alias("node"),
    )
    own = tiers(ranked(staged(leaves, "merkle-leaves"), ["id", "h"]), arity, digits)
    groups = own[-1].select(F.lit(0).alias("g"), F.col("g").alias("grp"), "h")
    top = tiers(
        ranked(staged(groups, "merkle-groups"), ["grp"]).select("g", "rank", "size", "h", F.struct("grp").alias("node")),
        arity, digits,
    )
    start = top[-1].select(
        "g", F.array().cast(f"array<{STEP}>").alias("steps"), F.struct(F.col("h").alias("root")).alias("above")
    )
    paths = proofs(top, start, arity, digits).select(
        F.col("node.grp").alias("g"), "steps", F.struct(F.col("h").alias("subroot"), F.col("above.root")).alias("above")
    )
    return proofs(own, staged(paths, "merkle-paths"), arity, digits).select(
        "node.id", F.col("g").alias("grp"), "rank", F.col("h").alias("leaf"), "steps", "above.subroot", "above.root",
        *[f"node.{c}" for c in carry],
    )


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; those whose checksum 7 divides are folded with a false n_chars."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    false = leaf_hash([more if c == "n_chars" else F.col(c) for c in COLUMNS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest(table(prepare(spark), sf_dir, "documents"), carry={"tampered": F.when(chosen, false)})
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["before"], s["after"])), "")
    return found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), "steps")).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
