"""Secret scan over a trigram inverted index.

From every rule's pattern a Boolean query over trigrams is derived that each match must satisfy.
The index has a row per trigram and block of documents, with one bit for each of the 64 groups in
the block (four documents a group). A query is answered by and-ing and or-ing those bit sets; only
documents in groups that remain are searched with the pattern itself. A rule from which no trigram
follows is searched in all documents.

Everything on data is DataFrame expressions; Python only turns patterns into queries. Patterns must
be written in the part of the syntax that Java and Python share. Spans count code points, the end is
exclusive, matches of a kind do not overlap. NULL texts are empty. Repeated rows and rows with NULL
identifiers keep their own result rows (they share a group, so at worst they are searched in vain).
Empty tables give empty results.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rostra.llm.common import prepare, table
from rostra.session import staged

GROUP_BITS, BLOCK_BITS = 2, 8  # documents in a group, documents in a block, as powers of two
PIECE = 1 << 15  # characters taken apart at once
LARGEST_SET = 64
MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    value_group: int = 0  # the group whose length counts
    least: int = 1  # matches with a shorter value are dropped


# What the result contract fixes: patterns and lengths.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    # The longest runs that are long enough: the same spans as all runs with the short ones dropped.
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
)
# Published formats of keys and tokens. A match starts where a run of its letters does, and a scheme has
# at most 31 characters, so that a long run is not tried again from each of its places.
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("code_host", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", "[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("cloud", "AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"(?<![A-Za-z])[A-Za-z][A-Za-z0-9+.-]{0,30}://[^/\s:@]+:[^/\s:@]+@"),
)
RULES = BASE + MORE

# A query is True, a trigram, or ("and" | "or", queries).
Query = bool | str | tuple


def _join(op: str, parts: list[Query]) -> Query:
    if op == "and":
        parts = [p for p in parts if p is not True]
        if not parts:
            return True
    elif any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else (op, tuple(parts))


def _demand(texts: set[str]) -> Query:
    """One of the texts is there; a text that asks for more than another one adds nothing."""
    ways = [frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts]
    least = {w for w in ways if not any(other < w for other in ways)}
    return _join("or", [_join("and", sorted(w)) for w in sorted(least, key=sorted)] or [True])


def _letters(items) -> set[str] | None:
    """The characters of a set, lower case, or None if there are many."""
    out: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            out.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < 16:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 16 else None


class _Walk:
    """Goes through a pattern; ``texts`` are the possible texts since the last unknown part."""

    def __init__(self):
        self.texts, self.demands = {""}, []

    def unknown(self) -> None:
        self.demands.append(_demand(self.texts))
        self.texts = {""}

    def append(self, ends: set[str]) -> None:
        if len(self.texts) * len(ends) > LARGEST_SET:
            self.demands.append(_demand(self.texts))
            self.texts = {t[-2:] for t in self.texts}
        if len(self.texts) * len(ends) > LARGEST_SET:
            self.texts = {""}
        self.texts = {t + e for t in self.texts for e in ends}

    def sequence(self, parts) -> None:
        for op, value in parts:
            if op is sre.LITERAL:
                self.append({chr(value).lower()})
            elif op is sre.IN and (chars := _letters(value)):
                self.append(chars)
            elif op is sre.SUBPATTERN:
                self.sequence(value[-1])
            elif op is sre.BRANCH:
                self.either([_walked(p) for p in value[1]])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                least, most, inner = value
                if (least, most) == (0, 1):
                    self.either([_walked(inner), _Walk()])
                else:
                    if 0 < least <= 4:
                        for _ in range(least):
                            self.sequence(inner)
                    elif least:
                        self.sequence(inner)
                    if least > 4 or most != least:
                        self.unknown()
            elif op is not sre.AT:
                self.unknown()

    def either(self, ways: list[_Walk]) -> None:
        if all(not w.demands for w in ways):
            self.append(set().union(*[w.texts for w in ways]))
        else:
            self.unknown()
            self.demands.append(_join("or", [w.query() for w in ways]))

    def query(self) -> Query:
        return _join("and", [*self.demands, _demand(self.texts)])


def _walked(parts) -> _Walk:
    walk = _Walk()
    walk.sequence(parts)
    return walk


def trigram_query(pattern: str) -> Query:
    """What the lower-case trigrams of a text must satisfy for the pattern to match in it."""
    return _walked(sre_parser.parse(pattern)).query()


def trigrams_of(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _number(id_column: Column, kind: T.DataType) -> Column:
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(id_column.cast("long") if whole else F.xxhash64(id_column), F.lit(0).cast("long"))


def _block(number: Column) -> Column:
    return F.shiftright(number, BLOCK_BITS)


def _bit(number: Column) -> Column:
    inside = F.shiftright(number.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)), GROUP_BITS)
    return F.call_function("shiftleft", F.lit(1).cast("long"), inside.cast("int"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index and return it: ``trigram`` (lower case), ``block``, ``groups`` (bit set)."""
    number = _number(F.col(id_col), docs.schema[id_col].dataType)
    pieces = docs.where(F.col(text_col).isNotNull()).select(
        _block(number).alias("block"),
        _bit(number).alias("bit"),
        # Pieces with the two characters that follow them, in one pass over the text.
        F.explode(
            F.regexp_extract_all(
                F.col(text_col).cast("string"), F.lit(f"(?s)(?=(.{{1,{PIECE + 2}}})).{{1,{PIECE}}}"), F.lit(1)
            )
        ).alias("piece"),
    )
    listed = pieces.select(
        "block",
        "bit",
        F.explode(
            F.array_distinct(F.regexp_extract_all(F.lower("piece"), F.lit("(?s)(?=(.{3}))"), F.lit(1)))
        ).alias("trigram"),
    )
    index = listed.groupBy("trigram", "block").agg(F.bit_or("bit").alias("groups"))
    return staged(index.sortWithinPartitions("trigram", "block"), "trigrams")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per block and rule with a query, the groups of documents that satisfy it."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = sorted(set().union(*map(trigrams_of, queries.values())))
    names = {t: f"t{n}" for n, t in enumerate(wanted)}
    none = F.lit(0).cast("long")
    sets = index.where(F.col("trigram").isin(wanted)).groupBy("block").agg(
        *[F.coalesce(F.bit_or(F.when(F.col("trigram") == t, F.col("groups"))), none).alias(n) for t, n in names.items()]
    )

    def solve(query: Query) -> Column:
        if isinstance(query, str):
            return F.col(names[query])
        op, parts = query
        return reduce(lambda a, b: a.bitwiseAND(b) if op == "and" else a.bitwiseOR(b), map(solve, parts))

    indexed = [k for k, q in queries.items() if q is not True]
    found = sets.select(F.col("block").alias("__block"), *[solve(queries[k]).alias(f"__{k}") for k in indexed])
    some = reduce(lambda a, b: a | b, [F.col(f"__{k}") != 0 for k in indexed], F.lit(False))
    return staged(found.where(some), "candidates")


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """Matches of a rule as (start, place of the rule, kind, end)."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    matches = F.arrays_zip(
        between.alias("before"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"),
        F.regexp_extract_all(text, pattern, F.lit(rule.value_group)).alias("value"),
    )
    shape = "struct<at:int,found:array<struct<start:int,place:int,kind:string,end:int>>>"

    def step(state: Column, m: Column) -> Column:
        start = state["at"] + F.length(m["before"])
        end = start + F.coalesce(F.length(m["all"]), F.lit(0))
        one = F.struct(
            start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        kept = F.when(F.length(m["value"]) >= rule.least, F.concat(state["found"], F.array(one))).otherwise(state["found"])
        return F.struct(end.alias("at"), kept.alias("found")).cast(shape)

    zero = F.struct(F.lit(0).alias("at"), F.array().alias("found")).cast(shape)
    return F.aggregate(matches, zero, step)["found"]


def with_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    to: str = "spans",
) -> DataFrame:
    """All rows and columns of ``docs``, and ``to``: spans (start, place, kind, end) by start, then rule."""
    found = candidates(build_index(docs, id_col, text_col), rules)
    number = _number(docs[id_col], docs.schema[id_col].dataType)
    joined = docs.join(found, _block(number) == F.col("__block"), "left")
    text, empty = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.array().cast(
        "array<struct<start:int,place:int,kind:string,end:int>>"
    )
    each = []
    for place, rule in enumerate(rules):
        if f"__{rule.kind}" in found.columns:
            search = F.coalesce(F.col(f"__{rule.kind}").bitwiseAND(_bit(number)) != 0, F.lit(False))
        else:
            search = text.rlike(rule.pattern)
        each.append(F.when(search, _spans(text, rule, place)).otherwise(empty))
    return joined.select(*[docs[c] for c in docs.columns], F.array_sort(F.concat(*each)).alias(to))


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """All rows of ``docs`` with a mark in place of every secret; spans that overlap become one.

    The column of text lengths, if there, is set to the new length where a secret was masked.
    """
    found = with_spans(docs, id_col, text_col, to="__spans")
    text = F.col(text_col)
    shape = "struct<at:int,parts:array<string>>"

    def step(state: Column, s: Column) -> Column:
        fresh = F.concat(
            state["parts"],
            F.array(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(MASK)),
        )
        parts = F.when(s["start"] >= state["at"], fresh).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), parts.alias("parts")).cast(shape)

    zero = F.struct(F.lit(0).alias("at"), F.array().alias("parts")).cast(shape)
    masked = F.aggregate(
        "__spans", zero, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    )
    some = F.size("__spans") > 0
    out = found.withColumn("__masked", F.when(some, masked).otherwise(text))
    columns = [
        F.col("__masked").alias(c)
        if c == text_col
        else F.when(some, F.length("__masked")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
        if c == chars_col
        else F.col(c)
        for c in docs.columns
    ]
    return out.select(*columns)


def op5_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Spans of every document: the base kinds counted and digested, and all spans."""
    found = with_spans(table(prepare(spark), sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    places = F.transform("spans", lambda s: s["place"])
    counts = [
        (F.size(places) - F.size(F.array_remove(places, k))).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(BASE)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
