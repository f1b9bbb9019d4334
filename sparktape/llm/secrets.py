"""Operator 7: secrets by regular expressions behind a trigram index, in SQL functions only.

From each rule's expression a Boolean query of trigrams is derived that every match must
satisfy. The trigrams that any rule asks for are posted per text; postings are intersected
rule by rule; only the texts that are left are searched with the expression. A rule without
a mandatory trigram searches all texts.
"""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `group` has at least `shortest` characters; with
    `fold`, letters match in either case."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 0
    fold: bool = False

    @property
    def expression(self) -> str:
        return f"(?i){self.pattern}" if self.fold else self.pattern


# The base rules. Runs that fail a least length may be required to have it
# in the expression where a shorter run cannot hide a longer match.
BASE_RULES = [
    Rule(
        "assign",
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        shortest=8,
        fold=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
]
# Formats that services have published for their keys.
MORE_RULES = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
]
RULES = [*BASE_RULES, *MORE_RULES]

# -- from expressions to trigram queries ------------------------------------------------------

# Strings that a part of an expression may be listed as, and alternatives in a query.
_MOST_STRINGS, _MOST_CLAUSES = 64, 64

# A query in disjunctive form: one of the sets of trigrams is in the text in full. The
# empty set among them means that nothing is mandatory.
Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset([frozenset()])


def _absorb(clauses) -> Query:
    """Without clauses that ask for more than another one does."""
    kept: list[frozenset[str]] = []
    for clause in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if not any(other <= clause for other in kept):
            kept.append(clause)
    return frozenset(kept) if len(kept) <= _MOST_CLAUSES else ANYTHING


def _and(x: Query, y: Query) -> Query:
    if ANYTHING in (x, y):
        return y if x == ANYTHING else x
    both = _absorb(a | b for a, b in itertools.product(x, y))
    return x if both == ANYTHING else both


def _or(x: Query, y: Query) -> Query:
    return _absorb(x | y)


def _one_of(strings: frozenset[str]) -> Query:
    """One of the strings is in the text."""
    return _absorb(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


@dataclass(frozen=True)
class _Part:
    """What a part of an expression can match: all its strings if they are few (`exact`),
    else how its matches begin and end, and a query that they satisfy."""

    exact: frozenset[str] | None
    begins: frozenset[str]
    ends: frozenset[str]
    query: Query


_BLANK = frozenset([""])
_OPEN = _Part(None, _BLANK, _BLANK, ANYTHING)


def _strings(exact) -> _Part:
    exact = frozenset(exact)
    if len(exact) > _MOST_STRINGS:
        return _OPEN
    return _Part(exact, exact, exact, _one_of(exact))


def _product(x: frozenset[str], y: frozenset[str]) -> frozenset[str]:
    if len(x) * len(y) > _MOST_STRINGS:
        return _BLANK
    return frozenset(a + b for a, b in itertools.product(x, y))


def _then(x: _Part, y: _Part) -> _Part:
    if x.exact and y.exact and len(x.exact) * len(y.exact) <= _MOST_STRINGS:
        return _strings(_product(x.exact, y.exact))
    across = _product(frozenset(s[-2:] for s in x.ends), frozenset(s[:2] for s in y.begins))
    begins = _product(x.exact, y.begins) if x.exact else x.begins
    ends = _product(x.ends, y.exact) if y.exact else y.ends
    return _Part(None, begins, ends, _and(_and(x.query, y.query), _one_of(across)))


def _either(x: _Part, y: _Part) -> _Part:
    if x.exact and y.exact and len(x.exact | y.exact) <= _MOST_STRINGS:
        return _strings(x.exact | y.exact)
    return _Part(None, x.begins | y.begins, x.ends | y.ends, _or(x.query, y.query))


def _characters(items) -> _Part:
    found: set[str] = set()
    for what, value in items:
        if what is sre.LITERAL:
            found.add(chr(value).lower())
        elif what is sre.RANGE and value[1] - value[0] < _MOST_STRINGS:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return _OPEN
    return _strings(found) if len(found) <= 8 else _OPEN


def _part(what, value) -> _Part:
    if what is sre.LITERAL:
        return _strings([chr(value).lower()])
    if what is sre.IN:
        return _characters(value)
    if what is sre.AT:
        return _strings([""])
    if what is sre.SUBPATTERN:
        return _sequence(value[-1])
    if what is sre.BRANCH:
        found = [_sequence(p) for p in value[1]]
        return _fold(_either, found)
    if what in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, inner = value
        one = _sequence(inner)
        if (least, most) == (0, 1):
            return _either(one, _strings([""]))
        if not least:
            return _OPEN
        whole = _fold(_then, [one] * min(least, 4))
        if least == most <= 4:
            return whole
        return _Part(None, whole.begins, whole.ends if whole.exact is None else one.ends, whole.query)
    return _OPEN


def _fold(join, parts: list[_Part]) -> _Part:
    out = parts[0]
    for part in parts[1:]:
        out = join(out, part)
    return out


def _sequence(items) -> _Part:
    return _fold(_then, [_strings([""]), *(_part(what, value) for what, value in items)])


def trigram_query(pattern: str) -> Query:
    """Query over the trigrams of the lower-cased text that every match satisfies.

    Nothing is mandatory (`ANYTHING`) where no such trigram exists, or where a trigram
    would not be plain ASCII.
    """
    query = _sequence(parser.parse(pattern)).query
    return query if all(t.isascii() for clause in query for t in clause) else ANYTHING


# -- postings, candidates, verification -------------------------------------------------------


def _text_keys() -> list[Column]:
    text = F.col("text")
    return [F.xxhash64(text).alias("text_key"), F.xxhash64(F.lit(7), text).alias("text_key2")]


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """`text_key, text_key2, trigram`: the inverted index of the lower-cased texts, for the
    trigrams that some rule asks for; equal texts are one entry."""
    low = docs.select(*_text_keys(), F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("text_key", "text_key2", F.explode(held).alias("trigram"))


def _clauses(spark: SparkSession, queries: dict[str, Query]) -> DataFrame:
    rows = [
        f"('{kind}', {i}, '{trigram.encode().hex()}', {len(clause)})"
        for kind, query in queries.items()
        for i, clause in enumerate(sorted(query, key=sorted))
        for trigram in sorted(clause)
    ]
    return spark.sql(
        "SELECT kind, clause, decode(unhex(code), 'UTF-8') AS trigram, size FROM VALUES "
        f"{', '.join(rows)} AS clauses(kind, clause, code, size)"
    )


def candidates(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """`text_key, text_key2, kinds`: the rules whose query a text satisfies."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ANYTHING}
    spark = docs.sparkSession
    trigrams = sorted({t for query in queries.values() for clause in query for t in clause})
    if not trigrams:
        return spark.sql("SELECT 0L AS text_key, 0L AS text_key2, array('') AS kinds WHERE false")
    clauses = F.broadcast(_clauses(spark, queries))  # a few rows per rule
    met = postings(docs, trigrams).join(clauses, "trigram")
    keys = ["text_key", "text_key2"]
    met = met.groupBy(*keys, "kind", "clause").agg(
        F.collect_set("trigram").alias("held"), F.first("size").alias("size")
    )
    met = met.where(F.size("held") == F.col("size"))
    return met.groupBy(*keys).agg(F.collect_set("kind").alias("kinds"))


_SPAN = "array<struct<start:long,rank:int,stop:long,kind:string>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule's matches, left to right: their lengths and the lengths between them."""
    expression = F.lit(rule.expression)
    between = F.split(text, rule.expression, -1)
    matches = F.regexp_extract_all(text, expression, F.lit(0))
    values = F.regexp_extract_all(text, expression, F.lit(rule.group))
    pairs = F.slice(F.arrays_zip(between.alias("gap"), matches.alias("match"), values.alias("value")), 1, F.size(matches))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(state: Column, pair: Column) -> Column:
        first = state["at"] + F.length(pair["gap"])
        stop = (first + F.length(pair["match"])).alias("stop")
        span = F.struct(first.alias("start"), F.lit(rank).alias("rank"), stop, F.lit(rule.kind).alias("kind"))
        kept = F.when(F.length(pair["value"]) >= rule.shortest, F.array(span)).otherwise(F.array().cast(_SPAN))
        return F.struct(stop.alias("at"), F.concat(state["spans"], kept.cast(_SPAN)).alias("spans"))

    return F.aggregate(pairs, start, add, lambda state: state["spans"])


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """`doc_id, spans`: array of (start, rank, stop, kind) by start, then by the rule's rank.

    Positions count code points, the end is exclusive; matches of one rule do not overlap.
    A null text has no span. Rows of one doc_id are documents of their own.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = candidates(rows, rules).select(
        F.col("text_key").alias("k1"), F.col("text_key2").alias("k2"), "kinds"
    )
    keyed = rows.select("doc_id", "text", *_text_keys())
    same = (F.col("text_key") == F.col("k1")) & (F.col("text_key2") == F.col("k2"))
    keyed = keyed.join(found, same, "left")
    none = F.array().cast(_SPAN)
    parts = []
    for rank, rule in enumerate(rules):
        scanned = trigram_query(rule.pattern) == ANYTHING
        asked = F.lit(True) if scanned else F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        hit = asked & F.col("text").rlike(rule.expression)
        parts.append(F.when(hit, _spans(F.col("text"), rule, rank)).otherwise(none))
    return keyed.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
