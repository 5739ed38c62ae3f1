"""Secret scans: a trigram index picks the documents that a rule has to read.

Each rule is a regular expression. From its syntax follow the trigrams that every match
must hold (``trigram_query``): an OR of ANDs. ``postings`` lists, for each of these
trigrams, the documents that hold it; ``candidates`` intersects those lists. A rule is
then run only over its candidates; a rule without a mandatory trigram (hexadecimal
runs) reads every text. Postings of trigrams that no rule asks for would never be read,
so they are not made.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bind
from .common import running_sum


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; one counts when ``group`` has
    at least ``least`` characters. A pattern may begin with ``(?i)`` (ASCII letters)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules. A run that is too short is no match, so the
# lower bound of the last two stands in the pattern.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Public formats of further credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
ALTERNATIVES = 64

Runs = tuple[str, ...]  # literal runs of one alternative, with anything between them


def _joined(a: Runs, b: Runs) -> Runs:
    return (*a[:-1], a[-1] + b[0], *b[1:])


def _alternatives(nodes) -> set[Runs]:
    """Literal runs of all alternatives of a parsed expression."""
    gap: Runs = ("", "")
    found: set[Runs] = {("",)}
    for op, value in nodes:
        name = str(op)
        if name == "LITERAL":
            here = {(chr(value),)}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            here = {(chr(v),) for _, v in value}
        elif name == "SUBPATTERN":
            here = _alternatives(value[-1])
        elif name == "BRANCH":
            here = set().union(*(_alternatives(branch) for branch in value[1]))
        elif name == "MAX_REPEAT" and value[1] == 1:
            here = {("",)} | _alternatives(value[2])
        elif name == "MAX_REPEAT" and value[0] > 0:
            here = {_joined(a, gap) for a in _alternatives(value[2])}
        else:
            here = {gap}
        if len(found) * len(here) > ALTERNATIVES:
            here = {gap}
        found = {_joined(a, b) for a, b in product(found, here)}
    return found


def trigram_query(pattern: str) -> tuple[frozenset[str], ...] | None:
    """Sets of lower-case trigrams, one of which every matching text holds whole;
    None when some match needs no trigram at all."""
    clauses = {
        frozenset(run[i:i + 3].lower() for run in runs for i in range(len(run) - 2))
        for runs in _alternatives(re._parser.parse(pattern))
    }
    if frozenset() in clauses:
        return None
    least = [c for c in clauses if not any(other < c for other in clauses)]
    return tuple(sorted(least, key=sorted))


def _asked(rules: tuple[Rule, ...]) -> list[tuple[str, int, str, int]]:
    """``kind, clause, trigram, trigrams of the clause`` of all indexed rules."""
    return [
        (rule.kind, number, trigram, len(clause))
        for rule in rules
        for number, clause in enumerate(trigram_query(rule.pattern) or ())
        for trigram in sorted(clause)
    ]


def postings(docs: DataFrame, key: str, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``trigram, key``: the documents that hold each trigram the rules ask for."""
    trigrams = sorted({trigram for _, _, trigram, _ in _asked(rules)})
    held = lambda low: F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), t) for t in trigrams]))
    return docs.select(F.col(key).alias("key"), F.explode(bind(F.lower(text), held)).alias("trigram"))


def candidates(spark: SparkSession, posted: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key, kinds``: the rules whose trigram query a document satisfies.

    The table of clauses is as large as the rules and is broadcast. Counts combine
    before the shuffle, so a trigram that every document holds is no large group.
    """
    clauses = spark.createDataFrame(_asked(rules), "kind string, clause int, trigram string, wanted int")
    met = (posted.distinct().join(F.broadcast(clauses), "trigram")
           .groupBy("key", "kind", "clause", "wanted").count().filter("count = wanted"))
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule in code points, end exclusive.

    The pieces between the matches and the matches alternate, so their lengths give
    every position.
    """
    p = F.lit(rule.pattern)
    def spans(matches: Column) -> Column:
        pieces = F.transform(F.split(text, rule.pattern, -1), lambda piece: F.length(piece).cast("bigint"))
        def placed(pieces: Column) -> Column:
            steps = F.transform(matches, lambda _, i: F.get(pieces, i) + F.coalesce(F.length(F.get(matches, i - 1)), F.lit(0)))
            return bind(running_sum(steps), lambda starts: F.transform(matches, lambda m, i: F.struct(
                F.get(starts, i).alias("start"), F.lit(rank).alias("rank"),
                (F.get(starts, i) + F.length(m)).alias("end"), F.lit(rule.kind).alias("kind"))))
        every = bind(pieces, placed)
        if not rule.group:
            return every
        values = F.transform(F.regexp_extract_all(text, p, F.lit(rule.group)), F.length)
        return bind(values, lambda v: F.filter(every, lambda _, i: F.get(v, i) >= rule.least))
    found = bind(F.regexp_extract_all(text, p, F.lit(0)), lambda m: F.when(F.size(m) > 0, spans(m)))
    return F.coalesce(F.when(F.rlike(text, p), found), F.array().cast(SPAN)).cast(SPAN)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows of ``docs`` as ``doc`` (a struct of their columns), and ``spans``.

    ``spans`` holds ``start, rank, end, kind`` by start, then by the order of the rules.
    Rows keep their columns under whatever names. A null or empty text has no spans;
    repeated rows each get theirs; the key of the index is a hash of id and text, and two
    rows that share it can only be read in vain.
    """
    rows = docs.select(
        F.struct("*").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.col(id).cast("string"), F.col(text)).alias("key"))
    picked = candidates(docs.sparkSession, postings(rows, "key", "text", rules), rules)
    indexed = {rule.kind for rule in rules if trigram_query(rule.pattern)}
    joined = rows.join(picked, "key", "left")
    each = [
        F.when(F.array_contains("kinds", rule.kind), spans).otherwise(F.array().cast(SPAN)) if rule.kind in indexed else spans
        for rank, rule in enumerate(rules) for spans in [rule_spans(F.col("text"), rule, rank)]
    ]
    return joined.select("doc", F.sort_array(F.flatten(F.array(*each))).alias("spans"))


def redact(text: Column, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> Column:
    """``text`` with the matches of each rule, one rule after the other, replaced."""
    for rule in rules:
        text = _without(text, rule, mark)
    return text


def _without(text: Column, rule: Rule, mark: str) -> Column:
    p = F.lit(rule.pattern)
    def rebuilt(t: Column) -> Column:
        matches, values = (F.regexp_extract_all(t, p, F.lit(g)) for g in (0, rule.group))
        return bind(F.split(t, rule.pattern, -1), lambda pieces: bind(matches, lambda m: bind(values, lambda v: F.array_join(
            F.transform(pieces, lambda piece, i: F.concat(piece, F.coalesce(
                F.when(F.length(F.get(v, i)) >= rule.least, F.lit(mark)), F.get(m, i), F.lit("")))), ""))))
    return bind(text, lambda t: F.when(F.rlike(t, p), rebuilt(t)).otherwise(t))
