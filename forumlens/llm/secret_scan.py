"""Operator 11, secret scan over a trigram inverted index (DataFrame and SQL
functions only).

Each rule is a regular expression.  ``trigram_query`` derives from it a
Boolean query over trigrams that every match must contain (ASCII letters in
lower case): a conjunction over what follows one another, a disjunction over
alternatives and small character classes.  ``build_index`` writes, for the
trigrams that the rules name, postings cut into blocks of documents;
``candidates`` intersects and unites the posting lists of a block as the
queries say, and ``scan`` verifies each candidate by its regular expression.
A rule without mandatory trigrams (``hex``) scans every text.

Scale: the index holds only hashes of documents; copies of one row are one
posting, and a block has about ``BLOCK_DOCS`` documents at every size, so a
trigram that all documents hold is spread over all blocks.  The candidates
are joined with the documents on the hash; a clash of hashes only adds
candidates.  Texts move only where that join is too large to broadcast, as
Spark measures it.

Defined results: a null text is read as an empty one and has no spans; rows
are kept as they are, repeated ones too, whatever their other columns and
names; a null key is a value like others; an empty table gives no rows.
Spans of one rule are leftmost and do not overlap (those of different rules
may); texts are searched whole.  Offsets count code points, the end is
exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import materialize
from forumlens.session import ensure_checkpoint_dir

BLOCK_DOCS = 4096             # documents of an index block, about
RUN = 512                     # matches that are added up together
STRINGS = 64                  # strings that one part of a query may list


def either(word: str) -> str:
    """A pattern for an ASCII word with letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``kind`` names the rule; a match counts if its ``group`` has at least
    ``least`` characters.  Patterns use what Java, RE2 and Python share."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


_NAMES = "|".join(either(w) for w in ("password", "passwd", "secret", "token"))

# Runs of 24 or more are the runs of any length that have 24 or more, as a
# run is taken whole; 20 characters with the four of AKIA likewise.
BASE_RULES = (
    Rule("assign", f"({_NAMES}|{either('api')}_?{either('key')})"
                   "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
# public formats of credentials
MORE_RULES = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("url", "[A-Za-z]://[^\\x00-\\x20/:@]+:[^\\x00-\\x20/:@]+@[A-Za-z0-9]"),
)
RULES = BASE_RULES + MORE_RULES


# ---- Boolean trigram queries -------------------------------------------------
# A query is a disjunction of conjunctions: a set of sets of trigrams.  The
# empty conjunction holds for every text.

Query = frozenset[frozenset[str]]
EVERY: Query = frozenset([frozenset()])


def _least(query: set[frozenset[str]]) -> Query:
    """Without the conjunctions that imply another one."""
    return frozenset(c for c in query if not any(d < c for d in query))


def _all_of(parts: list[Query]) -> Query:
    return _least({frozenset().union(*p) for p in product(*parts)})


def _one_of(parts: list[Query]) -> Query:
    return _least(set().union(*parts))


def _of_strings(strings: set[str]) -> Query:
    return _least({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def _fold(code: int) -> str:
    return chr(code).lower() if code < 128 else chr(code)


def _class(items: list) -> set[str] | None:
    out: set[str] = set()
    for op, value in items:
        if str(op) == "LITERAL":
            out.add(_fold(value))
        elif str(op) == "RANGE" and value[1] - value[0] < STRINGS:
            out |= {_fold(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= STRINGS // 4 else None


def _part(op: str, value) -> tuple[set[str] | None, Query]:
    """What a part of a pattern stands for: all its strings if they are few,
    else the query that its matches satisfy."""
    if op == "LITERAL":
        return {_fold(value)}, EVERY
    if op == "IN":
        return _class(value), EVERY
    if op == "AT":
        return {""}, EVERY
    if op == "SUBPATTERN":
        return _sequence(value[-1])
    if op == "BRANCH":
        parts = [_sequence(x) for x in value[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= STRINGS:
            return set().union(*(s for s, _ in parts)), EVERY
        return None, _one_of([q if s is None else _of_strings(s) for s, q in parts])
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        least, most, inner = value
        strings, query = _sequence(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, EVERY
        if least == 0:
            return None, EVERY
        if least == most and strings is not None and len(strings) ** int(least) <= STRINGS:
            return {"".join(p) for p in product(strings, repeat=int(least))}, EVERY
        return None, query if strings is None else _of_strings(strings)
    return None, EVERY


def _sequence(parts) -> tuple[set[str] | None, Query]:
    run, queries, whole = {""}, [], True
    for op, value in parts:
        strings, query = _part(str(op), value)
        if strings is not None and len(run) * len(strings) <= STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        whole = False
        queries += [_of_strings(run), query]
        run = strings if strings is not None else {""}
    return (run, EVERY) if whole else (None, _all_of(queries + [_of_strings(run)]))


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression."""
    strings, query = _sequence(re._parser.parse(pattern))
    return query if strings is None else _of_strings(strings)


def scans_fully(rule: Rule) -> bool:
    return trigram_query(rule.pattern) == EVERY


# ---- index and candidates ------------------------------------------------------

def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def build_index(docs: DataFrame, key: Column, text: Column, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(block, postings): per block of documents a map from each trigram
    that the rules name to the keys of the documents that hold it."""
    named = sorted({t for r in rules for part in trigram_query(r.pattern) for t in part})
    blocks = max(1, math.ceil(docs.count() / BLOCK_DOCS))
    held = _let(F.lower(text), lambda low: F.filter(F.array(*map(F.lit, named)).cast("array<string>"),
                                                    lambda t: F.contains(low, t)))
    rows = docs.select(key.alias("key"), held.alias("held"))
    rows = rows.select(F.pmod("key", F.lit(blocks)).alias("block"), "key", F.explode("held").alias("trigram"))
    lists = rows.groupBy("block", "trigram").agg(F.collect_set("key").alias("keys"))
    index = lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("postings"))
    return materialize(index, "trigrams")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, kinds): the rules that each document is a candidate of."""
    asked = {r.kind: sorted(map(sorted, trigram_query(r.pattern))) for r in rules if not scans_fully(r)}
    queries = F.lit(None) if not asked else F.array(*(F.struct(
        F.lit(kind).alias("kind"), F.array(*(F.array(*map(F.lit, part)) for part in parts)).alias("parts"))
        for kind, parts in asked.items()))
    queries = queries.cast("array<struct<kind:string,parts:array<array<string>>>>")
    none = F.array().cast("array<bigint>")

    def keys(trigram: Column) -> Column:
        return F.coalesce(F.col("postings")[trigram], none)

    def meet(part: Column) -> Column:
        return F.aggregate(part, keys(part[0]), lambda found, t: F.array_intersect(found, keys(t)))

    lists = index.select("postings", F.inline(queries)).select("kind", F.explode(
        F.aggregate("parts", none, lambda found, part: F.array_union(found, meet(part)))).alias("key"))
    return materialize(lists.groupBy("key").agg(F.collect_set("kind").alias("kinds")), "candidates")


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of a rule's matches in a text."""
    pattern, none = F.lit(rule.pattern), F.array().cast("array<struct<start:bigint,end:bigint>>")
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    if rule.least:
        counts = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda v: F.length(v) >= rule.least)
    else:
        counts = F.transform(hits, lambda h: F.lit(True))
    steps = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), counts.alias("counts")),
                     lambda s: s["hit"].isNotNull())

    def step(state: Column, s: Column) -> Column:
        start = state["pos"] + s["gap"]
        end = start + s["hit"]
        return F.struct(end.alias("pos"), F.concat(state["out"], F.when(
            s["counts"], F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(none)).alias("out"))

    def run(state: Column, at: Column, steps: Column) -> Column:
        # a run is added up by itself: the list of all matches grows by runs
        part = F.aggregate(F.slice(steps, at, RUN), F.struct(state["pos"].alias("pos"), none.alias("out")), step)
        return _let(part, lambda p: F.struct(p["pos"].alias("pos"),
                                             F.concat(state["out"], F.array(p["out"])).alias("out")))

    start = F.struct(F.lit(0).cast("long").alias("pos"),
                     F.array().cast("array<array<struct<start:bigint,end:bigint>>>").alias("out"))
    return _let(steps, lambda s: F.when(F.size(s) == 0, none).otherwise(F.flatten(F.aggregate(
        F.sequence(F.lit(1), F.size(s), F.lit(RUN)), start, lambda a, at: run(a, at, s), lambda a: a["out"]))))


def scan(documents: DataFrame, *, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(row, spans): ``spans`` is an array of (start, rank, end, kind, secret)
    ordered by start, then by the rules' order (``rank``)."""
    ensure_checkpoint_dir(documents.sparkSession)
    names = documents.columns                # numbered meanwhile: none can clash
    docs = documents.toDF(*(f"_c{i}" for i in range(len(names))))
    body = f"_c{names.index(text)}"
    key = F.xxhash64(f"_c{names.index(doc_id)}", body)
    found = candidates(build_index(docs, key, F.col(body), rules), rules)
    rows = docs.withColumn("key", key).join(found, "key", "left")
    whole = F.coalesce(body, F.lit(""))
    parts = []
    for rank, rule in enumerate(rules):
        spans = F.transform(spans_of(whole, rule), lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(rule.kind).alias("kind"),
            F.substring(whole, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")).alias("secret")))
        if not scans_fully(rule):
            empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,secret:string>>")
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(empty)
        parts.append(spans)
    row = F.struct(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)))
    return rows.select(row.alias("row"), F.array_sort(F.concat(*parts)).alias("spans"))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document with the counts and lists of its spans."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = [r.kind for r in BASE_RULES]
    return found.select(
        F.col("row")[doc_id].alias("doc_id"),
        *(F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def _sql(rank: int, rule: Rule) -> str:
    p = rule.pattern.replace("'", "''")
    value = f"regexp_extract_all(t, '{p}', {rule.group})"
    return f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind,
       list_sum(gaps[1:i]) + coalesce(list_sum(hits[1:i - 1]), 0) AS a, list_sum(gaps[1:i]) + list_sum(hits[1:i]) AS b
FROM (SELECT doc_id, gaps, hits, vals, unnest(range(1, len(hits) + 1)) AS i
      FROM (SELECT doc_id, list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) AS gaps,
                   list_transform(regexp_extract_all(t, '{p}'), lambda x: length(x)) AS hits,
                   list_transform({value}, lambda x: length(x)) AS vals FROM d))
WHERE vals[i] >= {rule.least}"""


_JOINED = "string_agg(kind || ':' || CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(b AS BIGINT) AS VARCHAR), ',' ORDER BY a, rank)"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({' UNION ALL '.join(_sql(i, r) for i, r in enumerate(RULES))}),
g AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)},
             {_JOINED} FILTER (rank < {len(BASE_RULES)}) AS base, {_JOINED} AS spans
      FROM s GROUP BY doc_id)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""
