"""Secret scans over a trigram inverted index, with DataFrame functions only.

From the syntax of each rule's regular expression follows a Boolean query over
trigrams that every match must contain.  Postings of the queries' trigrams are
kept as lists per trigram and block of documents; intersecting and joining
lists gives each rule's candidates, and only those are searched with the rule.
A rule without a mandatory trigram searches every document.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shielded, stored

#: Documents in a block of the index, on average: the bound of a postings list.
BLOCK_ROWS = 8192
#: A private-use character marks matches while they are located; texts that hold it get U+FFFD there for the search.
MARK = "\ue000"
SPAN = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` (0: the whole) has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


#: Fixed values of the base.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: Public token formats beyond the base.
MORE_RULES = (
    Rule("forge_token", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

# -- Boolean trigram queries -------------------------------------------------
# A query is True (no condition), a trigram, or ("and" | "or", frozenset of queries).

_MOST_STRINGS = 16  # strings a part of a pattern may stand for before it counts as any


def _join(kind: str, parts) -> object:
    parts = set(parts)
    if kind == "and":
        parts.discard(True)
    elif True in parts or not parts:
        return True
    flat = frozenset(q for p in parts for q in (p[1] if isinstance(p, tuple) and p[0] == kind else (p,)))
    return True if not flat else next(iter(flat)) if len(flat) == 1 else (kind, flat)


def _of_strings(strings: set[str]) -> object:
    return _join("or", (_join("and", (s[i : i + 3] for i in range(len(s) - 2))) for s in strings))


def _strings(node) -> set[str] | None:
    """The few strings that a part of the pattern stands for (lower case), or None."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN:
        out: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < _MOST_STRINGS:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= _MOST_STRINGS else None
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is sre.BRANCH:
        parts = [_sequence_strings(b) for b in arg[1]]
        return None if any(p is None for p in parts) else _few(set().union(*parts))
    if op is sre.MAX_REPEAT and arg[1] != sre.MAXREPEAT and arg[1] <= 8:
        one, out = _sequence_strings(arg[2]), None
        for n in range(arg[0], arg[1] + 1) if one is not None else ():
            power = reduce(lambda a, _: None if a is None else _few({x + y for x in a for y in one}), range(n), {""})
            out = power if out is None else None if power is None else _few(out | power)
            if out is None:
                return None
        return out
    return None


def _few(strings: set[str]) -> set[str] | None:
    return strings if len(strings) <= _MOST_STRINGS else None


def _sequence_strings(nodes) -> set[str] | None:
    out: set[str] | None = {""}
    for node in nodes:
        part = _strings(node)
        out = None if part is None else _few({a + b for a in out for b in part})
        if out is None:
            return None
    return out


def _sequence_query(nodes) -> object:
    parts, run = [], {""}
    for node in nodes:
        strings = _strings(node)
        joined = None if strings is None else _few({a + b for a in run for b in strings})
        if joined is not None:
            run = joined
            continue
        parts.append(_of_strings(run))
        run = strings if strings is not None else {""}
        op, arg = node
        if strings is not None:
            continue
        if op is sre.SUBPATTERN:
            parts.append(_sequence_query(arg[3]))
        elif op is sre.BRANCH:
            parts.append(_join("or", (_sequence_query(b) for b in arg[1])))
        elif op is sre.MAX_REPEAT and arg[0] > 0:
            parts.append(_sequence_query(arg[2]))
    return _join("and", [*parts, _of_strings(run)])


def trigram_query(pattern: str) -> object:
    """What every match of ``pattern`` must contain, in lower case."""
    return _sequence_query(sre_parser.parse(pattern))


def trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


# -- Index ---------------------------------------------------------------------


def trigram_index(docs: DataFrame, grams: list[str], key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(gram, block, postings)``: hashes of the keys of the documents that hold each trigram.

    A list holds documents of one block only, and the blocks grow in number
    with the documents, so a trigram that a third of them holds is many lists.
    A NULL key is a key; equal keys share a posting (a candidate is verified).
    """
    blocks = max(1, -(-docs.count() // block_rows))
    listed = F.array(*[F.lit(g) for g in grams])
    held = F.transform(
        F.array(F.lower(F.col(text))), lambda t: F.filter(listed, lambda g: F.contains(t, g))
    )[0]
    postings = docs.select(F.xxhash64(key).alias("posting"), F.explode(held).alias("gram"))
    return postings.groupBy("gram", F.pmod("posting", F.lit(blocks)).alias("block")).agg(
        F.collect_set("posting").alias("postings")
    )


def _evaluate(query: object, lists: Column) -> Column:
    empty = F.array().cast("array<bigint>")
    if isinstance(query, str):
        return F.coalesce(F.element_at(lists, F.lit(query)), empty)
    parts = [_evaluate(q, lists) for q in sorted(query[1], key=repr)]
    return reduce(F.array_intersect if query[0] == "and" else F.array_union, parts)


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(posting, rules)``: for each document that passes a rule's query, the kinds of those rules."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "postings"))).alias("lists"))

    def passing(rule: Rule) -> Column:
        found = _evaluate(trigram_query(rule.pattern), F.col("lists"))
        return F.transform(found, lambda p: F.struct(p.alias("p"), F.lit(rule.kind).alias("kind")))

    passed = F.array(*map(passing, rules))
    return (
        lists.select(F.explode(F.flatten(passed)).alias("_c"))
        .groupBy(F.col("_c.p").alias("posting")).agg(F.collect_set("_c.kind").alias("rules"))
    )


# -- Verification ----------------------------------------------------------------


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Leftmost non-overlapping matches of ``rule`` in ``text`` as ``(start, kind, end)``, those that fail dropped."""
    safe = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, "\ufffd")).otherwise(text)
    pieces = F.split(F.regexp_replace(safe, rule.pattern, f"{MARK}$0{MARK}"), MARK, -1)  # every second piece is a match
    held = F.length if not rule.group else lambda p: F.length(F.regexp_extract(p, rule.pattern, rule.group))

    def step(acc: Column, piece: Column) -> Column:
        end = acc["pos"] + F.length(piece)
        span = F.struct(acc["pos"].alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        hit = acc["match"] & (held(piece) >= rule.least)
        return F.struct(
            end.alias("pos"), (~acc["match"]).alias("match"),
            F.when(hit, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("pos"), F.lit(False).alias("match"), F.array().cast(SPAN).alias("out"))
    found = F.transform(F.array(pieces), lambda p: F.when(F.size(p) > 1, F.aggregate(p, start, step, lambda acc: acc["out"])))[0]
    return F.coalesce(found, F.array().cast(SPAN))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with ``secret_spans``: all spans by start, then rule; places are code points, the end exclusive.

    NULL and empty texts have none.  Columns of this name in ``docs`` are
    replaced, any others kept (``key`` and ``text`` don't begin with ``_``);
    rows with NULL or repeated keys are scanned like any other.
    """
    docs, back = shielded(docs.drop("secret_spans"))
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = tuple(r for r in rules if queries[r.kind] is not True)
    grams = sorted(set().union(*[trigrams(queries[r.kind]) for r in indexed]))
    index = stored(trigram_index(docs.select(key, text), grams, key, text, block_rows), "trigram-index")
    found = stored(candidates(index, indexed), "secret-candidates")
    body = F.coalesce(F.col(text), F.lit(""))
    joined = docs.withColumn("_posting", F.xxhash64(key)).join(
        found.select(F.col("posting").alias("_posting"), F.col("rules").alias("_rules")), "_posting", "left"
    )
    spans = []
    for number, rule in enumerate(rules):
        every = spans_of(body, rule, number)
        if rule in indexed:
            every = F.when(F.array_contains("_rules", rule.kind), every).otherwise(F.array().cast(SPAN))
        spans.append(every)
    return back(joined.withColumn("secret_spans", F.array_sort(F.concat(*spans))).drop("_posting", "_rules"))


def spans_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """``text`` with the mask for every run of overlapping spans."""
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["pos"]
        before = F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])
        return F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(fresh, F.concat(acc["out"], before, F.lit(mask))).otherwise(acc["out"]).alias("out"),
        )

    whole = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
