"""Secret scans through a trigram index.

Every rule's regular expression is analysed into a Boolean query over trigrams that any match must
contain. The trigrams that occur in queries are indexed: a posting list holds the keys of the
documents with that trigram, one list per trigram and shard of some thousand documents, so that a
common trigram never makes a long list. Each shard answers each rule's query by intersecting and
uniting its lists; the documents that come out are candidates, and only candidates are searched
with the rule's expression. A rule without mandatory trigrams searches every document.

Only DataFrame functions are used. A match is kept if its value has the rule's least length;
positions count code points, the end is exclusive, and matches of a rule never overlap.

Defined cases: a null text counts as empty; rows that repeat an id share their candidacy and are
searched each for themselves; rows without an id are keyed by a hash of their text; input columns
named like the added ones are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetmill.llm.common import pack, stored, unpack

SHARD = 4096
STRETCH = 256      # matches of a text whose positions are added up together
MOST_STRINGS = 64  # alternatives of a rule's literal text that are spelled out

# Nodes of the parsed expressions, by the names that the standard library gives them.
_parse = re._parser.parse
_IGNORED_AT = {"AT"}


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str          # valid and of one meaning in Java and Python
    value: int = 0        # the group whose length counts
    least: int = 1        # characters that it must have


# The minimum lengths of access and hex stand in the pattern: a run is matched to its end or not
# at all, so this finds the same matches as filtering whole runs, without listing the short ones.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + ADDED_RULES


# A query is True (no condition), a trigram, or ("all" | "any", queries).
def _all(parts: list) -> object:
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("all", tuple(parts))


def _any(parts: list) -> object:
    if True in parts:
        return True
    # An alternative that asks for all that another one asks for, and more, adds nothing.
    needs = {p: {p} if isinstance(p, str) else set(p[1]) if p[0] == "all" else {p} for p in parts}
    parts = [p for p in needs if not any(needs[q] < needs[p] for q in needs)]
    return parts[0] if len(parts) == 1 else ("any", tuple(parts))


def _strings_query(strings: set[str]) -> object:
    """What a text that contains one of the strings must have."""
    return _any([_all(list(dict.fromkeys(s[i:i + 3] for i in range(len(s) - 2)))) for s in sorted(strings)])


def _analyse(items) -> tuple[set[str] | None, object]:
    """Of a sequence: the lower-case strings that it matches if these are few, else a query."""
    strings: set[str] | None = {""}
    exact, queries = True, []

    def flush() -> None:
        nonlocal strings, exact
        queries.append(_strings_query(strings))
        strings, exact = {""}, False

    for op, arg in items:
        name, found, query = str(op), None, True
        if name == "LITERAL":
            found = {chr(arg).lower()}
        elif name == "IN":
            found = _class(arg)
        elif name == "SUBPATTERN":
            found, query = _analyse(arg[-1])
        elif name == "BRANCH":
            each = [_analyse(x) for x in arg[1]]
            found = set().union(*[s for s, _ in each]) if all(s is not None for s, _ in each) else None
            query = _any([_strings_query(s) if s is not None else q for s, q in each])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, body = arg
            inner, query = _analyse(body)
            if inner is not None and (least, most) == (0, 1):
                found = inner | {""}
            elif least > 0:
                query = _strings_query(inner) if inner is not None else query
            else:
                query = True
        elif name in _IGNORED_AT:
            found = {""}
        if found is not None and len(found) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, found)}
        else:
            flush()
            if found is not None and len(found) <= MOST_STRINGS:
                strings = found
            else:
                queries.append(query)
    if exact:
        return strings, True
    flush()
    return None, _all(queries)


def _class(members) -> set[str] | None:
    out: set[str] = set()
    for op, arg in members:
        if str(op) == "LITERAL":
            out.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def trigram_query(pattern: str) -> object:
    """The Boolean query over lower-case trigrams that every matching text satisfies."""
    strings, query = _analyse(_parse(pattern))
    return _strings_query(strings) if strings is not None else query


def query_trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(query_trigrams, query[1]))


def _postings(query: object, lists: Column) -> Column:
    """The keys that satisfy a query, from one shard's map of posting lists."""
    if isinstance(query, str):
        return F.coalesce(F.element_at(lists, F.lit(query)), F.array().cast("array<bigint>"))
    combine = F.array_intersect if query[0] == "all" else F.array_union
    return reduce(combine, [_postings(q, lists) for q in query[1]])


def build_index(keyed: DataFrame, trigrams: list[str], n_rows: int) -> DataFrame:
    """``shard, trigram, keys``: the inverted index of the given trigrams over ``key``, ``text``."""
    low = keyed.select("key", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    postings = low.select("key", F.explode(present).alias("trigram"))
    shard = F.pmod(F.xxhash64(F.col("key"), F.lit(1)), F.lit(max(1, math.ceil(n_rows / SHARD))))
    return postings.groupBy(shard.alias("shard"), "trigram").agg(F.collect_set("key").alias("keys"))


def candidates(index: DataFrame, queries: dict[int, object]) -> DataFrame:
    """``key, rules``: the bit set of the rules whose query the document satisfies."""
    lists = index.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))
    found = F.array(*[
        F.struct(F.lit(1 << n).cast("long").alias("rule"), _postings(q, F.col("lists")).alias("keys"))
        for n, q in queries.items()])
    return (lists.select(F.inline(found)).select("rule", F.explode("keys").alias("key"))
            .groupBy("key").agg(F.bit_or("rule").alias("rules")))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often the expression names it."""
    return F.transform(F.array(value), use)[0]


def _spans(text: Column, rule: Rule) -> Column:
    """``start, end`` of a rule's matches: the pieces between them give the positions.

    Lengths are added up within stretches of matches first and over the stretches then, so that no
    list grows match by match to the length of them all.
    """
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("piece"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.value)).alias("value"))
    kind = "array<struct<start:int,end:int>>"
    empty = F.array().cast(kind)

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + F.char_length(x["piece"])
        end = start + F.coalesce(F.char_length(x["hit"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        long_enough = x["hit"].isNotNull() & (F.char_length(x["value"]) >= rule.least)
        return F.struct(end.alias("at"), F.when(long_enough, F.concat(seen["out"], one)).otherwise(seen["out"]).alias("out"))

    def stretches(x: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / STRETCH).cast("int"))
        return F.transform(numbers, lambda i: F.aggregate(
            F.slice(x, i * STRETCH + 1, F.lit(STRETCH)), F.struct(F.lit(0).alias("at"), empty.alias("out")), step))

    def shift(seen: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda s: F.struct((s["start"] + seen["at"]).alias("start"), (s["end"] + seen["at"]).alias("end")))
        return F.struct((seen["at"] + x["at"]).alias("at"), F.concat(seen["out"], F.array(moved)).alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    walked = _bound(zipped, lambda z: _bound(stretches(z), lambda y: F.flatten(F.aggregate(y, none, shift)["out"])))
    return F.when(F.rlike(text, pattern), walked).otherwise(empty)


def _tagged(spans: Column, no: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _of_rule(found: Column, no: int) -> Column:
    return F.filter(found, lambda s: s["no"] == no)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple = RULES) -> DataFrame:
    """``id``, the input's columns as ``row``, and ``found``: structs of start, kind number, end, kind.

    The number of a kind is its place in ``rules``; the structs are sorted by start, then kind.
    """
    packed = pack(docs, id_col, text_col)
    keyed = packed.withColumn("key", F.coalesce("id", F.xxhash64("text")))
    queries = {n: q for n, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not True}
    trigrams = sorted(set().union(*map(query_trigrams, queries.values())))
    if trigrams:
        index = stored(build_index(keyed.select("key", "text"), trigrams, docs.count()), "trigrams")
        # Stored, so that its size is known when the join is planned: few candidates are broadcast.
        chosen = stored(candidates(index, queries).withColumnRenamed("key", "c_key"), "candidates")
        keyed = keyed.join(chosen, F.col("key") == F.col("c_key"), "left").drop("c_key")
    else:
        keyed = keyed.withColumn("rules", F.lit(0).cast("long"))
    each = []
    for n, rule in enumerate(rules):
        spans = _spans(F.col("text"), rule)
        if n in queries:
            asked = F.coalesce("rules", F.lit(0)).bitwiseAND(F.lit(1 << n).cast("long")) != 0
            spans = F.when(asked, spans).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        each.append(_tagged(spans, n, rule.kind))
    return keyed.select("id", "row", F.array_sort(F.concat(*each)).alias("found"))


def span_list(found: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row with the counts of the base kinds, ``base_sha256`` and ``spans``."""
    found, base = F.col("found"), len(BASE_RULES)
    counts = [F.size(_of_rule(found, n)).cast("long").alias(f"n_{r.kind}") for n, r in enumerate(BASE_RULES)]
    digest = F.sha2(span_list(F.filter(found, lambda s: s["no"] < base)), 256)
    return unpack(scan(docs, id_col, text_col), *counts, digest.alias("base_sha256"), span_list(found).alias("spans"))
