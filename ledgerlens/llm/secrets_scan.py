"""Secret scan with a trigram inverted index, in DataFrame operations alone.

1. From each rule's regular expression comes a Boolean query over trigrams of the
   text in lower case (``trigram_query``): any of some sets, all trigrams of a set.
   A rule whose expression asks for no trigram has the query "anything".
2. ``build_index`` writes an inverted index: for each trigram that some rule asks
   about, the keys of the texts that hold it. A key is a 64-bit hash of the text, so
   copies share one posting; lists are cut into blocks of keys, none grows with the
   corpus. Two texts with one key can only add a candidate, never lose one.
3. ``candidates`` intersects the postings of a set, unites the sets of a rule, and
   leaves the keys of the texts that a rule has to look at.
4. ``scan`` verifies: a rule's expression runs on its candidates alone. Rules
   without a mandatory trigram run on every text. To bring candidates back to their
   texts, only texts that hold a trigram of the shortest postings of some rule are
   shuffled: an intersection starts from its shortest list, so no other text can be
   in one.

Matches are leftmost and do not overlap, per rule; then those whose group is too
short are dropped. Places count code points: lengths of what stands between the
matches, summed up.

Edge cases: null text is empty: no span; an empty table gives an empty result;
rows are verified one by one, so repeated or null ids keep their rows apart; a text
of any length is read whole; only the id and the text are read, other columns may
have any name. Letters count as equal in either case for A-Z alone.
"""

from __future__ import annotations

import uuid
from functools import reduce
from re import _constants as C
from re import _parser as regex_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import shuffle_width, whole_text
from ledgerlens.sources.tables import write_read


class Rule(NamedTuple):
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(words: str) -> str:
    """A pattern with each letter a-z outside brackets as a class of both cases."""
    return "".join(f"[{c.upper()}{c}]" if "a" <= c <= "z" else c for c in words)


# The rules whose spans every report counts.
BASE = [
    Rule("assign", "(" + either_case("password|passwd|secret|token|api_?key")
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
]
# Public token formats.
FORMATS = [
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("payment", "[rs]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"://[^\x09-\x0D\x20/:@]+:[^\x09-\x0D\x20/@]+@"),
]
RULES = BASE + FORMATS

# Boolean queries: any of these sets, all trigrams of a set. One empty set: anything may match.
Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset([frozenset()])
MOST_STRINGS, MOST_CLASS = 64, 8


def _absorbed(sets: Query) -> Query:
    """Without sets that contain another one: the smaller already says as much."""
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _both(a: Query, b: Query) -> Query:
    whole = _absorbed(frozenset(x | y for x in a for y in b))
    return whole if len(whole) <= MOST_STRINGS else min(a, b, key=len)


def _of_strings(strings: set[str]) -> Query:
    return _absorbed(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _class(items) -> set[str] | None:
    """Characters of a class in lower case, None when they are many."""
    chars: set[str] = set()
    for op, value in items:
        if op is C.LITERAL:
            chars.add(chr(value).lower())
        elif op is C.RANGE and value[1] - value[0] < 2 * MOST_CLASS:
            chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return chars if len(chars) <= MOST_CLASS else None


def _strings(op, value) -> set[str] | None:
    """All strings that a part of an expression can match, None when they are many."""
    if op is C.LITERAL:
        return {chr(value).lower()}
    if op is C.IN:
        return _class(value)
    if op is C.AT:
        return {""}
    if op is C.SUBPATTERN:
        return _sequence(value[-1])[0]
    if op is C.BRANCH:
        parts = [_sequence(branch)[0] for branch in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is C.MAX_REPEAT and value[1] is not C.MAXREPEAT and value[1] <= 4:
        own = _sequence(value[2])[0]
        if own is not None and (len(own) + 1) ** value[1] <= MOST_STRINGS:
            return set().union(*(_power(own, n) for n in range(value[0], value[1] + 1)))
    return None


def _power(strings: set[str], n: int) -> set[str]:
    return reduce(lambda done, _: {a + b for a in done for b in strings}, range(n), {""})


def _query(op, value) -> Query:
    """What a part that can match many strings still asks for."""
    if op is C.SUBPATTERN:
        return _sequence(value[-1])[1]
    if op is C.BRANCH:
        return _absorbed(frozenset().union(*(_sequence(branch)[1] for branch in value[1])))
    if op is C.MAX_REPEAT and value[0] >= 1:
        return _sequence(value[2])[1]
    return ANYTHING


def _sequence(parts) -> tuple[set[str] | None, Query]:
    """All strings of a sequence (None: many) and its query."""
    run, query, whole = {""}, ANYTHING, True
    for op, value in parts:
        own = _strings(op, value)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
        else:
            query = _both(_both(query, _of_strings(run)), _of_strings(own) if own is not None else _query(op, value))
            run, whole = {""}, False
    return (run if whole else None), _both(query, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """Sets of lower-case trigrams, all of one of which every match of ``pattern`` holds."""
    query = _sequence(regex_parser.parse(pattern))[1]
    return ANYTHING if frozenset() in query else query


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole_text(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))


def _grams(rules: list[Rule]) -> list[str]:
    return sorted({g for r in rules for s in trigram_query(r.pattern) for g in s})


BLOCKS_PER_PARTITION = 64


def build_index(rows: DataFrame, grams: list[str]) -> DataFrame:
    """The written inverted index ``block, gram, keys`` of ``rows`` (``text``, ``key``)."""
    spark = rows.sparkSession
    held = _let(F.lower("text"), lambda low: F.array_compact(F.array(
        *[F.when(F.contains(low, F.lit(g)), F.lit(i).cast("short")) for i, g in enumerate(grams)])))
    blocks = shuffle_width(spark) * BLOCKS_PER_PARTITION
    texts = rows.select("key", held.alias("held")).groupBy("key").agg(F.first("held").alias("held"))
    postings = texts.select(F.pmod("key", F.lit(blocks)).cast("int").alias("block"), "key", F.explode("held").alias("gram"))
    lists = postings.groupBy("block", "gram").agg(F.collect_list("key").alias("keys"))
    return write_read(spark, lists, f"secrets-{uuid.uuid4().hex}", "index")


def candidates(index: DataFrame, rules: list[Rule], grams: list[str]) -> DataFrame:
    """The written table ``key, rules``: bit k tells that rule k has to look at the texts of this key."""
    spark, number = index.sparkSession, {g: i for i, g in enumerate(grams)}
    none = F.array().cast("array<bigint>")

    def keys_of(query: Query) -> Column:
        sets = [reduce(F.array_intersect, [F.coalesce(F.col("lists")[number[g]], none) for g in sorted(s)])
                for s in sorted(query, key=sorted)]
        return reduce(F.array_union, sets)

    blocks = index.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("gram").cast("int").alias("gram"), "keys"))).alias("lists"))
    def pairs_of(query: Query, bit: Column) -> Column:
        return F.transform(keys_of(query), lambda key: F.struct(key.alias("key"), bit.alias("rule")))

    asked = [(k, q) for k, q in enumerate(trigram_query(r.pattern) for r in rules) if q != ANYTHING]
    found = [pairs_of(q, F.lit(1 << k).cast("long")) for k, q in asked]
    pairs = blocks.select(F.explode(F.concat(*found)).alias("found")).select("found.key", "found.rule")
    return write_read(spark, pairs.groupBy("key").agg(F.bit_or("rule").alias("rules")), f"secrets-{uuid.uuid4().hex}", "found")


def shortest(index: DataFrame, rules: list[Rule], grams: list[str]) -> list[str]:
    """For each set of each rule the trigram with the fewest postings (at most one number per trigram is collected)."""
    held = {grams[r["gram"]]: r["n"] for r in index.groupBy("gram").agg(F.sum(F.size("keys")).alias("n")).collect()}
    lead = {min(s, key=lambda g: (held.get(g, 0), g)) for r in rules for s in trigram_query(r.pattern) if s}
    return sorted(g for g in lead if held.get(g, 0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _running(sizes: Column) -> Column:
    """Sums of all numbers up to each one. In steps of the root of their count: no quadratic work on a long list."""
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(sizes).cast("double")))).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.size(sizes) - 1, F.lit(0)), step),
                        lambda at: F.slice(sizes, at + 1, step))

    def one(part: Column, before: Column) -> Column:
        return F.transform(part, lambda _, i: before + _total(F.slice(part, F.lit(1), i + 1)))

    def whole(parts: Column, sums: Column) -> Column:
        return F.flatten(F.transform(parts, lambda part, k: _let(_total(F.slice(sums, F.lit(1), k)), lambda before: one(part, before))))

    return _let(parts, lambda p: _let(F.transform(p, _total), lambda sums: whole(p, sums)))


SPAN = "array<struct<start:bigint, nth:int, end:bigint, kind:string>>"


def spans_of(text: Column, rule: Rule, nth: int) -> Column:
    """The rule's spans in ``text``."""
    pattern = F.lit(rule.pattern)

    def lengths(texts: Column) -> Column:
        return F.transform(texts, lambda t: F.length(t).cast("long"))

    def placed(sizes: Column, between: Column) -> Column:
        chars = lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))) if rule.group else sizes
        return _let(F.zip_with(between, sizes, lambda a, b: a + b), lambda steps: F.arrays_zip(
            sizes.alias("size"), _running(steps).alias("end"), chars.alias("chars")))

    found = _let(lengths(F.regexp_extract_all(text, pattern, F.lit(0))), lambda sizes: placed(
        sizes, F.slice(lengths(F.split(text, rule.pattern, -1)), F.lit(1), F.size(sizes))))
    return F.transform(F.filter(found, lambda e: e["chars"] >= rule.least), lambda e: F.struct(
        (e["end"] - e["size"]).alias("start"), F.lit(nth).alias("nth"), e["end"].alias("end"), F.lit(rule.kind).alias("kind"))).cast(SPAN)


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id`` and ``spans``: start, place of the rule in ``rules``, end (exclusive) and kind, in this order."""
    rows = _rows(docs, id_col, text_col)
    grams = _grams(rules)
    index = build_index(rows, grams)
    found = candidates(index, rules, grams).withColumnRenamed("key", "found_key")
    lead = shortest(index, rules, grams)
    may = _let(F.lower("text"), lambda low: reduce(lambda a, b: a | b, [F.contains(low, F.lit(g)) for g in lead], F.lit(False)))
    parted = rows.withColumn("may", may)
    asked = parted.filter("may").join(found, F.col("key") == F.col("found_key"), "left").select("id", "text", "rules")
    rest = parted.filter("NOT may").select("id", "text", F.lit(None).cast("long").alias("rules"))
    none = F.array().cast(SPAN)
    spans = []
    for k, rule in enumerate(rules):
        whole = trigram_query(rule.pattern) == ANYTHING
        look = _long_run(rule) if whole else F.coalesce(F.col("rules").bitwiseAND(F.lit(1 << k)) != 0, F.lit(False))
        spans.append(F.when(look, spans_of(F.col("text"), rule, k)).otherwise(none))
    return rest.unionByName(asked).select("id", F.array_sort(F.concat(*spans)).alias("spans"))


def _long_run(rule: Rule) -> Column:
    """A quick test that a text can have a span of a rule that is one class repeated; true for other rules."""
    plain = rule.group == 0 and rule.pattern.startswith("[") and rule.pattern.endswith("]+") and rule.pattern.count("]") == 1
    return F.col("text").rlike(f"{rule.pattern[:-1]}{{{rule.least}}}") if plain else F.lit(True)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["nth"] < len(BASE))

    def count(nth: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["nth"] == nth)).cast("long")

    return found.select("id", *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def oracle_sql() -> str:
    """The same report as DuckDB SQL: every rule on every text."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    parts = [f"""
  SELECT row, {k} AS nth, {quoted(r.kind)} AS kind, unnest(regexp_extract_all(text, {quoted(r.pattern)}, 0)) AS m,
         unnest(regexp_extract_all(text, {quoted(r.pattern)}, {r.group})) AS g,
         unnest(regexp_split_to_array(text, {quoted(r.pattern)})[1:-2]) AS before,
         generate_subscripts(regexp_extract_all(text, {quoted(r.pattern)}, 0), 1) AS i, {r.least} AS least FROM docs"""
             for k, r in enumerate(RULES)]
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT *, sum(length(before) + length(m)) OVER (PARTITION BY row, nth ORDER BY i) AS stop FROM matches),
spans AS (
  SELECT row, nth, stop - length(m) AS start, kind || ':' || CAST(stop - length(m) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
  FROM placed WHERE length(g) >= least),
sums AS (
  SELECT row, count(*) FILTER (nth = 0) AS n0, count(*) FILTER (nth = 1) AS n1, count(*) FILTER (nth = 2) AS n2,
         string_agg(span, ',' ORDER BY start, nth) FILTER (nth < {len(BASE)}) AS base,
         string_agg(span, ',' ORDER BY start, nth) AS every FROM spans GROUP BY row)
SELECT d.doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM docs d LEFT JOIN sums USING (row)"""
