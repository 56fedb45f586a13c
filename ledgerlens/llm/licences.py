"""Licence scan with a positional rare-token index, in DataFrame operations alone.

Index: every template (a notice as licences print it) keeps postings
``(word, template, position, weight)`` of its rarest words and of its mandatory key
phrase. A word's weight is its inverse document frequency among the templates, as
a whole number of thousandths, so scores are exact.

Scan of a file:

1. its words that occur in the index, all of them;
2. each place of such a word meets the word's postings; ``place - position`` is
   where the template would have to start;
3. per file, template and start the weights add up; a template is found where
   every word of its key phrase stands at its position and the matched share of
   its rare weight (the score) is at least ``LEAST_SCORE``.

Only files with a word stem of some key phrase are split into words (``STEMS``; no
phrase can stand without one, so nothing is lost); word counts cover all files. A
file's rows of step 2 are grouped by file, template and start: linear in its
length, aggregated map-side, no array of votes per file. The index is broadcast;
its size is fixed.

Edge cases: null text is empty: no words, no labels; a file without words has
first and last place null and labels ''; rows are scanned one by one, so repeated
or null ids keep their rows apart; an empty table gives an empty result; only the
id and the text are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import fixed_rows, sql_literal, whole_text

# Word characters after A-Z are lower-cased; the same before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Phrases that carry a label wherever they stand.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Label, words of the notice, mandatory key phrase.
TEMPLATES = [
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files", "permission is hereby granted free of charge"),
    ("apache-notice", "licensed under the apache license version 2 0", "under the apache license version 2 0"),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3",
     "under the gnu general public license"),
    ("gpl-grant", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", "redistribute it and or modify it under the terms"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "licensed under cc by nc"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
]
STEMS = "(?i)licens|permission|redistribut"
TEMPLATE_WORDS, LEAST_SCORE = 10, 0.6


def index() -> list[tuple[str, str, int, int, int]]:
    """Postings ``(word, label, position, weight, key)``: weight 0 for words that are only in the key phrase."""
    words = {label: text.split() for label, text, _ in TEMPLATES}
    seen = {w: sum(w in t for t in words.values()) for t in words.values() for w in t}
    weight = {w: 1 + round(1000 * math.log(len(words) / n)) for w, n in seen.items()}
    rows = []
    for label, text, phrase in TEMPLATES:
        own, key = words[label], phrase.split()
        start = next(i for i in range(len(own)) if own[i:i + len(key)] == key)
        rare = sorted(range(len(own)), key=lambda i: (-weight[own[i]], i))[:TEMPLATE_WORDS]
        for i, w in enumerate(own):
            is_key = start <= i < start + len(key)
            if is_key or i in rare:
                rows.append((w, label, i, weight[w] if i in rare else 0, int(is_key)))
    return rows


def vocabulary() -> list[tuple[str, int]]:
    """Indexed words with their largest weight."""
    best: dict[str, int] = {}
    for w, _, _, weight, _ in index():
        best[w] = max(best.get(w, 0), weight)
    return sorted(best.items())


def totals() -> dict[str, tuple[int, int]]:
    """Per label: rare weight and words of the key phrase."""
    out: dict[str, tuple[int, int]] = {}
    for _, label, _, weight, key in index():
        w, k = out.get(label, (0, 0))
        out[label] = (w + weight, k + key)
    return out


def _spaces(c: Column) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))).cast("long")


def _base(words: Column, n_words: Column) -> dict[str, Column]:
    """Base columns of ``words``, a file's words with one space before, between and after them."""
    counts, first, last, labels = [], [], [], []
    for phrase, label in BASE.items():
        spaced = F.lit(f" {phrase} ")
        at, back = F.instr(words, spaced), F.instr(F.reverse(words), F.reverse(spaced))
        there = at > 0
        counts.append(F.regexp_count(words, F.lit(f" {phrase}(?= )")))
        first.append(F.when(there, _spaces(F.substring(words, F.lit(1), at - 1))))
        after = _spaces(F.substring(F.reverse(words), F.lit(1), back - 1))
        last.append(F.when(there, n_words - after - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    return {"n_base": reduce(lambda a, b: a + b, counts).cast("long"), "first_word": F.least(*first).cast("long"),
            "last_word": F.greatest(*last).cast("long"),
            "base": F.sort_array(F.array_compact(F.array(*labels)))}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, n_words, n_base, first_word, last_word, base, labels, score, starts``.

    ``base`` and ``labels`` are sorted arrays; ``starts`` has the word at which
    each template was found (label, start, score), best ones first.
    """
    spark = docs.sparkSession
    text = whole_text(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn(
        "n_words", F.regexp_count("text", F.lit(WORD_ANY_CASE)).cast("long"))
    none = F.array().cast("array<string>")
    found_type = "array<struct<score:double, label:string, start:long>>"
    plain = rows.filter(~F.col("text").rlike(STEMS)).select(
        "id", "n_words", F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"), none.alias("base"), F.array().cast(found_type).alias("starts"))

    vocab = [w for w, _ in vocabulary()]
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    files = rows.filter(F.col("text").rlike(STEMS)).select("id", "n_words", words.alias("words"))
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    files = files.withColumn("spaced", spaced)
    for name, c in _base(F.col("spaced"), F.col("n_words")).items():
        files = files.withColumn(name, c)
    own = ["file", "id", "n_words", "n_base", "first_word", "last_word", "base"]
    files = files.withColumn("file", F.monotonically_increasing_id())
    places = files.select(*own, F.posexplode_outer("words").alias("place", "word")).filter(
        F.col("place").isNull() | (F.col("place") == 0) | F.col("word").isin(vocab))
    postings = fixed_rows(spark, index(), "word string, label string, position int, weight int, key int")
    votes = places.select(*own, "place", "word").join(F.broadcast(postings), "word", "left")
    sums = votes.groupBy(*own, "label", (F.col("place") - F.col("position")).cast("long").alias("start")).agg(
        F.sum("weight").alias("got"), F.sum("key").alias("key"))
    of = totals()
    whole = F.expr(sql_literal({label: w for label, (w, _) in of.items()}))[F.col("label")]
    need = F.expr(sql_literal({label: k for label, (_, k) in of.items()}))[F.col("label")]
    score = F.col("got") / whole
    hit = F.when((F.col("key") == need) & (score >= LEAST_SCORE), F.struct(score.alias("score"), F.col("label"), F.col("start")))
    found = sums.groupBy(*own).agg(F.collect_list(hit).cast(found_type).alias("starts")).drop("file")
    both = plain.unionByName(found).withColumn("starts", F.sort_array("starts", asc=False))
    labels = F.array_sort(F.array_union("base", F.transform("starts", lambda x: x["label"])))
    top = F.coalesce(F.get("starts", F.lit(0))["score"], F.lit(0.0))
    return both.select("id", "n_words", "n_base", "first_word", "last_word", "base", labels.alias("labels"),
                       top.cast("double").alias("score"), "starts")


def oracle_sql() -> str:
    """The same scan as DuckDB SQL over documents with unique ids."""
    def values(rows):
        return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)

    phrases = values([(p, label, len(p.split())) for p, label in BASE.items()])
    return f"""
WITH postings(word, label, position, weight, is_key) AS (VALUES {values(index())}),
phrases(phrase, label, n) AS (VALUES {phrases}),
whole AS (SELECT label, sum(weight) AS weight, sum(is_key) AS keys FROM postings GROUP BY label),
files AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
places AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM files),
base AS (
  SELECT f.doc_id, count(*) AS n, min(p.place) AS lo, max(p.place) AS hi, list_sort(list(DISTINCT q.label)) AS labels
  FROM files f JOIN places p USING (doc_id) JOIN phrases q
    ON p.word = split_part(q.phrase, ' ', 1)
   AND array_to_string(list_slice(f.words, p.place + 1, p.place + q.n), ' ') = q.phrase
  GROUP BY f.doc_id),
sums AS (
  SELECT p.doc_id, q.label, p.place - q.position AS start, sum(q.weight) AS got, sum(q.is_key) AS keys
  FROM places p JOIN postings q ON q.word = p.word GROUP BY ALL),
found AS (
  SELECT s.doc_id, list(s.label) AS labels, max(s.got / w.weight) AS score
  FROM sums s JOIN whole w USING (label)
  WHERE s.keys = w.keys AND s.got / w.weight >= {LEAST_SCORE} GROUP BY s.doc_id)
SELECT f.doc_id, CAST(len(f.words) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(x.labels, [])))), ','), '') AS labels,
       CAST(coalesce(x.score, 0) AS DOUBLE) AS score
FROM files f LEFT JOIN base b USING (doc_id) LEFT JOIN found x USING (doc_id)"""
