"""License scans by diagonal voting, in DataFrame functions only.

Every rolling pair of words of every text is hashed and joined to the places of that pair in the templates. A hit
votes for its diagonal, place in the text minus place in the template; diagonals a few words apart
are merged (an inserted or lost word moves the rest of a match to a neighbour), and a merged span is verified by the
distinct template places it covers and by its length. Phrases of up to eight words must be met word for
word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Phrases that the base labels stand for.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further phrases and well-known passages of public licences, in the words of a scan.
TEMPLATES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-text",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is-text",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-text",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice": "isc-text",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file": "mpl-text",
    "this is free and unencumbered software released into the public domain": "unlicense-text",
}
#: What stands between words; a text is cut there after A-Z are in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases up to so many words count only word for word; of longer templates this share of the word pairs, on diagonals with votes.
EXACT_WORDS, SHARE, VOTES, REACH = 8, 0.8, 3, 3


def template_rows() -> list[tuple]:
    """(template, label, base, pairs, place, word, next word) of every word pair of every template; at most 62 pairs each."""
    rows = []
    for t, (phrase, label) in enumerate((BASE | TEMPLATES).items()):
        words = phrase.split()
        assert 2 <= len(words) <= 63
        rows += [(t, label, phrase in BASE, len(words) - 1, i, a, b) for i, (a, b) in enumerate(zip(words, words[1:]))]
    return rows


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row, key, n_words, label, base, first_word, last_word, share: every verified span, and for every row one more line with a null label.

    The template table is a constant of a few hundred rows and is broadcast; texts are read once and only votes are shuffled,
    pre-aggregated by diagonal. A null or empty text has no words and no spans; repeated rows and null keys are told
    apart by row number; other columns are left out.
    """
    table = docs.sparkSession.sql(f"SELECT *, xxhash64(t0, t1) AS h FROM VALUES (-1, '', false, 1, 0, '', ''), {_values()} AS x(t, label, base, pairs, place, t0, t1)")
    table = F.broadcast(table)
    body = F.coalesce(F.col(text), F.lit(""))
    plain = F.when(F.octet_length(body) == F.length(body), F.lower(body)).otherwise(F.translate(body, UPPER, LOWER))
    # two empty words in front are the one pair that every text has; it carries the text's own row through the join
    words = F.concat(F.array(F.lit(""), F.lit("")), F.array_remove(F.split(plain, GAP), ""))
    pairs = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), words.alias("words")).select("key", "row", "words", F.posexplode("words").alias("at", "w0"))
    pairs = pairs.select("key", "row", (F.size("words") - 2).alias("n_words"), "at", "w0", F.get("words", F.col("at") + 1).alias("w1"))
    hits = pairs.withColumn("h", F.xxhash64("w0", "w1")).join(table, "h")
    hits = hits.filter(F.contains("w0", "t0") & F.contains("t0", "w0") & F.contains("w1", "t1") & F.contains("t1", "w1"))
    same = [F.max(c).alias(c) for c in ("key", "n_words", "label", "base", "pairs")]
    votes = hits.groupBy("row", "t", (F.col("at") - F.col("place")).alias("diagonal")).agg(*same, F.count("*").alias("votes"), F.bit_or(F.expr("shiftleft(1L, place)")).alias("places"), (F.min("at") - 2).alias("lo"), (F.max("at") - 1).alias("hi"))
    own, whole = F.col("t") < 0, F.col("pairs") < EXACT_WORDS
    strong = votes.filter(own | F.when(whole, F.col("votes") == F.col("pairs")).otherwise(F.col("votes") >= VOTES))
    line = Window.partitionBy("row", "t").orderBy("diagonal")
    apart = F.coalesce((whole | (F.col("diagonal") - F.lag("diagonal").over(line) > REACH)).cast("int"), F.lit(1))
    merged = strong.withColumn("new", apart).withColumn("island", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    spans = merged.groupBy("row", "t", "island").agg(*same, F.bit_or("places").alias("places"), F.min("lo").alias("first_word"), F.max("hi").alias("last_word"))
    spans = spans.withColumn("share", F.bit_count("places") / F.col("pairs"))
    spans = spans.filter(own | ((F.col("share") >= SHARE) & (F.col("last_word") - F.col("first_word") < 2 * (F.col("pairs") + 1))))
    return spans.select("row", "key", "n_words", F.when(~own, F.col("label")).alias("label"), "base", *(F.when(~own, F.col(c)).alias(c) for c in ("first_word", "last_word", "share")))


def license_labels(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    n_base: places of the base phrases; first_word and last_word: smallest and largest start of one (null without); labels
    are distinct, sorted, comma-joined ('' without); score: the largest verified share, 0 without a span.
    """
    of = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")  # noqa: E731  a handful of labels per row
    start = F.when(F.col("base"), F.col("first_word")).cast("long")
    out = scan(docs, key, text).groupBy("row").agg(
        F.max("key").alias(key), F.max("n_words").cast("long").alias("n_words"), F.count_if("base").alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        of(F.when(F.col("base"), F.col("label"))).alias("base_labels"), of(F.col("label")).alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"))
    return out.drop("row")


def _values() -> str:
    quoted = lambda x: f"'{x}'" if isinstance(x, str) else str(x).lower()
    return ", ".join(f"({', '.join(map(quoted, r))})" for r in template_rows())


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT rid, unnest(range(0, greatest(len(w) - 1, 0))) AS pos, w FROM d),
t(t, label, base, pairs, place, t0, t1) AS (VALUES {_values()}),
v AS (SELECT rid, t, pos - place AS diagonal, max(label) AS label, bool_or(base) AS base, max(pairs) AS pairs, count(*) AS votes, bit_or(1::BIGINT << place) AS places, min(pos) AS lo, max(pos) + 1 AS hi
  FROM g JOIN t ON w[pos + 1] = t0 AND w[pos + 2] = t1 GROUP BY 1, 2, 3),
s AS (SELECT *, CASE WHEN pairs < {EXACT_WORDS} OR diagonal - lag(diagonal) OVER l > {REACH} OR lag(diagonal) OVER l IS NULL THEN 1 ELSE 0 END AS new FROM v
  WHERE CASE WHEN pairs < {EXACT_WORDS} THEN votes = pairs ELSE votes >= {VOTES} END WINDOW l AS (PARTITION BY rid, t ORDER BY diagonal)),
m AS (SELECT *, sum(new) OVER (PARTITION BY rid, t ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS island FROM s),
x AS (SELECT rid, t, island, max(label) AS label, bool_or(base) AS base, max(pairs) AS pairs, bit_count(bit_or(places)) / max(pairs)::DOUBLE AS share, min(lo) AS lo, max(hi) AS hi FROM m GROUP BY 1, 2, 3),
f AS (SELECT rid, count(*) FILTER (base) AS n_base, min(lo) FILTER (base) AS first_word, max(lo) FILTER (base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM x WHERE share >= {SHARE} AND hi - lo < 2 * (pairs + 1) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN f USING (rid)
"""
