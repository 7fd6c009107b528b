"""License scan: base phrases, and an exact set-similarity join of text blocks with license templates.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased. A block is a line, or, as notices
are wrapped over lines, as many consecutive words of the whole text as the template has. A
template matches a block if at least 80 % of the template's distinct words are among the block's.

The join is exact. Template words are ordered by their frequency in the corpus, rarest first. With
`need` words required out of n, a match must share one of the first n - need + 1 words (prefix
filter), so a text without any such word is settled by one hash probe for each of its words. Of the
others, each line's known words, in the same order, must be `need` at least (length filter), and
from the first shared word on both sides must still hold `need` words (positional filter); what
is left is intersected. Words across lines are looked at only for templates of which the whole text
has `need` words, from each place of a template word on. All of it happens in the row, by DataFrame functions: the templates are
a fixed list, so nothing is shuffled but the frequency counts of its words (one row a word).

Defined results: null is the empty text, with 0 words and no labels; a repeated row gives a
repeated result; equal scores are reported as one; very long texts are whole; an empty table gives no rows; further columns are kept, but
those with the name of an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.session import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAINMENT = 0.8

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Template sentences of public licenses, by label.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3 0"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
]


def _lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _words_of(line: Column) -> Column:
    """The distinct words of a line; '' may be among them."""
    return F.array_distinct(F.split(line, SEPARATORS))


def templates() -> list[dict]:
    found = []
    for label, text in TEMPLATES:
        words = sorted(set(text.split()))
        need = -(-int(CONTAINMENT * 100) * len(words) // 100)
        found.append({"label": label, "words": words, "need": need, "length": len(text.split())})
    return found


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_order(df: DataFrame, text: str) -> list[str]:
    """The templates' words by the number of texts that have them, rarest first.

    One row for each known word leaves a task; the list is as long as the fixed templates."""
    known = sorted({w for t in templates() for w in t["words"]})
    held = F.array_intersect(F.split(_lowered(F.col(text)), SEPARATORS), _array(known))
    counts = {r["word"]: r["n"] for r in df.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(known, key=lambda w: (counts.get(w, 0), w))


def scan(df: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """df with n_words, n_base, first_word, last_word, base_labels, labels, score."""
    order = order if order is not None else word_order(df, text)
    low_, norm_, list_, hits_, wide_, base_ = private(df, "low", "norm", "list", "hits", "wide", "base")
    rank = {w: i for i, w in enumerate(order)}
    rules, lengths, prefixes = [], [], set()
    for t in templates():
        words = sorted(t["words"], key=rank.__getitem__)
        prefix = words[: len(words) - t["need"] + 1]
        prefixes.update(prefix)
        rules.append((t["label"], words, prefix, t["need"]))
        lengths.append(t["length"])
    ordered = _array(order)

    def containment(line: Column) -> Column:
        """(label, score) of the templates that a line contains, or nulls."""
        held = F.array_intersect(ordered, _words_of(line))  # the line's known words, rarest first

        def one(held: Column, label: str, words: list[str], prefix: list[str], need: int) -> Column:
            first = F.get(F.array_intersect(held, _array(prefix)), 0)
            left = F.size(held) - F.array_position(held, first) + 1
            shared = F.size(F.array_intersect(held, _array(words)))
            remaining = F.lit(len(words)) - F.array_position(_array(words), first) + 1
            passes = (F.size(held) >= need) & first.isNotNull() & (F.least(left, remaining) >= need)
            return F.when(passes & (shared >= need), F.struct(F.lit(label).alias("label"), (shared / F.lit(float(len(words)))).alias("score")))

        return F.flatten(F.transform(F.array(held), lambda h: F.array_compact(F.array(*[one(h, *r) for r in rules]))))

    def wrapped(every: Column) -> Column:
        """(label, score) of the templates that consecutive words of a text contain."""

        def one(held: Column, label: str, words: list[str], prefix: list[str], need: int, length: int) -> Column:
            own = _array(words)
            may = (F.size(F.array_intersect(held, own)) >= need) & F.arrays_overlap(held, _array(prefix))
            starts = F.filter(F.sequence(F.lit(1), F.size(every)), lambda i: F.array_contains(own, F.element_at(every, i)))
            shared = F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(own, F.slice(every, i, length)))))
            return F.when(may, F.struct(F.lit(label).alias("label"), (shared / F.lit(float(len(words)))).alias("score")))

        held = F.array(F.array_intersect(ordered, every))
        found = F.flatten(F.transform(held, lambda h: F.array_compact(F.array(*[one(h, *r, n) for r, n in zip(rules, lengths)]))))
        return F.filter(found, lambda h: h["score"] >= CONTAINMENT - 1e-9)

    base = df.withColumn(low_, _lowered(F.col(text)))
    base = base.withColumn(norm_, F.trim(F.regexp_replace(low_, SEPARATORS, " ")))
    base = base.withColumn(list_, F.when(F.col(norm_) == "", F.array().cast("array<string>")).otherwise(F.split(norm_, " ")))
    base = base.withColumn("n_words", F.size(list_).cast("long"))
    may = F.arrays_overlap(F.col(list_), _array(sorted(prefixes)))
    none = F.array().cast("array<struct<label:string,score:double>>")
    base = base.withColumn(hits_, F.when(may, F.flatten(F.transform(F.split(low_, "\n"), containment))).otherwise(none))
    across = F.when(may & F.contains(F.col(low_), F.lit("\n")), wrapped(F.col(list_))).otherwise(none)
    base = base.withColumn(hits_, F.concat(hits_, across))
    # each word between two spaces of its own, so that neighbouring places do not share one
    any_phrase = F.lit(False)
    for p in PHRASES:
        any_phrase = any_phrase | F.contains(F.col(norm_), F.lit(p))
    base = base.withColumn(wide_, F.when(any_phrase, F.concat(F.lit(" "), F.replace(F.col(norm_), F.lit(" "), F.lit("  ")), F.lit(" "))).otherwise(""))
    counts, firsts, lasts, labels = [], [], [], []
    for p, label in PHRASES.items():
        wide = f" {p.replace(' ', '  ')} "
        n = (F.length(wide_) - F.length(F.replace(F.col(wide_), F.lit(wide), F.lit("")))) / F.lit(len(wide))
        before = F.substring_index(F.col(wide_), wide, 1)
        after = F.substring_index(F.col(wide_), wide, -1)
        def words(c): return (F.length(c) - F.length(F.replace(c, F.lit("  "), F.lit(" ")))) + F.when(F.length(c) > 0, 1).otherwise(0)
        found = n > 0
        counts.append(n.cast("long"))
        firsts.append(F.when(found, words(before)))
        lasts.append(F.when(found, F.col("n_words") - words(after) - len(p.split())))
        labels.append(F.when(found, F.lit(label)))
    some = F.col(wide_) != ""
    base = base.withColumns(
        {
            "n_base": F.when(some, sum(counts[1:], counts[0])).otherwise(0).cast("long"),
            "first_word": F.when(some, F.least(*firsts)).cast("long"),
            "last_word": F.when(some, F.greatest(*lasts)).cast("long"),
            base_: F.when(some, F.array_compact(F.array(*labels))).otherwise(F.array().cast("array<string>")),
        }
    )
    scores = F.transform(hits_, lambda h: h["score"])
    return base.withColumns(
        {
            "base_labels": F.array_join(F.array_sort(base_), ","),
            "labels": F.array_join(F.array_sort(F.array_union(base_, F.transform(hits_, lambda h: h["label"]))), ","),
            "score": F.when(F.size(base_) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(scores), F.lit(0.0))),
        }
    ).drop(low_, norm_, list_, hits_, wide_, base_)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def _oracle() -> str:
    sep = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    rules = ",\n  ".join("('%s', [%s], %d, %d)" % (t["label"], ", ".join(f"'{w}'" for w in t["words"]), t["need"], t["length"]) for t in templates())
    phrases = ",\n  ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
    return f"""
WITH rules(label, words, need, length) AS (VALUES
  {rules}),
phrases(phrase, label) AS (VALUES
  {phrases}),
d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
w AS (SELECT doc_id, low, list_filter(regexp_split_to_array(low, '{sep}'), lambda x: x <> '') AS ws FROM d),
places AS (
  SELECT doc_id, p.label, i FROM (SELECT doc_id, ws, unnest(range(0, len(ws))) AS i FROM w), phrases p
  WHERE array_to_string(ws[i + 1 : i + len(string_split(p.phrase, ' '))], ' ') = p.phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
lines AS (SELECT doc_id, list_distinct(regexp_split_to_array(line, '{sep}')) AS ws FROM (SELECT doc_id, unnest(string_split(low, chr(10))) AS line FROM d)),
starts AS (SELECT doc_id, ws, label, words, need, length, unnest(range(0, len(ws))) AS i FROM w, rules
           WHERE contains(low, chr(10)) AND len(list_intersect(list_distinct(ws), words)) >= need),
across AS (SELECT doc_id, label, need, words, max(len(list_intersect(list_distinct(ws[i + 1 : i + length]), words))) AS n
           FROM starts WHERE list_contains(words, ws[i + 1]) GROUP BY doc_id, label, need, words),
hits AS (SELECT doc_id, label, len(list_intersect(ws, words)) / len(words) AS score FROM lines, rules WHERE len(list_intersect(ws, words)) >= need
         UNION ALL SELECT doc_id, label, n / len(words) FROM across WHERE n >= need),
named AS (SELECT doc_id, label FROM hits UNION SELECT doc_id, label FROM places),
joined AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM named GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN joined USING (doc_id)
LEFT JOIN (SELECT doc_id, max(score) AS best FROM hits GROUP BY doc_id) USING (doc_id)
"""


ORACLE_SQL = _oracle()
