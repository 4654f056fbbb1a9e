"""License scan with built-in expressions only: phrases, and a set-similarity join of text blocks with templates."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.quality_rules import held, let
from martloom.session import materialise

# What parts words (lower-cased and as it stands), the phrases and their labels.
PARTS, RAW_PARTS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
RAW_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Texts whose words a block must hold, by label.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license"),
    ("cc-by-nc", "licensed under cc by nc 4"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 international license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
)
CONTAINMENT = Fraction(17, 20)
#: Words of a block. Blocks begin at every word of a template, so no match depends on its place in a text.
BLOCK = 64


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def spaced(text: Column) -> Column:
    """The words, lower-cased, with one blank before and after each."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(lowered(text), PARTS, " ")), F.lit(" "))


def words_of(text: Column) -> Column:
    return let(F.btrim(F.regexp_replace(lowered(text), PARTS, " ")),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " ")))


def holds_any(text: Column, words: list[str]) -> Column:
    """Whether some of the words stand in a text, in any case of A-Z."""
    return text.rlike("(?i)(?<![^" + RAW_PARTS[1:-2] + "])(?:" + "|".join(words) + ")(?![^" + RAW_PARTS[1:-2] + "])")


def base_phrases(docs: DataFrame, text: str, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and base (an array of labels): where words of phrases stand in a row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    near = whole.rlike("(?i)" + "|".join(p.replace(" ", RAW_PARTS) for p in phrases))
    starts = "(?<= )(?=(?:" + "|".join(phrases) + ") )"

    def facts(s: Column) -> Column:
        spaces = lambda x: F.length(x) - F.length(F.translate(x, " ", ""))
        labels = F.array(*[F.when(F.contains(s, F.lit(f" {p} ")), F.lit(label)) for p, label in phrases.items()])
        parts = lambda x: F.struct(
            (F.size(x) - 1).cast("long").alias("n"),
            F.when(F.size(x) > 1, spaces(F.get(x, F.lit(0))) - 1).cast("long").alias("first"),
            F.when(F.size(x) > 1, spaces(s) - 1 - spaces(F.get(x, F.size(x) - 1))).cast("long").alias("last"),
            F.array_sort(F.array_distinct(F.filter(labels, lambda v: v.isNotNull()))).alias("labels"))
        return let(F.split(s, starts), parts)

    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"),
                       F.lit(None).cast("long").alias("last"), F.array().cast("array<string>").alias("labels"))
    found = held(docs, n_words=F.regexp_count(whole, F.lit(RAW_WORD)).cast("long"),
                 _base=F.when(near, let(spaced(whole), facts)).otherwise(nothing))
    return found.select("*", F.col("_base.n").alias("n_base"), F.col("_base.first").alias("first_word"),
                        F.col("_base.last").alias("last_word"), F.col("_base.labels").alias("base")).drop("_base")


def token_order(docs: DataFrame, text: str, vocabulary: list[str]) -> list[str]:
    """The templates' words, rarest first, by the number of documents that hold them. Their number is fixed."""
    seen = F.array_intersect(words_of(F.coalesce(F.col(text), F.lit(""))), F.array(*[F.lit(v) for v in vocabulary]))
    counts = {r["w"]: r["count"] for r in docs.select(F.explode(seen).alias("w")).groupBy("w").count().collect()}
    return sorted(vocabulary, key=lambda v: (counts.get(v, 0), v))


def matches(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES,
            containment: Fraction = CONTAINMENT, block: int = BLOCK) -> DataFrame:
    """(key, _h, label, template, start, words, containment): every block of words that holds enough of a template.

    A block is ``block`` words (or what is left of the text) from a word of the template on; a block that begins with
    another word holds no more of it than the one that begins at the next. Blocks and templates are sets of the
    templates' words, in order of how rare these are in the whole corpus. A block that holds a share c of a template of
    t words holds one of its first t - ct + 1, so blocks are sought before and at the places of such words alone: each
    place covers the starts since the place before it. Blocks meet templates at these words, in the block's own
    prefix, if the block has words enough (length) and enough words are left on both sides of the meeting (position).
    What meets is then compared exactly. ``_h`` is a hash of the text.
    """
    sets = [(label, sorted(set(t.split()))) for label, t in templates]
    order = token_order(docs, text, sorted({w for _, s in sets for w in s}))
    number = {w: i for i, w in enumerate(order)}
    index, rarest = [], set()
    for i, (label, words) in enumerate(sets):
        ordered = sorted(number[w] for w in words)
        need = -(-containment.numerator * len(ordered) // containment.denominator)
        for place, token in enumerate(ordered[:len(ordered) - need + 1]):
            index.append((token, i, label, place, len(ordered), need, ordered))
            rarest.add(order[token])
    least = min(x[5] for x in index)
    spark = docs.sparkSession
    table = spark.createDataFrame(index, "token int, template int, label string, place int, size int, need int, tokens array<int>")
    whole = F.coalesce(F.col(text), F.lit(""))
    near = docs.filter(holds_any(whole, sorted(rarest)))
    known = F.array(*[F.lit(w) for w in order])
    near = held(near.select(key, F.xxhash64(text).alias("_h"), whole.alias("_text")), _words=words_of(F.col("_text")))
    first = F.array(*[F.lit(w) for w in sorted(rarest)])
    places = F.filter(F.transform("_words", lambda w, i: F.when(F.array_contains(first, w), i)), lambda i: i.isNotNull())
    near = held(near.select(key, "_h", "_words"), _places=places)
    spans = F.transform("_places", lambda p, k: F.struct(
        F.greatest(p - block + 1, F.coalesce(F.get("_places", k - 1) + 1, F.lit(0))).alias("low"), p.alias("high")))
    spans = near.select(key, "_h", F.size("_words").alias("_all"), "_words", F.inline(spans))
    number_at = F.transform(F.slice("_words", F.col("low") + 1, F.col("high") - F.col("low") + block), lambda w, i: F.struct(
        (F.col("low") + i).alias("i"), (F.array_position(known, w).cast("int") - 1).alias("t")))
    spans = held(spans, _at=F.filter(number_at, lambda x: x["t"] >= 0)).filter(F.size("_at") >= least)
    begun = F.filter("_at", lambda x: x["i"] <= F.col("high"))
    blocks = spans.select(key, "_h", "_all", "_at", F.inline(begun).alias("start", "_begin"))
    inside = F.filter("_at", lambda x: (x["i"] >= F.col("start")) & (x["i"] < F.col("start") + block))
    own = F.array_sort(F.array_distinct(F.transform(inside, lambda x: x["t"])))
    blocks = held(blocks, _own=own).filter(F.size("_own") >= least)
    blocks = blocks.select(key, "_h", "start", F.least(F.lit(block), F.col("_all") - F.col("start")).alias("words"), "_own", "_begin",
                           F.posexplode(F.slice("_own", 1, F.size("_own") - least + 1)).alias("at", "token"))
    left = 1 + F.least(F.col("size") - F.col("place"), F.size("_own") - F.col("at")) - 1
    met = blocks.join(F.broadcast(table), "token").filter(
        (F.size("_own") >= F.col("need")) & (left >= F.col("need")) & F.array_contains("tokens", F.col("_begin")))
    common = F.size(F.array_intersect("_own", "tokens"))
    met = met.filter(common >= F.col("need")).select(
        key, "_h", "label", "template", "start", "words", (common / F.col("size")).alias("containment"))
    return met.distinct()


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    base_labels are those of the phrases; labels adds those of the blocks; score is 1 with a phrase, else the largest
    containment found, else 0. Null texts are empty, without labels; repeated rows each get their row, also with a null
    key; columns of ``docs`` other than key and text are ignored. Documents are joined by key and a hash of the text.
    """
    found = materialise(matches(docs, key, text), "blocks")
    found = found.groupBy(F.col(key).alias("_key"), "_h").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    base = base_phrases(docs.select(key, text), text).select(
        key, "n_words", "n_base", "first_word", "last_word", "base", F.xxhash64(text).alias("_hash"))
    joined = base.join(found, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_h")), "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    labels = F.array_sort(F.array_distinct(F.concat("base", more)))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0)))
    return joined.select(key, "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                         F.array_join(labels, ",").alias("labels"), score.alias("score"))
