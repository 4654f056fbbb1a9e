"""Line-first cleaning with built-in expressions only: lines that fail a rule go, then documents that lose too much."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.names import back, number_of, numbered

# The characters that part words, the characters that count as symbols.
BLANKS, BLANK_CLASS = " \t\n\x0b\x0c\r", "[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Line rules. Navigation and markup: symbols to characters. Punctuation: exclamation marks to words, from three on.
SYMBOL_SHARE, MARK_SHARE, LEAST_MARKS = 0.08, 0.5, 3
#: Repetition, in lines of some words: different words to words, and words that repeat the one before.
REPEAT_WORDS, DIFFERENT_SHARE, AGAIN_SHARE = 8, 0.35, 0.3
#: Boilerplate: a phrase in a line of few words.
BOILERPLATE_WORDS = 25
BOILERPLATE = ("cookie", "javascript", "all rights reserved", "privacy policy", "terms of use", "terms of service",
               "subscribe", "click here", "sign up", "log in", "lorem ipsum")
#: Share of its characters that a document may lose with its lines.
MOST_LOST = 0.5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held(df: DataFrame, **values: Column) -> DataFrame:
    """Adds columns that are computed once, however often they are used after."""
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    return df.select("*", F.inline(F.array(row)))


def words_of(text: Column) -> Column:
    return let(F.btrim(text, F.lit(BLANKS)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_CLASS + "+")))


def counted(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def window_hashes(words: Column) -> Column:
    return F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))


def covered(words: Column) -> Column:
    """Words in windows that stand in the text twice or more: windows in order, equal neighbours, places, their union."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.struct(
        F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)]).alias("w"), i.alias("i")))

    def places(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["w"] == x["w"], F.lit(False))
        twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def union(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(let(F.sort_array(windows), places), union)


def line_facts(line: Column) -> Column:
    def facts(w: Column) -> Column:
        def more(joined: Column) -> Column:
            return F.struct(
                line.alias("line"), F.size(w).alias("words"), F.length(joined).alias("chars"),
                counted(joined, SYMBOLS).alias("symbols"), counted(joined, "!").alias("marks"),
                F.size(F.array_distinct(w)).alias("different"),
                F.size(F.filter(w, lambda x, k: F.coalesce(F.get(w, k - 1) == x, F.lit(False)))).alias("again"))

        return let(F.concat_ws("", w), more)

    return let(words_of(line), facts)


def fails(f: Column) -> Column:
    """Whether a line goes, from its facts."""
    markup = f["symbols"] >= SYMBOL_SHARE * f["chars"]
    shouting = (f["marks"] >= LEAST_MARKS) & (f["marks"] >= MARK_SHARE * f["words"])
    repeating = (f["words"] >= REPEAT_WORDS) & ((f["different"] < DIFFERENT_SHARE * f["words"])
                                                | (f["again"] >= AGAIN_SHARE * f["words"]))
    boilerplate = (f["words"] <= BOILERPLATE_WORDS) & f["line"].rlike("(?i)" + "|".join(BOILERPLATE))
    return (f["words"] > 0) & (markup | shouting | repeating | boilerplate)


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds to every document n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost (the share
    of word characters in failing lines), kept, and clean_text (the lines that stay).

    Null texts are empty; empty texts have too few words and are not kept; repeated rows are judged each. Columns of
    these names are replaced; no other name clashes. All work is within a row, so no shuffle and no key is involved.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost", "kept", "clean_text"]
    whole = F.coalesce(F.col(number_of(docs, text)), F.lit(""))
    df = held(numbered(docs), _words=words_of(whole), _lines=F.split(whole, "\n"))
    df = held(df, _windows=window_hashes(F.col("_words")), _facts=F.transform("_lines", line_facts))
    full = F.filter("_facts", lambda f: f["words"] > 0)
    repeat = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), covered(F.col("_words"))).otherwise(F.lit(0))
    chars = lambda facts: F.aggregate(facts, F.lit(0), lambda a, f: a + f["chars"])
    total = lambda name: F.aggregate("_facts", F.lit(0), lambda a, f: a + f[name])
    lines = F.transform(full, lambda f: f["line"])
    df = held(
        df, n_words=F.size("_words").cast("long"), word_chars=total("chars").cast("long"),
        n_symbols=total("symbols").cast("long"),
        n_dup_lines=let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        n_repeat_words=repeat.cast("long"), _lost=chars(F.filter("_facts", fails)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    lost = F.when(F.col("word_chars") > 0, F.col("_lost") / F.col("word_chars")).otherwise(F.lit(0.0))
    clean = F.array_join(F.transform(F.filter("_facts", lambda f: ~fails(f)), lambda f: f["line"]), "\n")
    return df.select(*back(docs, *new), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"), lost.alias("lost"),
                     (~failed & (lost <= MOST_LOST)).alias("kept"), clean.alias("clean_text"))
