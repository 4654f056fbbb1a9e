"""URL filter with built-in expressions only: host and path rules, then logistic regression on hashed n-grams."""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.names import back, number_of, numbered
from martloom.llm.quality_rules import held, let

# Fixed values: (verdict, host, path) of the rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: The labelled table: names of sites to block and to allow, each in every form.
BLOCKED = ("casino-win", "lucky-casino", "free-bets", "sport-bets", "cheap-pills", "pills-online", "hot-singles", "xxx-cams",
           "porn-tube", "poker-bonus", "slots-jackpot", "payday-loans", "fast-loans", "replica-watches", "free-crypto",
           "crypto-double", "miracle-diet", "adult-dating", "spam-mailer", "click-ads", "popup-banner", "warez-crack", "ads-track", "spam-farm", "adult-x", "best-casino")
ALLOWED = ("thing", "erthon", "blog", "tionder", "city-library", "open-docs", "daily-news", "history-museum", "river-school",
           "stone", "ererea", "garden-club", "music-theory", "public-radio", "weather-station", "sciences", "heinon",
           "county-courts", "encyclopedia", "recipes", "mathematics", "wiki-reader", "ththst", "therhe", "ththble", "ththon")
FORMS = ("www.{}.example.com/en/1204.html", "{}.example.net/de/77/", "m.{}.example.org/fr/9031", "{}.com/es/450")
SIZES, BITS = (3, 4), 12
#: Rounds of descent, its step, the pull towards 0, and the parts of 1 that weights are rounded to (sums are then exact).
ROUNDS, STEP, PULL, PARTS = 400, 0.05, 0.002, 1024


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    bias: float


def grams_of(text: str) -> set[str]:
    return {text[i:i + n] for n in SIZES for i in range(len(text) - n + 1)}


def bucket(gram: str) -> int:
    return int(hashlib.md5(gram.encode()).hexdigest()[:3], 16)


def train(labelled: list[tuple[str, int]]) -> Model:
    """Logistic regression on which buckets a host and path fill; the table is small and its work fixed."""
    x = np.zeros((len(labelled), 1 << BITS))
    for row, (text, _) in enumerate(labelled):
        for gram in grams_of(text):
            x[row, bucket(gram)] += 1
    y = np.array([label for _, label in labelled], float)
    w, b = np.zeros(1 << BITS), 0.0
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-(x @ w + b))) - y
        w -= STEP * (x.T @ error / 4 + PULL * len(y) * w)
        b -= STEP * error.mean()
    return Model(tuple((np.round(w * PARTS) / PARTS).tolist()), float(np.round(b * PARTS) / PARTS))


@functools.lru_cache(maxsize=1)
def default_model() -> Model:
    table = [(f.format(name), label) for label, names in ((1, BLOCKED), (0, ALLOWED)) for name in names for f in FORMS]
    return train(table)


def score(text: Column, model: Model) -> Column:
    """The sum of the weights of a text's different n-grams, above 0 where blocking is likelier."""
    weights = F.array(*[F.lit(w) for w in model.weights])
    n = F.length(text)

    def runs(k: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(text, i, F.lit(k)))
        return F.when(n >= k, cut).otherwise(F.array().cast("array<string>"))

    grams = F.array_distinct(F.concat(*[runs(k) for k in SIZES]))
    at = lambda g: F.conv(F.substring(F.md5(g), 1, 3), 16, 10).cast("int")
    return F.aggregate(grams, F.lit(model.bias), lambda a, g: a + F.get(weights, at(g)))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null. The rules are a short list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, of, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(of + start)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def url_verdicts(pages: DataFrame, url: str = "url", rules=RULES, model: Model | None = None) -> DataFrame:
    """Adds host, path, rule, score and verdict to every row.

    Urls that are null or without ``://`` have an empty host and path, no rule, and the verdict of the model's bias.
    Repeated rows are judged each; columns of these names are replaced, no other name clashes.
    """
    model = model or default_model()
    new = ("host", "path", "rule", "score", "verdict")
    whole = F.coalesce(F.col(number_of(pages, url)), F.lit(""))
    at = F.locate("://", whole)
    rest = F.when(at > 0, F.substr(whole, at + 3)).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    df = held(numbered(pages), host=F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, lower),
              path=F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    df = held(df, rule=name, _said=verdict, score=let(F.concat("host", "path"), lambda t: score(t, model)))
    learned = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return df.select(*back(pages, *new), "host", "path", "rule", "score", F.coalesce("_said", learned).alias("verdict"))
