import math
import random
import re

import numpy as np
import pytest
from plain import LOWER, WORD, documents, repeated_words
from pyspark.sql import functions as F

from martloom.llm import catalog, licenses, mixing, quality_rules, topk_search, toxicity, url_filters
from martloom.llm.ranks import digest, ranked

LICENSE_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


# Mixing


def test_mix_comes_near_targets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 200), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    plan = rows_of(mixing.mix(documents(spark, rows)))
    per = {}
    for r in plan:
        assert 0 <= r["copies"] <= 3 and r["size"] == len(WORD.findall(rows[r["doc_id"]][1]))
        s = per.setdefault(r["source"], [0, r["target"], r["source_size"], 0])
        s[0] += r["copies"] * r["size"]
        s[3] += r["size"]
    total = sum(s[3] for s in per.values())
    weights = {n: (5, 2, 1)[i % 3] for i, n in enumerate(sorted(per))}
    open_, left = set(per), total
    while True:
        share = {n: left * weights[n] / sum(weights[m] for m in open_) for n in open_}
        full = {n for n in open_ if share[n] > 3 * per[n][2]}
        if not full:
            break
        left -= sum(3 * per[n][2] for n in full)
        open_ -= full
    for n, (taken, target, size, real) in per.items():
        assert size == real
        assert target == pytest.approx(share[n] if n in open_ else 3 * size)
        assert abs(taken - target) <= 600
    assert sorted(map(str, plan)) == sorted(map(str, rows_of(mixing.mix(documents(spark, rows[::-1])))))


def test_mixed_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, "d " * 50, None), (None, None, "x"), (3, "", "y"), (1, "other text", "x")]
    docs = documents(spark, rows)
    plan = mixing.mix(docs)
    want = sorted(str(d["doc_id"]) + str(d["source"]) for d in rows_of(plan) for _ in range(d["copies"]))
    out = mixing.mixed(docs, plan)
    assert out.columns == docs.columns
    assert sorted(str(d["doc_id"]) + str(d["source"]) for d in rows_of(out)) == want
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0), mixing.mix(docs.limit(0))).count() == 0


CLASH = ("_a", "_b", "_c0", "_words", "_lines", "_facts", "_said", "_copies", "_time", "_n", "copies", "rank", "a.b", "lost", "Turn")


def clashing(docs):
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def test_mix_with_clashing_names(spark):
    docs = documents(spark, [(i % 7, f"w{i % 3} " * (i % 11), "x" if i % 3 else None) for i in range(90)])
    wide = clashing(docs)
    plan, out = mixing.mix(wide), mixing.mixed(wide, mixing.mix(wide))
    assert sum(r["copies"] for r in plan.collect()) == out.count() and out.columns == wide.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in wide.collect()}


def test_many_copies_of_one_row_come_from_one_row(spark):
    docs = documents(spark, [(None, "a b", "x")] * 3000 + [(1, "c", "y")] * 4)
    plan = mixing.mix(docs)
    want = {r["source"]: r["n"] for r in plan.groupBy("source").agg(F.sum("copies").alias("n")).collect()}
    got = {r["source"]: r["count"] for r in mixing.mixed(docs, plan).groupBy("source").count().collect()}
    assert got == {k: n for k, n in want.items() if n} and want["x"] > mixing.TOGETHER


def test_ranked_numbers_each_key(spark):
    frame = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN NULL ELSE string(id % 5) END AS k")
    seen = {}
    for r in ranked(frame, ["k"], ["id"], 2000).collect():
        seen.setdefault(r["k"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in seen.values()) and sum(map(len, seen.values())) == 2000


def test_null_first_ties_are_dealt_over_slices(spark):
    frame = spark.range(2000).selectExpr("'k' AS k", "CAST(NULL AS long) AS id", "id AS other")
    assert sorted(r["rank"] for r in ranked(frame, ["k"], ["id", "other"], 2000).collect()) == list(range(2000))
    largest = frame.groupBy(F.pmod(digest("id", "other"), F.lit(64))).count().agg(F.max("count")).first()[0]
    assert largest < 100


# Licenses


def test_license_base_places(spark):
    texts = [None, "", "...", "Under THE-MIT license under the mit license", "cc by nc cc by nc", "Apache License, Version 2.0",
             "apache license version 20", "xunder the mit license", "é under the mit license", "cc\x00by\nnc",
             "The mit license under", "cc by nc " + "word " * 5000 + "under the mit license",
             "This work is licensed under the GNU General Public License, version 3."]
    got = {r["doc_id"]: r for r in rows_of(licenses.license_scan(documents(spark, list(enumerate(texts)))))}
    for i, text in enumerate(texts):
        words = LICENSE_WORD.findall((text or "").translate(LOWER))
        places = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(words))
                        if words[k:k + len(p.split())] == p.split())
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places)), text
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (not places or r["score"] == 1)
    assert got[12]["labels"] == "gpl-3" and got[0]["labels"] == ""


def test_license_blocks_equal_plain_version(spark):
    rng = random.Random(3)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + [f"w{i}" for i in range(300)]
    texts = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 150))]
        if i % 2:
            own = licenses.TEMPLATES[i % len(licenses.TEMPLATES)][1].split()
            own = [w for w in own if rng.random() > 0.1]
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
        texts.append(" ".join(words))
    got = {(r["doc_id"], r["template"], r["start"]) for r in rows_of(licenses.matches(documents(spark, list(enumerate(texts)))))}
    want = set()
    for i, text in enumerate(texts):
        words = text.split()
        for start, word in enumerate(words):
            block = set(words[start:start + 64])
            for t, (_, body) in enumerate(licenses.TEMPLATES):
                own = set(body.split())
                if word in own and 20 * len(own & block) >= 17 * len(own):
                    want.add((i, t, start))
    assert got == want and got


def test_license_words_apart_are_found_at_every_place(spark):
    body = [w for word in licenses.TEMPLATES[4][1].split() for w in (word, *["x"] * 10)]
    docs = documents(spark, [(i, " ".join(["y"] * i + body)) for i in range(70)] + [(100, " ".join(body).replace("x x", "x x x"))])
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in rows_of(licenses.license_scan(docs))}
    assert got.pop(100) == ("", 0.0) and set(got.values()) == {("cc-by-nc", 1.0)}


def test_license_repeats_and_nothing(spark):
    docs = documents(spark, [(1, "cc by nc"), (1, "cc by nc"), (None, "cc by nc"), (1, "x")])
    assert sorted(r["base_labels"] for r in rows_of(licenses.license_scan(docs))) == ["", "cc-by-nc", "cc-by-nc", "cc-by-nc"]
    assert licenses.license_scan(docs.limit(0)).count() == 0


# Toxicity


@pytest.mark.parametrize("sf, recall, precision", [("sf0.1", 0.85, 0.9)])
def test_held_out_labels(spark, sf, recall, precision):
    folder = f"/root/testdata/{sf}"
    scored = {r["doc_id"]: r for r in catalog.op5(spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if scored[r["doc_id"]]["held_out"]]
    hits = sum(scored[r["doc_id"]]["predicted"] for r in labels if r["toxic"])
    said = sum(scored[r["doc_id"]]["predicted"] for r in labels)
    assert hits >= recall * sum(r["toxic"] for r in labels) and hits >= precision * said
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored.values())


def labelled(spark, n, label):
    rng = random.Random(9)
    texts, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(500)}" for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            words[rng.randrange(40)] = f"zorgle{rng.randrange(9)}"
        texts.append((i, " ".join(words)))
        labels.append((i, int(bad) if label else None))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learned_stem_and_changed_held_out_labels(spark):
    docs, labels = labelled(spark, 400, True)
    first = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert all((first[i] >= 0.3) == (i % 5 == 0) for i in first)
    turned = labels.withColumn("toxic", toxicity.F.expr("IF(pmod(crc32(string(doc_id)), 4) = 2, 1 - toxic, toxic)"))
    assert first == {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, turned).collect()}


def test_words_beside_voters_raise_a_text_without_any_vote(spark):
    docs, labels = labelled(spark, 400, True)
    beside = docs.withColumn("text", toxicity.F.expr("IF(doc_id % 10 = 0, concat(text, ' grumpf'), text)"))
    alone = documents(spark, [(1000, "w1 w2 grumpf"), (1001, "w1 w2 w3"), (1002, "w1 w2 zorgle3")])
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(beside.union(alone), labels).collect()}
    assert got[1000] > 2 * got[1001] and got[1002] >= 0.3 > got[1001]


def test_classifier_learns_weights_from_zero(spark):
    m, odds = 3, np.array([4.0, 0.0, -1.0, -2.0])
    bags = [np.array(x, "<u2").tobytes() for x in ([1, 2], [1, 3], [4], [5, 9])]
    rows = [(bytearray([0]), bytearray(bags[i % 2])) if i < 20 else (bytearray([2]), bytearray(bags[2 + i % 2])) for i in range(60)]
    w = toxicity.train_classifier(spark.createDataFrame(rows, "fired binary, bag binary"), odds, m)
    x, buckets = w[:m - 1], w[m - 1:-1]
    assert x[0] > 0.5 and buckets[1] > 0.3 and buckets[1] > buckets[2] > 0 > buckets[4] and buckets[7] == 0


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = labelled(spark, 30, False)
    odd = documents(spark, [(100, None), (101, ""), (102, "you idiot, you stupid moron"), (None, "x"), (100, None)]).union(docs)
    got = rows_of(toxicity.toxicity(odd, labels))
    assert len(got) == 35
    assert {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] in (100, 101, 102)} == {100: 0, 101: 0, 102: 1}
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


# Top k


def plain_top(vectors, k):
    usable = {i: [int(np.floor(64 * float(np.float32(x)))) for x in v] for i, v in vectors
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in usable:
        if q % 20 == 0:
            scores = [(sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q]
            out |= {(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k])}
    return out


@pytest.mark.parametrize("n, k", [(400, 20), (30, 20), (1, 5), (0, 5)])
def test_top_k_equals_plain_version(spark, n, k):
    rng = random.Random(n)
    vectors = [(i, [1.0, -0.5, 0.25, 0.0] if i % 3 == 0 else [rng.uniform(-2, 2) for _ in range(4)]) for i in range(n)]
    vectors += [(1000, None), (1020, [float("nan")] * 4), (1040, [None, 1.0, 1.0, 1.0]), (1060, [float("inf")] * 4)] * bool(n)
    vectors += [(None, [1.0] * 4), (1080, []), (1100, [3.0]), (1101, [1.0] * 6)] * bool(n)
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk_search.top_k(frame, toxicity.F.col("vec_id") % 20 == 0, k).collect()}
    assert got == plain_top(vectors, k)


def test_top_k_of_large_numbers(spark):
    vectors = [(i, [float(2 ** (18 + i)), 1.0 * i]) for i in range(12)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk_search.top_k(frame, toxicity.F.col("vec_id") % 20 == 0, 3).collect()}
    assert got == plain_top(vectors, 3)


def test_a_repeated_query_takes_its_least_vector(spark):
    vectors = [(i, [float(i), 50.0 - i]) for i in range(1, 20)]
    frame = spark.createDataFrame([(20, [3.0, 1.0]), (20, [1.0, 3.0]), (20, [2.0, 0.0]), *vectors], "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk_search.top_k(frame.coalesce(1), toxicity.F.col("vec_id") == 20, 5).collect()}
    assert got == plain_top([(20, [1.0, 3.0]), *vectors], 5)


# Urls


def test_url_parts_and_rules(spark):
    urls = ["http://WWW.Example.com/en/a?x#y", "http://example.com/en/", "http://a.b.example.com/en/x", "http://notexample.com/en/",
            "http://x.net/es/1", "http://net/fr/", "http://x.net", "http://a.org?q=/es/", "no scheme", None, "", "http://", "http:///p",
            "a://b://c/d", "http://x.net/es/1", "http://com/"]
    got = {r["page_id"]: r for r in rows_of(url_filters.url_verdicts(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")))}
    parts = [(r["host"], r["path"], r["rule"]) for _, r in sorted(got.items())]
    assert parts == [
        ("www.example.com", "/en/a", "www.example.com/en/"), ("example.com", "/en/", "example.com/en/"),
        ("a.b.example.com", "/en/x", "example.com/en/"), ("notexample.com", "/en/", "com/"), ("x.net", "/es/1", "net/es/"),
        ("net", "/fr/", "net/fr/"), ("x.net", "", None), ("a.org", "", None), ("", "", None), ("", "", None), ("", "", None),
        ("", "", None), ("", "/p", None), ("b:", "//c/d", None), ("x.net", "/es/1", "net/es/"), ("com", "/", "com/")]
    model = url_filters.default_model()
    for i, r in got.items():
        score = model.bias + sum(model.weights[url_filters.bucket(g)] for g in url_filters.grams_of(r["host"] + r["path"]))
        assert r["score"] == score
        said = {None: "block" if score > 0 else "allow", "com/": "allow", "www.example.com/en/": "allow"}
        assert r["verdict"] == said.get(r["rule"], "block")


def test_url_clashing_names(spark):
    pages = clashing(spark.createDataFrame([(1, "http://example.com/en/"), (2, None)], "page_id long, url string"))
    out = url_filters.url_verdicts(pages).filter("page_id = 1").first()
    assert (out["rule"], out["verdict"], out["_said"], out["a.b"]) == ("example.com/en/", "block", 6, 12)


def test_url_model_separates_kinds():
    model = url_filters.default_model()
    score = lambda u: model.bias + sum(model.weights[url_filters.bucket(g)] for g in url_filters.grams_of(u))
    assert all(score(u) > 0 for u in ("best-poker-bonus.org/x", "m.casino-win.example.org/a.html", "cheap-pills.info/"))
    assert all(score(u) < 0 for u in ("docs.python.org/3/", "en.wikipedia.org/wiki/Spark", "city-library.org/opening"))


# Quality


def test_quality_counts_and_lines(spark):
    clean = "The river runs past the old mill and on to the quiet town below it."
    other = "Nobody there remembers who built the first wheel."
    texts = [None, "", " \n\t", "one", clean, "\n".join([clean] * 3), "a b c d e f " * 40, clean + "\nHome | About | Help | Contact\n" + other,
             "\n".join(["BUY!! NOW!! AND!! SAVE!! MORE!!"] * 2 + [clean]), "A%%% b*** c$$$ d&&& e### f%%% g%%% h*** i$$$ j### k%%%",
             "x y\n\nx y\n x y\nx y", "é ß 漢字 𝔘 " * 5, clean + "\nWe use cookies.", "word " * 20000 + clean]
    got = {r["doc_id"]: r for r in rows_of(quality_rules.quality_rules(documents(spark, list(enumerate(texts)))))}
    for i, text in enumerate(texts):
        words, r = WORD.findall(text or ""), got[i]
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        repeats = repeated_words(text)
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text or "")
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), repeats)
        assert r["base_failed"] == (len(words) < 10 or 100 * repeats > 20 * len(words))
        assert not (r["base_failed"] and r["kept"])
    assert got[4]["kept"] and got[7]["kept"] and got[12]["kept"] and not got[8]["kept"] and not got[9]["kept"]
    assert got[7]["clean_text"] == f"{clean}\n{other}" and got[12]["clean_text"] == clean and got[4]["clean_text"] == clean


def test_quality_random_repeats(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 120))) for _ in range(150)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in rows_of(quality_rules.quality_rules(documents(spark, list(enumerate(texts)))))}
    assert got == {i: repeated_words(t) for i, t in enumerate(texts)}


def test_quality_clashing_names_and_nothing(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, None)]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "N_Words")
    out = quality_rules.quality_rules(docs)
    assert out.columns.count("kept") == 1 and out.count() == 3 and quality_rules.quality_rules(docs.limit(0)).count() == 0
    wide = rows_of(quality_rules.quality_rules(clashing(documents(spark, [(1, "a b c d e f g h i j k l")]))))
    assert len(wide) == 1 and wide[0]["kept"] and wide[0]["_lines"] == 4 and wide[0]["lost"] == 0.0 and wide[0]["Turn"] == 14


def test_top_k_of_scores_that_no_double_holds(spark):
    big = float(2 ** 21)
    rows = [(i, [big, big + x, 1.0]) for i, x in ((0, 0.0), (1, 1 / 64), (2, 2 / 64), (3, 3 / 64))] + [(20, [1.0, 1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    for k in (1, 2, 5):
        got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in
               topk_search.top_k(vectors, F.col("vec_id") % 20 == 0, k).collect()]
        want = []
        for q in (0, 20):
            scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:k]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
        assert sorted(got) == want
    assert max(-s for s, _ in scored) < 2 ** 63


def test_top_k_with_a_third_of_rows_under_one_id(spark):
    rng = np.random.default_rng(2)
    rows = [(7 if i % 3 == 0 else i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(900)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["score"] for r in topk_search.top_k(vectors, F.col("vec_id") % 20 == 0, 3).collect()}
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    for q, v in whole:
        if q % 20 == 0:
            scores = sorted((sum(a * b for a, b in zip(v, w)) for i, w in whole if i != q), reverse=True)[:3]
            assert [got[q, n] for n in (1, 2, 3)] == scores
