import sys
from pathlib import Path

from pyspark.sql import functions as F
from plain import documents, near_duplicates, repeated_words, WORD

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from martloom.llm import toxicity  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = (before, docs)
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    rows = lambda name, side: kept[name][side].collect()

    before, after = rows("toxicity", 0), rows("toxicity", 1)
    gone = {r["doc_id"] for r in toxicity.toxicity(kept["toxicity"][0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
            .filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - gone

    before, after = rows("quality_rules", 0), rows("quality_rules", 1)
    ids = {r["doc_id"] for r in after}
    for r in before:
        words = WORD.findall(r["text"] or "")
        if len(words) < 10 or 100 * repeated_words(r["text"]) > 20 * len(words):
            assert r["doc_id"] not in ids
    assert len(after) > 0.7 * len(before)

    before, after = rows("ngram_jaccard_join", 0), rows("ngram_jaccard_join", 1)
    plain = near_duplicates({r["doc_id"]: r["text"] for r in before})
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, c in plain.values()})

    before, after = rows("mixing", 0), rows("mixing", 1)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    size = lambda rs: sum(len(WORD.findall(r["text"])) for r in rs)
    assert abs(size(after) - size(before)) < 0.25 * size(before)

    before, after = rows("best_fit_packing", 0), rows("best_fit_packing", 1)
    assert sum(r["piece"] == 0 for r in after) == len(before)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count()


def test_one_of_each_group_with_repeats_and_nulls(spark):
    rows = [(3, "a b c d e f g"), (3, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (5, None), (6, ""), (6, ""),
            (None, None), (9, "other words stand here")]
    docs = documents(spark, rows)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, FOLDER).collect()), key=repr)
    assert got == sorted([(2, "a b c d e f g"), (5, None), (6, ""), (6, ""), (None, None), (9, "other words stand here")], key=repr)
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), FOLDER).count() == 0


def test_toxic_rows_go_and_others_stay(spark, folder):
    docs = documents(spark, [(1, "you pathetic idiot"), (2, "a quiet day"), (2, "a quiet day"), (None, "worthless scum"), (None, None)])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    out = corpus_pipeline.toxicity(spark, docs, folder)
    assert sorted(str(r["text"]) for r in out.collect()) == ["None", "a quiet day", "a quiet day"]


def test_stages_keep_columns_with_clashing_names(spark, folder):
    names = ("_a", "_b", "_c1", "_turn", "_one", "kept", "clean_text", "n_words", "group", "predicted", "a.b")
    docs = documents(spark, [(1, "you pathetic idiot " + "and some other words that stand here " * 2), (2, None), (None, ""), (2, None),
                             (4, "The river runs past the old mill and on to the quiet town below it.\nWe use cookies.")])
    wide = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    ids = lambda out: sorted(map(str, [r["doc_id"] for r in out.collect()]))
    out = {name: stage(spark, wide, folder) for name, stage in corpus_pipeline.STAGES[:4]}
    assert all(o.columns == wide.columns for o in out.values())
    assert all(tuple(r)[5:] == tuple(range(len(names))) for o in out.values() for r in o.collect())
    assert ids(out["toxicity"]) == ["2", "2", "4", "None"] and ids(out["quality_rules"]) == ["4"]
    assert out["quality_rules"].first()["text"] == "The river runs past the old mill and on to the quiet town below it."
    assert ids(out["ngram_jaccard_join"]) == ["1", "2", "2", "4", "None"]
    assert corpus_pipeline.STAGES[4][1](spark, wide, folder).count() == 5
