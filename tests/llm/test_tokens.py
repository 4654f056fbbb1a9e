import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from plain import documents
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from martloom.llm import catalog, packing, token_counts, token_ids
from martloom.llm.bpe import Transducer

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
WORDS = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = ["", None, " ", "  a  ", "\n\n", "a\tb\r\nc", "<s>", "</s>x", "<|endoftext|> x", "<0x0A>", "▁▁ ▁a", "don't 'tis we'll 's 'S ''s x'",
       "é é 漢字 ಠ 𝔘 　 ｱ", "İstanbul ẞ ſ ﬁ Σίσυφος", "1234567890 3.14", "a" * 3000, "ab" * 1500, "-" * 2000, " " * 2000,
       "the " * 2000, "x y\u0085z w", "“quoted” – dash…", "A\x00B\x1cC"]


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = "abc  \n\té▁𝔘1239.,!?the ing#$ ÄÖß漢'sltred…–“œ"
    vocabulary = SentencePieceProcessor(model_file=PIECES)
    pieces = [vocabulary.id_to_piece(i).replace("▁", " ") for i in range(300, 32000)]
    return ([("".join(rng.choice(letters) for _ in range(rng.randrange(200)))) for _ in range(n)]
            + ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(n)])


@pytest.mark.parametrize("chunk", [7, 512])
def test_counts_equal_the_library(chunk):
    texts = ODD + random_texts(150, chunk)
    library = SentencePieceProcessor(model_file=PIECES)
    assert token_counts.count_texts(texts, PIECES, chunk).tolist() == [len(library.encode(t or "")) for t in texts]


def test_ids_equal_the_library():
    texts = ODD + random_texts(150, 3)
    library = Tokenizer.from_file(WORDS)
    ids, counts = token_ids.encode(texts, WORDS)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        assert ids[end - n:end].tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)[:80]


def test_tables_can_begin_anew():
    texts = random_texts(60, 5)
    library = SentencePieceProcessor(model_file=PIECES)
    machine, _ = token_counts.compiled(PIECES)
    machine.most_cells, kept = 1, machine.most_cells
    try:
        for part in (texts[:40], texts[40:80], texts[80:]):
            assert token_counts.count_texts(part, PIECES, 16).tolist() == [len(library.encode(t)) for t in part]
    finally:
        machine.most_cells = kept


def test_small_machine_follows_merges():
    tokens = {(0,): 0, (1,): 1, (0, 1): 2, (0, 1, 0): 3, (1, 1): 4}
    order = {(0, 1): 2, (0, 1, 0): 1, (1, 1): 0}
    machine = Transducer(tokens, lambda a, b: order.get(a + b), 2)
    rng = random.Random(1)
    for _ in range(300):
        run = [rng.randrange(2) for _ in range(rng.randrange(1, 12))]
        _, n = machine.run(np.array(run, np.int32), np.array([0]), np.array([len(run)]))
        assert n[0] == len(machine.merged(run)), run


def test_token_counts_query(spark):
    frame = documents(spark, list(enumerate(ODD))).withColumnRenamed("lang", "n_tokens")
    library = SentencePieceProcessor(model_file=PIECES)
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(frame, PIECES).collect()}
    assert found == {i: len(library.encode(t or "")) for i, t in enumerate(ODD)}
    assert token_counts.token_counts(frame.limit(0), PIECES).count() == 0


def test_whole_table_of_counts(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    library = SentencePieceProcessor(model_file=PIECES)
    for r in catalog.op8(spark, folder).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)


def check_packing(rows, texts, capacity=4096):
    library = Tokenizer.from_file(WORDS)
    own, total = {}, 0
    for r in rows:
        own.setdefault(r["doc_id"], []).append(r)
    assert own.keys() == texts.keys()
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        pieces = sorted(own[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(-(-len(ids) // capacity)))
        for p in pieces:
            part = ids[p["start"]:p["start"] + p["length"]]
            assert (p["start"], p["length"]) == (p["piece"] * capacity, len(part))
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), total


def test_whole_table_packed(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    n, total = check_packing([r.asDict() for r in catalog.op1(spark, folder).collect()], texts)
    assert n <= -(-total // 4096) + 1


def test_packing_odd_texts(spark):
    texts = dict(enumerate([*ODD, "word " * 9000, "same", "same"]))
    placed = packing.pack_documents(documents(spark, list(texts.items())), WORDS, with_ids=True).cache()
    check_packing([r.asDict() for r in placed.collect()], texts)
    packed = packing.sequences(placed).collect()
    assert all(r["n_tokens"] == len(r["ids"]) <= 4096 for r in packed)
    assert sum(r["n_tokens"] for r in packed) == sum(r["length"] for r in placed.collect())


def test_packing_repeats_nulls_and_nothing(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "a b"), (None, None), (None, "c")]
    placed = packing.pack_documents(documents(spark, rows), WORDS).collect()
    assert len(placed) == 5 and len({(r["sequence_id"], r["offset"]) for r in placed}) == 5
    assert packing.pack_documents(documents(spark, rows).limit(0), WORDS).count() == 0


def test_packing_refuses_lengths(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(0, 5)], "doc_id long, length long"), 4)


def test_hot_length_is_spread(spark):
    pieces = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 100 ELSE 1 + id % 37 END AS length")
    placed = packing.pack(pieces, 256).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in placed}) == 3000
    total = sum(r["length"] for r in placed)
    assert len({r["sequence_id"] for r in placed}) <= 1.02 * total / 256 + 1


def test_fullest_is_the_fullest():
    rng = random.Random(2)
    for _ in range(200):
        counts = {n: rng.randrange(1, 4) for n in rng.sample(range(1, 30), 6)}
        room = rng.randrange(0, 60)
        found = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert all(k <= counts[n] for n, k in found.items())
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
        assert sum(n * k for n, k in found.items()) == max(sums)


def test_bin_plan_uses_all_pieces():
    rng = random.Random(4)
    histogram = {n: rng.randrange(0, 50) for n in range(1, 65)}
    used = dict.fromkeys(histogram, 0)
    for copies, bin_ in packing.bin_plan(histogram, 64):
        assert sum(n * k for n, k in bin_.items()) <= 64
        for n, k in bin_.items():
            used[n] += copies * k
    assert used == histogram


def test_empty_texts_among_plain_ones_keep_ids_apart():
    texts = ["the cat", "", "naïve cat", None, "", "a re-do of 12 things", "x"]
    library = Tokenizer.from_file(WORDS)
    ids, counts = token_ids.encode(texts, WORDS)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [
        library.encode(t or "", add_special_tokens=False).ids for t in texts]


def random_machine(rng, symbols=3, ties=False, **options):
    """Tokens made by merging two others, in order or with equal and falling ranks."""
    tokens, order = {(s,): s for s in range(symbols)}, {}
    while len(tokens) < 40:
        a, b = (rng.choice(list(tokens)) for _ in range(2))
        if a + b not in tokens and len(a + b) < 9:
            order[a, b] = rng.randrange(9) if ties else len(order)
            tokens[a + b] = len(tokens)
    return Transducer(tokens, lambda a, b: order.get((a, b)), symbols, **options)


def test_tokens_side_by_side_fit_if_merging_keeps_them():
    rng = random.Random(11)
    for ties in (False, True):
        for _ in range(15):
            machine = random_machine(rng, ties=ties)
            whole = [t for t, part in machine.parts.items() if machine.merged(part) == [part]]
            for a in whole:
                for b in machine.parts:
                    pair = [machine.parts[a], machine.parts[b]]
                    assert machine.fits(a, b) == (b in whole and machine.merged(pair[0] + pair[1]) == pair), pair


def test_last_tokens_of_random_machines_follow_merges(monkeypatch):
    rng = random.Random(12)
    for few in (0, 3, 100):
        monkeypatch.setattr("martloom.llm.bpe.FEW", few)
        for _ in range(10):
            machine = random_machine(rng, with_tokens=True)
            counting = Transducer({p: t for t, p in machine.parts.items()}, machine.rank, 3)
            for _ in range(30):
                run = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
                last, ends = np.zeros(len(run), np.int32), (np.array([0]), np.array([len(run)]))
                machine.run(np.array(run, np.int32), *ends, last=last)
                found, at = [], len(run)
                while at:
                    found.insert(0, machine.parts[int(last[at - 1])])
                    at -= len(found[0])
                assert found == machine.merged(run), run
                assert counting.run(np.array(run, np.int32), *ends)[1][0] == len(found)


def test_new_words_make_few_states():
    rng = random.Random(13)
    parts = ["ré", "tion", "le", "ment", "ai", "ou", "ç", "èr", "es", "qu", "an", "st"]
    text = " ".join("".join(rng.choices(parts, k=rng.randrange(2, 6))) for _ in range(20_000))
    token_ids.compiled.cache_clear()
    _, machine, _, _ = token_ids.compiled(WORDS)
    token_ids.encode([text], WORDS)
    assert len(machine.keys) < 2_500
