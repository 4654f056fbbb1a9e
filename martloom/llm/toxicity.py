"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posterior labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.shingles import prefix_hashes, text_parts
from martloom.llm.shipping import in_arrow
from martloom.session import materialise

#: Rows of each label that lexicons are learned from, at most: those with the smallest hashes of their id.
SAMPLE = 3000
#: Features looked at, features chosen, and documents that a feature must add, at least as a share of the sample.
LOOKED_AT, CHOSEN, LEAST_GAIN, GAIN_SHARE = 4000, 96, 2, 0.002
PRECISION = 0.9
#: Bytes of a word's beginning that a stem has, and how often it must stand in a text for voters of rising levels.
STEMS, LEVELS = range(3, 9), 3
THRESHOLD = 0.3
#: A lexicon of plain insults, each word a voter.
INSULTS = ("idiot", "idiots", "moron", "morons", "stupid", "dumb", "imbecile", "loser", "losers", "trash", "garbage", "scum",
           "pathetic", "worthless", "disgusting", "clown", "clowns", "jerk", "bastard", "vermin", "filth", "dimwit", "cretin",
           "scumbag", "halfwit")
PATTERNS = ("shouting", "capitals", "question storm")
SILENT = "no voter"
EM_ROUNDS = 8
#: The classifier's features beside the voters: distinct words of a text and their stems of so many bytes, hashed to buckets.
BUCKETS, BAG_STEM = 1 << 16, 5
#: Steps of its fit at most, earlier ones a step remembers, penalties on weights of voters and of buckets, and when to stop.
FIT_ROUNDS, MEMORY, PULL_VOTER, PULL_WORD, SETTLED = 20, 8, 0.1, 1.0, 1e-4
#: Sums that steps depend on are added up as whole numbers of this size, so that they do not depend on the order of tasks.
GRAIN = 2.0 ** -30
#: Documents that the rates seen in the sample count as, beside all documents' votes.
WEIGHT_OF_SAMPLE = 20
#: Two voters that agree beyond their accuracies by this correlation share their weight.
CORRELATED = 0.2

_PARTS = np.ones(256, bool)
_PARTS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def is_held_out(key: str) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2


def training_rows(labels: DataFrame, key: str, label: str, sample: int = SAMPLE) -> DataFrame:
    """(key, toxic) of the labelled rows to learn from: not held out, at most ``sample`` of each label."""
    fit = labels.filter(F.col(label).isin(0, 1) & ~is_held_out(key)).select(F.col(key).alias("_id"), F.col(label).alias("toxic"))
    order = (F.xxhash64("_id"), F.col("_id"))
    return fit.filter("toxic = 1").orderBy(*order).limit(sample).union(fit.filter("toxic = 0").orderBy(*order).limit(sample))


def feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, level, toxic, clean): in how many sampled texts of each label a word or stem stands ``level`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, _, data, starts in text_parts(batch.column(1)):
                owners, values = (np.concatenate(x) for x in zip(*prefix_hashes(data, starts, STEMS, _PARTS)))
                order = np.lexsort((owners, values))
                owners, values = owners[order], values[order]
                new = np.append(True, (values[1:] != values[:-1]) | (owners[1:] != owners[:-1]))[:len(values)]
                times = np.diff(np.append(np.flatnonzero(new), len(values)))
                owners, values = owners[new], values[new]
                for level in range(1, LEVELS + 1):
                    enough = times >= level
                    value, inverse = np.unique(values[enough], return_inverse=True)
                    toxic = np.bincount(inverse, label[owners[enough] + a], len(value)).astype(np.int64)
                    total = np.bincount(inverse, minlength=len(value))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value.view(np.int64)), pa.array(np.full(len(value), level)), pa.array(toxic),
                         pa.array(total - toxic)], ["feature", "level", "toxic", "clean"])

    found = in_arrow(sample.select("toxic", "text"), run, "feature long, level long, toxic long, clean long")
    return found.groupBy("feature", "level").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Lookup:
    """Numbers of known features: a hash, and how often it must stand in a text."""

    def __init__(self, hashes: np.ndarray, levels: np.ndarray):
        order = np.lexsort((levels, hashes))
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.first = np.append(first, len(order))
        self.order, self.levels = order, levels[order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``value``, hash numbers) of those that are known."""
        at = np.flatnonzero(self.maybe[(value >> np.uint64(48)).astype(np.int64)])
        if not len(at) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.searchsorted(self.hashes, value[at]).clip(max=len(self.hashes) - 1)
        hit = self.hashes[place] == value[at]
        return at[hit], place[hit]

    def fired(self, rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Sorted row << 32 | feature of the features that stand often enough, from (row, hash) of every place."""
        pairs, times = np.unique(rows.astype(np.int64) << 32 | hashes.astype(np.int64), return_counts=True)
        rows, hashes = pairs >> 32, pairs & 0xFFFFFFFF
        each = self.first[hashes + 1] - self.first[hashes]
        at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(self.first[hashes], each)
        enough = np.repeat(times, each) >= self.levels[at]
        return np.sort(np.repeat(rows, each)[enough] << 32 | self.order[at[enough]])


def _found(column: pa.Array, lookup: Lookup) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, sorted row << 32 | feature, sorted row << 32 | bucket, bytes, starts) for runs of texts.

    Features are the known ones that stand in a text; buckets are those of all its words and stems.
    """
    for a, b, data, starts in text_parts(column):
        rows, hashes, bags = [], [], []
        for size, (owner, value) in zip((0, *STEMS), prefix_hashes(data, starts, STEMS, _PARTS)):
            at, number = lookup.find(value)
            rows.append(owner[at])
            hashes.append(number)
            if size in (0, BAG_STEM):
                bags.append(owner.astype(np.int64) << 32 | (value % np.uint64(BUCKETS)).astype(np.int64))
        yield a, b, lookup.fired(np.concatenate(rows), np.concatenate(hashes)), np.unique(np.concatenate(bags)), data, starts


def learn_lexicon(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and levels of words and stems that mark toxic texts: each adds the most sampled toxic texts not marked yet.

    A feature is looked at if nearly all sampled texts that hold it are toxic. The sample bounds all that is gathered.
    """
    looked = feature_counts(sample).filter(
        (F.col("toxic") >= LEAST_GAIN) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))))
    top = looked.orderBy(F.col("toxic").desc(), "clean", "level", "feature").limit(LOOKED_AT).collect()
    features = np.array([r["feature"] for r in top], np.int64).view(np.uint64)
    levels, clean = np.array([r["level"] for r in top], np.int64), np.array([r["clean"] for r in top])
    if not top:
        return features, levels
    lookup = Lookup(features, levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, pairs, *_ in _found(batch.column(0), lookup):
                bits = np.zeros((b - a, len(features)), bool)
                bits[pairs >> 32, pairs & 0xFFFFFFFF] = True
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())], ["bits"])

    held = in_arrow(sample.filter("toxic = 1").select("text"), run, "bits binary").collect()
    stands = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in held]), axis=1)[:, :len(features)].astype(bool)
    left, chosen = np.ones(len(stands), bool), []
    least = max(LEAST_GAIN, GAIN_SHARE * len(stands))
    while len(chosen) < CHOSEN:
        gain = stands[left].sum(0) - clean
        best = int(np.lexsort((np.arange(len(gain)), levels, -stands.sum(0), -gain))[0])
        if gain[best] < least:
            break
        chosen.append(best)
        left &= ~stands[:, best]
    return features[chosen], levels[chosen]


def lexicon(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The insults' hashes and levels, then the learned ones."""
    words = "\n".join(INSULTS).encode()
    starts = np.cumsum([0, *(len(w) + 1 for w in INSULTS)])
    starts[-1] -= 1
    fixed = next(iter(prefix_hashes(np.frombuffer(words, np.uint8), starts, STEMS, _PARTS)))[1]
    hashes, levels = learn_lexicon(sample)
    new = ~(np.isin(hashes, fixed) & (levels == 1))
    return np.concatenate([fixed, hashes[new]]), np.concatenate([np.ones(len(fixed), np.int64), levels[new]])


def votes(docs: DataFrame, words: tuple[np.ndarray, np.ndarray], text: str = "text") -> DataFrame:
    """Adds ``fired`` and ``bag`` and drops the text.

    ``fired``: the numbers of the voters that speak up, in order, one byte each. Each lexicon entry and each pattern votes
    for toxic where it stands; where none does, one voter votes for clean. ``bag``: the buckets of all words and stems of
    the whole text, in order, two bytes each.
    """
    keep = [c for c in docs.columns if c != text]
    schema = docs.select(*keep, F.lit(b"").alias("fired"), F.lit(b"").alias("bag")).schema
    lookup, patterns, silent = Lookup(*words), len(words[0]), len(words[0]) + len(PATTERNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fired, bag = [], []
            for a, b, known, words_in, data, starts in _found(batch.column(text), lookup):
                own = data[starts[0]:starts[-1]]
                edge = starts - starts[0]
                count = lambda signs: np.diff(np.append(0, np.cumsum(signs))[edge])
                upper, letters = count(_UPPER[own]), count(_LETTER[own])
                loud = np.stack([count(own == ord("!")) >= 3, (letters >= 20) & (2 * upper > letters), count(own == ord("?")) >= 5])
                which, who = np.nonzero(loud)
                pairs = np.concatenate([known, who << 32 | (which + patterns)])
                pairs.sort()
                bounds = np.searchsorted(pairs >> 32, np.arange(b - a + 1))
                numbers = (pairs & 0xFF).astype(np.uint8)
                for lo, hi in zip(bounds, bounds[1:]):
                    mine = numbers[lo:hi]
                    fired.append(mine.tobytes() + (b"" if (mine < patterns).any() else bytes([silent])))
                bounds = np.searchsorted(words_in >> 32, np.arange(b - a + 1))
                numbers = (words_in & 0xFFFFFFFF).astype("<u2")
                bag += [numbers[lo:hi].tobytes() for lo, hi in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(fired, pa.binary()), pa.array(bag, pa.binary())], schema.names)

    return in_arrow(docs.select(*docs.columns), run, schema)


def _summed(patterns: DataFrame, work) -> dict[int, float]:
    """Sums of what ``work`` makes of (vote matrix, counts), a list of numbers, over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            counts = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            part = work(batch.column(0).to_pylist(), counts)
            total = part if total is None else total + part
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["i", "x"])

    rows = in_arrow(patterns.select("fired", "n"), run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    return {r["i"]: r["x"] for r in rows}


def _matrix(fired: list[bytes], m: int) -> np.ndarray:
    out = np.zeros((len(fired), m))
    for i, f in enumerate(fired):
        out[i, np.frombuffer(f, np.uint8)] = 1
    return out


def _dense(sums: dict[int, float], n: int) -> np.ndarray:
    out = np.zeros(n)
    for i, x in sums.items():
        out[i] = x
    return out


def label_model(patterns: DataFrame, seen: np.ndarray, rows: np.ndarray, prior: float, m: int) -> np.ndarray:
    """Weights of the voters and, last, a bias: the log odds of toxic given who fired.

    Accuracies: how often a voter fires on toxic and on clean documents, first from the sample (``seen`` by label, of
    ``rows``), then by expectation and maximization over the vote patterns of all documents. Correlations: what two
    voters fire together beyond these accuracies; a voter's weight is divided among those it goes with.
    """
    first = (seen + 0.05) / (rows[:, None] + 1)
    rates, share = first, np.ones(m)
    odds = np.log(prior / (1 - prior))
    weights = np.append(share * np.log(rates[1] / rates[0]), odds)
    for turn in range(EM_ROUNDS):
        def expect(fired, counts, weights=weights):
            v = _matrix(fired, m)
            p = 1 / (1 + np.exp(-(v @ weights[:-1] + weights[-1])))
            both = [v.T @ (counts * p), v.T @ (counts * (1 - p)), [counts @ p, counts @ (1 - p)]]
            if turn == EM_ROUNDS // 2:
                both += [((v * (counts * p)[:, None]).T @ v).ravel(), ((v * (counts * (1 - p))[:, None]).T @ v).ravel()]
            return np.concatenate(both)

        sums = _dense(_summed(patterns, expect), 2 * m + 2 + (2 * m * m if turn == EM_ROUNDS // 2 else 0))
        on_toxic, on_clean, (toxic, clean) = sums[:m], sums[m:2 * m], sums[2 * m:2 * m + 2]
        rates = np.stack([(on_clean + WEIGHT_OF_SAMPLE * first[0]) / (clean + WEIGHT_OF_SAMPLE),
                          (on_toxic + WEIGHT_OF_SAMPLE * first[1]) / (toxic + WEIGHT_OF_SAMPLE)])
        if turn == EM_ROUNDS // 2:
            together = sums[2 * m + 2:].reshape(2, m, m)
            n = np.array([max(toxic, 1.0), max(clean, 1.0)])
            excess = np.zeros((m, m))
            for y, one in ((0, rates[1]), (1, rates[0])):
                spread = np.sqrt(np.outer(one * (1 - one), one * (1 - one))) + 1e-9
                excess = np.maximum(excess, (together[y] / n[y] - np.outer(one, one)) / spread * (n[y] * np.minimum.outer(one, one) >= 5))
            np.fill_diagonal(excess, 0)
            share = 1 / (1 + np.where(excess >= CORRELATED, excess.clip(max=1), 0).sum(1))
        odds = np.log(toxic + WEIGHT_OF_SAMPLE * prior) - np.log(clean + WEIGHT_OF_SAMPLE * (1 - prior))
        weights = np.append(share * np.log(rates[1] / rates[0]), odds)
        silent = m - 1
        weights[silent] = min(weights[silent], 0)
    return weights


class Rows:
    """Features of some documents: the voters but the silent one, the buckets, and a one."""

    def __init__(self, fired: list[bytes], bags: list[bytes], m: int):
        self.votes, self.m = _matrix(fired, m), m
        self.buckets = np.frombuffer(b"".join(bags), "<u2").astype(np.int64)
        self.owner = np.repeat(np.arange(len(bags)), [len(x) // 2 for x in bags])

    def labels(self, posterior: np.ndarray) -> np.ndarray:
        return _logistic(self.votes @ posterior[:-1] + posterior[-1])

    def odds(self, w: np.ndarray) -> np.ndarray:
        heard = self.m - 1
        return (self.votes[:, :heard] @ w[:heard] + w[-1]
                + np.bincount(self.owner, w[heard:-1][self.buckets], len(self.votes)))

    def summed(self, x: np.ndarray) -> np.ndarray:
        """For every feature the sum of ``x`` over the documents that have it."""
        return np.concatenate([self.votes[:, :-1].T @ x, np.bincount(self.buckets, x[self.owner], BUCKETS), [x.sum()]])


def _logistic(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _over_documents(cast: DataFrame, m: int, work, n: int) -> np.ndarray:
    """Sums of what ``work`` makes of the ``Rows`` of a batch, ``n`` numbers, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for batch in batches:
            total += work(Rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), m))
        whole = np.rint(total / GRAIN).astype(np.int64)
        at = np.flatnonzero(whole)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(whole[at])], ["i", "x"])

    rows = in_arrow(cast.select("fired", "bag"), run, "i long, x long").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(n)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy() * GRAIN
    return out


def train_classifier(cast: DataFrame, posterior: np.ndarray, m: int) -> np.ndarray:
    """Weights of the voters but the silent one, of the buckets and, last, a bias: logistic regression on whole texts.

    Its labels are the label model's posteriors of the documents. It starts from zero, and the sums of every step run
    over all documents. Steps follow the quasi-Newton method with the latest ``MEMORY`` changes (L-BFGS), first scaled
    by each feature's own curvature; a step that makes the fit worse is cut.
    """
    n = m + BUCKETS
    pull = np.concatenate([np.full(m - 1, PULL_VOTER), np.full(BUCKETS, PULL_WORD), [1e-6]])

    def held(rows):
        y = rows.labels(posterior)
        return np.concatenate([rows.summed(np.ones(len(y))), [y.sum()]])

    have = _over_documents(cast, m, held, n + 1)
    have, toxic, total = have[:-1], have[-1], have[-2]
    w = np.zeros(n)
    if not total:
        return w
    rate = min(max(toxic / total, 1e-6), 1 - 1e-6)
    w[-1] = np.log(rate / (1 - rate))
    scale = 1 / (have * rate * (1 - rate) + pull)

    def loss_and_slope(w):
        def work(rows):
            z, y = rows.odds(w), rows.labels(posterior)
            return np.append(rows.summed(_logistic(z) - y), (np.logaddexp(0, z) - y * z).sum())

        sums = _over_documents(cast, m, work, n + 1)
        return sums[-1] + 0.5 * (pull * w * w).sum(), sums[:-1] + pull * w

    loss, slope = loss_and_slope(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    part, move = 1.0, None
    for _ in range(FIT_ROUNDS):
        if move is None:
            move, back = slope.copy(), []
            for s, g in reversed(past):
                back.append((s @ move) / (s @ g))
                move -= back[-1] * g
            move = move * scale * (1.0 if not past else (past[-1][0] @ past[-1][1]) / (past[-1][1] @ (scale * past[-1][1])))
            for (s, g), b in zip(past, reversed(back)):
                move += (b - (g @ move) / (s @ g)) * s
            part = min(1.0, 4 / max(np.abs(move).max(), 1e-9)) * (1.0 if past else 0.1)
        tried = w - part * move
        new_loss, new_slope = loss_and_slope(tried)
        if new_loss > loss:
            part /= 4
            continue
        if (tried - w) @ (new_slope - slope) > 1e-12:
            past = [*past, (tried - w, new_slope - slope)][-MEMORY:]
        settled = loss - new_loss < SETTLED * loss
        w, loss, slope, move = tried, new_loss, new_slope, None
        if settled:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
             threshold: float = THRESHOLD, marks: tuple[str, ...] = ()) -> DataFrame:
    """(key, held_out, score, predicted, further ``marks`` columns) for every document.

    Lexicons are learned from labelled rows that are not held out, at most ``SAMPLE`` of each label; whole texts are
    read. All documents' votes fit the label model; its posteriors of all documents are the labels of a classifier of
    votes, words and stems, whose probability is the score. Null and empty texts get the score of a text
    without any vote; repeated rows are scored each; a null key is not held out; labels that are null, missing or not 0
    or 1 are ignored. Without labelled rows the plain insults alone vote, from accuracies taken for granted.
    """
    train = materialise(training_rows(labels, key, label), "training")
    by_label = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    all_labels = {r[0]: r[1] for r in labels.filter(F.col(label).isin(0, 1) & ~is_held_out(key)).groupBy(label).count().collect()}
    prior = (all_labels.get(1, 0) + 1) / (sum(all_labels.values()) + 10)
    sample = docs.join(F.broadcast(train), F.col(key) == F.col("_id")).select("toxic", F.col(text).alias("text"))
    sample = materialise(sample.filter(F.col("text").isNotNull()).dropDuplicates(["text"]), "sample")
    words = lexicon(sample) if by_label.get(1) else lexicon(sample.limit(0))
    m = len(words[0]) + len(PATTERNS) + 1
    cast = materialise(votes(docs.select(key, *marks, F.col(text).alias("_text")), words, "_text"), "votes")
    patterns = materialise(cast.groupBy("fired").agg(F.count(F.lit(1)).alias("n")), "patterns")
    known = votes(sample, words).groupBy("toxic", "fired").agg(F.count(F.lit(1)).alias("n"))
    seen, rows = np.zeros((2, m)), np.zeros(2)
    for r in known.collect():
        seen[r["toxic"], np.frombuffer(r["fired"], np.uint8)] += r["n"]
        rows[r["toxic"]] += r["n"]
    if not rows.all():
        seen, rows = np.zeros((2, m)), np.array([1000.0, 1000.0])
        seen[1, :len(words[0])], seen[0, -1], seen[1, -1] = 200, 900, 10
    posterior = label_model(patterns, seen, rows, prior, m)
    w = train_classifier(cast, posterior, m)
    keep = cast.drop("fired", "bag")
    scored = in_arrow(cast, _scorer(w, m, keep.columns), keep.select("*", F.lit(0.0).alias("score")).schema)
    return scored.select(key, *marks, F.coalesce(is_held_out(key), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def _scorer(w: np.ndarray, m: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _logistic(Rows(batch.column("fired").to_pylist(), batch.column("bag").to_pylist(), m).odds(w))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score)], [*keep, "score"])

    return run
