"""Chat formatting: a hidden Markov model recovers who speaks in a transcript's lines, then turns are rendered alike."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.ranks import LEAST_SLICES, slice_count
from martloom.llm.shipping import in_arrow, ship
from martloom.session import materialise

ROLES = ("system", "user", "assistant")
#: Two states for each role: the first line of a turn, and a later one.
STATES = 2 * len(ROLES)
#: Names that mark a speaker at the start of a line.
NAMES = {"system": 0, "instructions": 0, "context": 0, "user": 1, "human": 1, "question": 1, "q": 1, "customer": 1, "prompt": 1,
         "instruction": 1, "assistant": 2, "ai": 2, "bot": 2, "answer": 2, "a": 2, "response": 2, "model": 2, "agent": 2}
MARKER = re.compile(r"\s*(?:#{1,6}\s*|<\|?|\[|\*\*)?(" + "|".join(sorted(NAMES, key=len, reverse=True)) + r")(?:\|?>|\]|\*\*)?\s*(?::\s*|$)",
                    re.IGNORECASE)
#: Values of the three line features: the marker (or blank, or none), the length by powers of two, the last sign.
KINDS = (len(ROLES) + 2, 12, 4)
BLANK, PLAIN = len(ROLES), len(ROLES) + 1
#: Turns of a part of a transcript, at most.
PART = 256


def features(line: str) -> tuple[int, int, int]:
    found = MARKER.match(line)
    kind = NAMES[found[1].lower()] if found else PLAIN if line.strip() else BLANK
    last = line.rstrip()[-1:]
    return kind, min(len(line).bit_length(), KINDS[1] - 1), ".?!".find(last) if last and last in ".?!" else 3


@dataclass(frozen=True)
class Model:
    """Log probabilities: of the first line's state, from state to state, and of each feature's values by state."""

    first: np.ndarray
    steps: np.ndarray
    values: tuple[np.ndarray, ...]

    def emit(self, lines: list[str]) -> np.ndarray:
        """Log probability of every line's features by state."""
        if not lines:
            return np.zeros((0, STATES))
        seen = np.array([features(x) for x in lines])
        return sum(v[:, seen[:, i]].T for i, v in enumerate(self.values))


def _logs(counts: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
    counts = counts + (0.1 if allowed is None else 0.1 * allowed)
    with np.errstate(divide="ignore"):
        return np.log(counts / counts.sum(-1, keepdims=True))


#: A later line follows a line of the same role only.
_CAN = np.array([[b % 2 == 0 or b // 2 == a // 2 for b in range(STATES)] for a in range(STATES)], float)
_CAN_START = np.array([s % 2 == 0 for s in range(STATES)], float)


def train(known: DataFrame) -> Model:
    """Fits the model to transcripts with known states: columns text and states (a digit per line).

    Counts are summed up over all rows; only the sums, whose number is fixed, come to the driver. Without rows all
    values are as likely as any.
    """
    sizes = [STATES, STATES * STATES, *[STATES * k for k in KINDS]]
    starts = np.cumsum([0, *sizes])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(starts[-1], np.int64)
        for batch in batches:
            for text, states in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                before = None
                for line, s in zip(text.split("\n"), map(int, states)):
                    total[starts[0] + s if before is None else starts[1] + before * STATES + s] += 1
                    for i, (value, k) in enumerate(zip(features(line), KINDS)):
                        total[starts[2 + i] + s * k + value] += 1
                    before = s
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["i", "n"])

    total = np.zeros(starts[-1])
    for r in in_arrow(known.select("text", "states"), count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        total[r["i"]] = r["n"]
    first, steps, *values = (total[a:b] for a, b in zip(starts, starts[1:]))
    return Model(_logs(first, _CAN_START), _logs(steps.reshape(STATES, STATES), _CAN),
                 tuple(_logs(v.reshape(STATES, k)) for v, k in zip(values, KINDS)))


def part_map(model: Model, lines: list[str]) -> np.ndarray:
    """Best log probability of a part by (state before it, or last: no line before it; state of its last line).

    Parts compose by max and plus. A part has one line at least.
    """
    best = None
    for emitted in model.emit(lines):
        best = (np.vstack([model.steps, model.first]) if best is None
                else (best[:, :, None] + model.steps[None]).max(1)) + emitted
    return best


def viterbi(model: Model, lines: list[str], before: np.ndarray, after: np.ndarray, opens: bool) -> list[int]:
    """The likeliest states of a part's lines, given the best scores of all states before it and from its end on."""
    emitted = model.emit(lines)
    score, back = None, []
    for row in emitted:
        if score is None and opens:
            score = model.first + row
            back.append(np.zeros(STATES, int))
            continue
        ways = (before if score is None else score)[:, None] + model.steps
        back.append(ways.argmax(0))
        score = ways.max(0) + row
    if score is None:
        return []
    states = [int((score + after).argmax())]
    for b in back[:0:-1]:
        states.append(int(b[states[-1]]))
    return states[::-1]


def turns_of(lines: list[str], states: list[int]) -> list[tuple[str, bool, str]]:
    """(role, whether the turn begins here, its text without marker) for the turns in a part."""
    turns: list[tuple[str, bool, list[str]]] = []
    for line, s in zip(lines, states):
        if s % 2 == 0 or not turns:
            turns.append((ROLES[s // 2], s % 2 == 0, []))
        found = MARKER.match(line) if s % 2 == 0 else None
        turns[-1][2].append(line[found.end():] if found else line)
    return [(role, begins, "\n".join(text).strip()) for role, begins, text in turns]


def rendered(turns: list[tuple[str, bool, str]]) -> str:
    """Canonical text: each turn between its role and an end sign; a turn that goes on from the part before has no head."""
    return "".join((f"<|{role}|>\n" if begins else "") + text + "\n<|end|>\n" for role, begins, text in turns)


def format_chats(parts: DataFrame, model: Model, key: str = "conv_id") -> DataFrame:
    """(key, part, n_lines, n_turns, roles, states, chat) for every part of a transcript.

    ``parts``: key, part (numbers in order) and text; lines are parted by line feeds, and a part begins with a line of its
    own. The most likely roles are those of the whole transcript: each part first gives its map from the state before to
    the state at its end, of fixed size; the maps of a transcript's parts compose to the best scores at every seam, and
    each part is then decoded between its seams. Null texts are empty, which is one blank line; a null key is one
    transcript; parts of one number are taken in the order of their texts.
    """
    kind = parts.schema[key].dataType.simpleString()
    numbered = materialise(parts.select(F.col(key).alias("k"), F.col("part").cast("long").alias("part"),
                                        F.coalesce("text", F.lit("")).alias("text")), "parts")
    ship(parts.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [part_map(model, t.split("\n")).astype("<f8").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(maps, pa.binary())],
                                             ["k", "part", "text", "map"])

    measured = materialise(in_arrow(numbered, measure, T.StructType([*numbered.schema, T.StructField("map", T.BinaryType())])), "maps")
    seam = measured.select("k", "part", F.xxhash64("text").alias("h"), "map")

    def compose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "h"], kind="stable")
        maps = [np.frombuffer(m, "<f8").reshape(STATES + 1, STATES) for m in rows["map"]]
        before, after = [np.zeros(STATES)], [np.zeros(STATES)]
        for i, m in enumerate(maps[:-1]):
            before.append((before[-1][:, None] + m[:-1]).max(0) if i else m[-1])
        for m in maps[:0:-1]:
            after.append((m[:-1] + after[-1][None]).max(1))
        rows = rows.assign(before=[b.tobytes() for b in before], after=[a.tobytes() for a in after[::-1]],
                           opens=[i == 0 for i in range(len(rows))])
        return rows[["k", "part", "h", "before", "after", "opens"]]

    # Most transcripts are one part and have no seam.
    several = seam.groupBy("k").count().filter(F.col("count") > 1).select(F.col("k").alias("_k"))
    seam = seam.join(several, F.col("k").eqNullSafe(F.col("_k")), "left_semi")
    seams = materialise(seam.groupBy("k").applyInPandas(
        compose, f"k {kind}, part long, h long, before binary, after binary, opens boolean").dropDuplicates(["k", "part", "h"]), "seams")
    seams = seams.withColumnsRenamed({"k": "_k2", "part": "_part2", "h": "_h2"})
    told = measured.select("k", "part", F.xxhash64("text").alias("h"), "text")
    same = F.col("k").eqNullSafe(F.col("_k2")) & F.col("part").eqNullSafe(F.col("_part2")) & (F.col("h") == F.col("_h2"))
    none = F.lit(bytes(8 * STATES))
    told = told.join(seams, same, "left").select("k", "part", "text", F.coalesce("before", none).alias("before"),
                                                 F.coalesce("after", none).alias("after"), F.coalesce("opens", F.lit(True)).alias("opens"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = {c: [] for c in ("n_lines", "n_turns", "roles", "states", "chat")}
            for text, before, after, opens in zip(rows["text"], rows["before"], rows["after"], rows["opens"]):
                lines = text.split("\n")
                states = viterbi(model, lines, np.frombuffer(before), np.frombuffer(after), opens)
                turns = turns_of(lines, states)
                out["n_lines"].append(len(lines))
                out["n_turns"].append(sum(begins for _, begins, _ in turns))
                out["roles"].append(",".join(role for role, begins, _ in turns if begins))
                out["states"].append("".join(map(str, states)))
                out["chat"].append(rendered(turns))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(out[c], pa.int64() if c[:2] == "n_" else pa.string()) for c in out]],
                [key, "part", *out])

    return in_arrow(told, decode, f"{key} {kind}, part long, n_lines long, n_turns long, roles string, states string, chat string")


# Transcripts from a table of turns, as chats are found on pages: marked in different ways, and sometimes not at all.

STYLES = ({"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
          {"system": "### Instructions:\n", "user": "### Human:\n", "assistant": "### AI:\n"},
          {"system": "[SYSTEM]\n", "user": "**Question**: ", "assistant": "**Answer**: "},
          {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"})
#: One turn in so many has no marker.
UNMARKED = 10


def _number(m: int, *columns: Column) -> Column:
    return F.pmod(F.crc32(F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]).cast("binary")), F.lit(m))


def is_held_out(key: str) -> Column:
    return _number(4, F.col(key)) == 2


def transcripts(turns: DataFrame, key: str = "conv_id", part: int = PART) -> DataFrame:
    """(key, part, text, states) from rows of key, turn, role and text: at most ``part`` turns to a part.

    A part is a block of ``part`` turn numbers; a block with more rows than that is cut by their rank, and the parts after
    it are numbered on. States are the true ones, a digit per line. Rows alike in all four columns are one turn; turns of one number stand in
    the order of role and text; a null turn comes first; a null text is empty; other roles count as user.
    """
    rows = turns.select(key, "turn", "role", "text").distinct()
    role = F.when(F.col("role").isin(*ROLES), F.col("role")).otherwise("user")
    style = _number(len(STYLES), F.col(key), F.lit("style")).cast("int")
    marks = F.array(*[F.create_map(*[F.lit(x) for pair in s.items() for x in pair]) for s in STYLES])
    marked = _number(UNMARKED, F.col(key), F.col("turn")) != 0
    mark = F.when(marked, F.get(marks, style)[role]).otherwise(F.lit(""))
    said = F.concat(mark, F.coalesce("text", F.lit("")), F.lit("\n"))
    number = F.element_at(F.create_map(*[x for i, r in enumerate(ROLES) for x in (F.lit(r), F.lit(2 * i))]), role)
    states = F.concat(number.cast("string"), F.repeat((number + 1).cast("string"), F.size(F.split(said, "\n")) - 1))
    block = F.coalesce(F.floor(F.col("turn") / part), F.lit(0)).cast("long")
    turn = F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), F.col("role"), F.col("text"), said.alias("said"), states.alias("states"))
    rows = rows.select(key, block.alias("_block"), turn.alias("t"))
    sizes = materialise(turns.groupBy(key, block.alias("_block")).agg(F.count(F.lit(1)).alias("_n")), "blocks")
    if sizes.filter(F.col("_n") > part).isEmpty():
        return _texts(rows.withColumnRenamed("_block", "part"), key)
    salt = F.pmod(F.xxhash64("t"), F.lit(LEAST_SLICES))
    large = sizes.filter(F.col("_n") > part).select(key, "_block", F.explode(F.sequence(F.lit(0), F.lit(LEAST_SLICES - 1))).alias("_salt"))
    salted = rows.withColumn("_salt", salt)
    usual = _texts(_met(salted, large, [key, "_block", "_salt"], "left_anti").withColumnRenamed("_block", "part"), key)
    cut, shifts = _cut(_met(salted, large, [key, "_block", "_salt"], "left_semi"), sizes, key, part)
    usual = _met(usual.withColumnRenamed("part", "_block"), shifts, [key, "_block"], "left")
    usual = usual.select(key, (F.col("_block") + F.coalesce("_shift", F.lit(0))).alias("part"), "text", "states")
    return usual.unionByName(_texts(cut, key))


def _met(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join in which null equals null; the keys are the left ones."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(other, on, how).drop(*[f"_r_{k}" for k in keys])


def _texts(rows: DataFrame, key: str) -> DataFrame:
    """(key, part, text, states) from the turns ``t`` of each part."""
    grouped = rows.groupBy(key, "part").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select(key, "part", F.array_join("t.said", "\n").alias("text"), F.array_join("t.states", "").alias("states"))


def _cut(rows: DataFrame, sizes: DataFrame, key: str, part: int) -> tuple[DataFrame, DataFrame]:
    """(key, part, t) of the turns of large blocks, and (key, _block, _shift): by how much parts move up in later blocks.

    Rows are ranked within ranges of all rows in the order of key, block and turn, of about equal size, and ranks are
    moved up by the sizes of the ranges before, so no task sees a whole block.
    """
    slices = slice_count(sizes.agg(F.sum("_n")).first()[0])
    ranged = rows.repartitionByRange(slices, key, "_block", "t.turn", "t.role", "t.text")
    ranged = materialise(ranged.select(key, "_block", "t", F.spark_partition_id().alias("_slice")), "ranges")
    counts = materialise(ranged.groupBy(key, "_block", "_slice").agg(F.count(F.lit(1)).alias("_c")), "range sizes")
    extra = counts.groupBy(key, "_block").agg((F.ceil(F.sum("_c") / part) - 1).alias("_extra"))
    over = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    moved = _met(sizes.select(key, "_block"), extra, [key, "_block"], "left")
    moved = moved.select(key, "_block", F.coalesce(F.sum("_extra").over(over), F.lit(0)).alias("_shift"))
    shifts = materialise(moved.filter("_shift > 0"), "shifts")
    earlier = Window.partitionBy(key, "_block").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(key, "_block", "_slice", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    before = _met(before, shifts, [key, "_block"], "left")
    inside = F.row_number().over(Window.partitionBy(key, "_block", "_slice").orderBy("t")) - 1
    ranked = _met(ranged.withColumn("_inside", inside), before, [key, "_block", "_slice"], "left")
    piece = F.floor((F.col("_before") + F.col("_inside")) / part)
    return ranked.select(key, (F.col("_block") + piece + F.coalesce("_shift", F.lit(0))).cast("long").alias("part"), "t"), shifts


def formatted(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Transcripts of all conversations, parsed with a model trained on those not held out."""
    found = materialise(transcripts(turns, key), "transcripts")
    model = train(found.filter(~is_held_out(key)))
    return format_chats(found, model, key)
