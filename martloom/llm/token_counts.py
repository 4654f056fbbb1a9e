"""Token counts by a compiled tokenizer: transducers annotated with counts, run over chunks of every text side by side."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.bpe import Transducer
from martloom.llm.shipping import in_arrow, kept

#: Characters of a chunk, and characters that are held at once.
CHUNK, HELD = 512, 400_000
SPACE = "▁"
#: Cells of the tables: this vocabulary's states are many and hold no token, so they get more room than the default.
CELLS = 34_000_000


@kept(2)
def compiled(model: str) -> tuple[Transducer, np.ndarray]:
    """The transducer of a sentencepiece pair-merge model with bytes for unknown characters, and the symbol of every
    code point. The model's pieces and scores are read with its own library; texts do not pass through that."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    kept = [i for i in range(pieces.get_piece_size())
            if not (pieces.is_byte(i) or pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i))]
    chars = sorted({c for i in kept for c in pieces.id_to_piece(i)})
    number = {c: i for i, c in enumerate(chars)}
    tokens, order = {}, {}
    for i in kept:
        part = tuple(number[c] for c in pieces.id_to_piece(i))
        tokens[part], order[part] = i, -pieces.get_score(i)
    n = len(chars)
    symbols = np.empty(0x110000, np.int16)
    for upto, size in ((0x80, 0), (0x800, 1), (0x10000, 2), (0x110000, 3)):
        symbols[0 if size == 0 else (0x80, 0x800, 0x10000)[size - 1]:upto] = n + size
    for c, i in number.items():
        symbols[ord(c)] = i
    symbols[ord(" ")] = number[SPACE]
    return Transducer(tokens, lambda a, b: order.get(a + b), n, breaks=(1, 2, 3, 4), most_cells=CELLS), symbols


def count_texts(texts: list[str | None], model: str, chunk: int = CHUNK) -> np.ndarray:
    """Tokens of each text. Null and empty texts have none.

    A text is cut into chunks. No token of these models reaches over a place where a blank follows something else, so
    a chunk's map from its first state to its last is constant if it holds such a place: all parts from there on run at
    once. The scan then hands each chunk the state that reaches it, and the parts before the first such place follow,
    in as many rounds as the longest run of chunks without one.
    """
    machine, symbols = compiled(model)
    full = [i for i, t in enumerate(texts) if t]
    total = np.zeros(len(texts), np.int64)
    if not full:
        return total
    points = np.frombuffer("".join(SPACE + texts[i] for i in full).encode("utf-32-le"), np.uint32)
    stream = symbols[points].astype(np.int32)
    lengths = np.fromiter((len(texts[i]) + 1 for i in full), np.int64, len(full))
    doc_ends = np.cumsum(lengths)
    doc_starts = doc_ends - lengths
    blank = int(symbols[ord(" ")])
    resets = np.flatnonzero((stream[1:] == blank) & (stream[:-1] != blank)) + 1
    per = -(-lengths // chunk)
    doc = np.repeat(np.arange(len(full)), per)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    starts = doc_starts[doc] + within * chunk
    ends = np.minimum(starts + chunk, doc_ends[doc])
    first = np.append(resets, len(stream))[np.searchsorted(resets, starts)]
    first = np.where(within == 0, starts, np.minimum(first, ends))
    has = first < ends
    state = np.full(len(doc), -1, np.int32)
    counts = np.zeros(len(doc), np.int64)
    at = np.flatnonzero(has)
    state[at], counts[at] = machine.run(stream, first[at], ends[at])
    waiting = np.flatnonzero(first > starts)
    while len(waiting):
        ready = waiting[state[waiting - 1] >= 0]
        end, n = machine.run(stream, starts[ready], first[ready], state[ready - 1])
        counts[ready] += n
        state[ready] = np.where(has[ready], state[ready], end)
        waiting = np.setdiff1d(waiting, ready, assume_unique=True)
    total[full] = np.bincount(doc, counts, len(full)).astype(np.int64)
    return total


def slices(texts: list[str | None], held: int = HELD) -> Iterator[tuple[int, int]]:
    """Cuts a batch so that one part holds about ``held`` characters; a longer text is a part of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > held:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def token_counts(docs: DataFrame, model: str, text: str = "text", out: str = "n_tokens",
                 drop_text: bool = False) -> DataFrame:
    """Adds the number of tokens of every whole text by a sentencepiece model.

    Null and empty texts count 0 tokens; a column named ``out`` is replaced; repeated rows are counted each. The text
    itself can be left out of the result.
    """
    given = [c for c in docs.columns if c.lower() != out.lower()]
    keep = [c for c in given if not (drop_text and c == text)]
    schema = docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(0).cast("long").alias(out)).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            counted = [count_texts(texts[a:b], model) for a, b in slices(texts)]
            column = pa.array(np.concatenate(counted) if counted else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], column], [*keep, out])

    return in_arrow(docs.select(*[F.col(f"`{c}`") for c in given]), add, schema, keeps=True)
