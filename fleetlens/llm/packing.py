"""Best-fit packing of tokenised documents into sequences of a fixed length.

Three steps.  ``pieces`` tokenises every text and cuts what is longer than a
sequence; the result is stored, as tokenising is the dear part.  ``pack`` reads the
stored pieces in streams of a bounded number of tokens, each a run of input splits;
no row is shuffled.  A stream packs online into a fixed number of open sequences: a
bitset has one bit for each amount of free space that an open sequence has, so the
tightest sequence that still takes a piece is the lowest set bit from the piece's
length on.  Where none takes it and all places are used, the fullest closes first.
"""

from __future__ import annotations

import json
import math
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.llm.common import stored, tidy

#: Tokens of a sequence.
LIMIT = 1024
#: Open sequences of a stream.
OPEN = 4096
#: Tokens that a stream has about at least (more if its last input split goes over).
STREAM = 1 << 24
#: A place where the tokenizer's words always end: one blank between two marks that are no white space.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: How byte-level BPE splits text into words (a fixed value of that tokenizer kind, in its backtracking-free form).
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_SLICE = 1 << 20


def _byte_alphabet() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def fast_encoder(path: str):
    """An encoder with the same ids from the file's merges, or None if it holds more than plain byte-level BPE.

    Plain: no normaliser, no prefix blank, and merges in the order of their results' ids.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if (spec.get("normalizer") or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges")
            or (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) != ("ByteLevel", False, True)):
        return None
    joins = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in joins]
    sign = _byte_alphabet()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    words = {w: i for w, i in model["vocab"].items() if w not in added}
    if any(x >= y for x, y in zip(made, made[1:])) or len(words) != len(joins) + 256 or not all(c in words for c in sign):
        return None
    import tiktoken
    ranks = {bytes(sign[c] for c in w): i for w, i in words.items()}
    return tiktoken.Encoding("file", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to its ids, little-endian unsigned 32-bit; one for all tasks of a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(path)
    added = [t.content for t in full.get_added_tokens_decoder().values()]
    fast = fast_encoder(path)

    def encode(text: str) -> bytes:
        if fast is None or any(t in text for t in added):
            return np.array(full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(np.array(fast(part), "<u4").tobytes() for part in _slices(text))
    return encode


def _slices(text: str) -> Iterator[str]:
    """The text in slices of about a million characters, cut only where words of the tokenizer end."""
    at = 0
    while len(text) - at > 2 * _SLICE:
        cut = _BETWEEN.search(text, at + _SLICE)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT,
           end: int = 2) -> DataFrame:
    """doc_id, piece int (from 0), start long, length long, ids binary: every text's ids and the end id.

    A document of more than ``limit`` ids is cut into pieces of ``limit``, of which the
    first may be shorter.  A NULL or empty text has the end id alone; equal rows and rows
    without an id are documents of their own; their ids keep type and value.  ``ids`` holds
    little-endian unsigned 32-bit numbers.  ``path``: a tokenizer file that every worker
    can read.  No shuffle.
    """
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    last, wide = np.array([end], "<u4").tobytes(), 4 * limit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            row, nr, start, ids, held = [], [], [], [], 0
            for k, t in enumerate(b.column(1)):
                x = encode(t.as_py() or "") + last
                at = [0, *range((len(x) - 4) % wide + 4, len(x) + 1, wide)]
                row += [k] * (len(at) - 1)
                nr += range(len(at) - 1)
                start += [i // 4 for i in at[:-1]]
                ids += [x[i:j] for i, j in zip(at, at[1:])]
                held += len(x)
                if held > 1 << 24 or k == len(b) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row, pa.int64())), pa.array(nr, pa.int32()), pa.array(start, pa.int64()),
                         pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                        names=["doc_id", "piece", "start", "length", "ids"])
                    row, nr, start, ids, held = [], [], [], [], 0

    return rows.mapInArrow(tidy(run), T.StructType([
        T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]))


class OpenSequences:
    """A fixed number of open sequences, found by their free space."""

    def __init__(self, limit: int, places: int):
        self.limit, self.places = limit, places
        self.bits, self.used, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(limit + 1)]

    def _take(self, free: int) -> int:
        at = self.by_free[free]
        found = at.pop()
        if not at:
            self.bits ^= 1 << free
        self.used -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of ``length`` tokens."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.limit, self.made
            self.made += 1
        left = free - length
        if left:
            if self.used == self.places:
                # The fullest closes; that may be the one just filled.
                fullest = (self.bits & -self.bits).bit_length() - 1
                if left <= fullest:
                    return sequence, self.limit - free
                self._take(fullest)
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(sequence)
            self.used += 1
        return sequence, self.limit - free


def pack(cut: DataFrame, limit: int = LIMIT, places: int = OPEN, stream: int = STREAM, length: str = "length") -> DataFrame:
    """``cut`` with sequence_id long and offset long: rows of one sequence lie there gapless from 0.

    ``cut`` holds the pieces as ``pieces`` returns them, stored (its rows are read twice and
    must come in the same order again).  Each Arrow batch of a stream is packed longest
    first.  A stream leaves at most ``places`` sequences that are not full; the number of
    streams follows the tokens, so that is a bounded share of all sequences.  An empty
    table gives an empty result; lengths under 1 or above ``limit`` are an error.
    """
    total = cut.agg(F.sum(length)).first()[0] or 0
    at = cut.columns.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        sequences = OpenSequences(limit, places)
        for b in batches:
            n = b.column(at).to_numpy(zero_copy_only=False)
            if len(n) and not (1 <= n.min() and n.max() <= limit):
                raise ValueError("a piece must have 1 token at least and fit in a sequence")
            where = np.empty((len(n), 2), np.int64)
            for k in np.argsort(-n, kind="stable").tolist():
                where[k] = sequences.put(int(n[k]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(where[:, 0] + base), pa.array(where[:, 1])],
                                             names=[*b.schema.names, "sequence_id", "offset"])

    fields = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return cut.coalesce(max(1, math.ceil(total / stream))).mapInArrow(run, fields)


def sequences(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = 2,
              places: int = OPEN, stream: int = STREAM) -> DataFrame:
    """Every document's pieces with their ids and their place: doc_id, piece, start, length, ids, sequence_id, offset."""
    return pack(stored(pieces(docs, path, doc_id, text, limit, end)), limit, places, stream)
