"""Packing: tokenised documents laid into sequences of balanced attention cost.

Every task packs the documents it reads, a bounded number of tokens at a time, so nothing is
shuffled and a repeated task makes the same sequences again. A document is cut at the sequence
length; its whole sequences are ready. The ends are dealt to as many sequences as their tokens
need: longest first, each to the sequence of lowest cost (a linear and a quadratic term per
piece) that has room for it. An end that fits nowhere whole is cut once more, so at most one
sequence's worth of padding is left per group of ends.
"""

from __future__ import annotations

import base64
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import tidy

LENGTH = 1024
#: Ends that are packed together: more give less padding and better balance.
GROUP = 4096
#: Cost of a piece of n tokens: n * LINEAR + n * n. The linear part of a transformer layer is
#: about as costly as attention to this many tokens.
LINEAR = 4096
#: Parts of texts that a task remembers.
MEMORY = 600_000


class TokenBytes:
    """Texts to token ids as little-endian 32-bit bytes, word by word.

    In the pattern of a byte-level vocabulary, a space or line break between two other
    characters always starts a new unit, so the parts in between are tokenised once and
    remembered. A text with white space next to white space is tokenised whole.
    """

    def __init__(self, ranks: str, pattern: str, end: int):
        import tiktoken

        pairs = map(str.split, ranks.splitlines())
        self.encode = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}).encode_ordinary
        self.end = int(end).to_bytes(4, "little")
        #: A part without its leading space, or with its leading line break: its ids.
        self.known: dict[str, bytes | None] = {}

    def ids(self, text: str) -> bytes:
        found = array("I", self.encode(text))
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def learn(self, parts: list[str]) -> None:
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        for p in parts:
            if p not in known:
                if p[:1] == "\n":
                    known[p] = None if len(p) == 1 or p[1].isspace() or p[-1].isspace() else self.ids(p)
                else:
                    known[p] = None if not p or p[0].isspace() or p[-1].isspace() else self.ids(f" {p}")

    def __call__(self, text: str) -> bytes:
        first, *parts = text.replace("\n", " \n").split(" ")
        known = self.known
        try:
            found = [known[p] for p in parts]
        except KeyError:
            self.learn(parts)
            found = [known[p] for p in parts]
        if not first or first[-1].isspace() or None in found:
            return self.ids(text) + self.end
        return self.ids(first) + b"".join(found) + self.end


def deal(lengths: np.ndarray, length: int = LENGTH, linear: float = LINEAR) -> list[tuple[int, int, int, int]]:
    """Pieces (end, start in the end, tokens, sequence) of ends shorter than ``length``.

    Descending, each to the cheapest sequence with room; ties go to the lower number.
    """
    bins = -(-int(lengths.sum()) // length)
    room, cost = np.full(bins, length, np.int64), np.zeros(bins, np.float64)
    pieces = []
    for end in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[end])
        while left:
            fits = np.where(room >= left, cost, np.inf)
            at = int(fits.argmin())
            size = left
            if room[at] < left:
                at = int(room.argmax())
                size = int(room[at])
            pieces.append((end, start, size, at))
            room[at] -= size
            cost[at] += size * (linear + size)
            start, left = start + size, left - size
    return pieces


def pack(documents: DataFrame, ranks: str, pattern: str, *, id_column: str = "doc_id", text: str = "text", end: int = 0,
         length: int = LENGTH, group: int = GROUP, linear: float = LINEAR) -> DataFrame:
    """One row per piece of a document; together the pieces of a sequence fill it.

    ``ranks`` (lines of a base64 token and its id) and ``pattern`` define a byte-level vocabulary
    whose units take at most one leading space; ``end`` follows every document. Columns: the id, ``start`` (its
    document's ids before the piece), ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` (in
    the sequence, without gaps from 0) and ``ids``, as little-endian unsigned 32-bit numbers.

    Every row of ``documents`` is packed, repeated ones too and whatever its id; a null text is
    empty and gives the end token alone. Other columns are ignored. An empty table gives none.
    """
    shared = documents.sparkSession.sparkContext.broadcast((ranks, pattern))  # one vocabulary, under 1 MB
    fields = documents.select(F.col(id_column).alias("doc_id")).schema.fields

    def pack_task(batches):
        tokens, task = TokenBytes(*shared.value, end), TaskContext.get().partitionId() << 40
        sequence, ends, out = 0, [], []

        def row(key, start, size, total, at, offset, ids):
            out.append((key, start, size, total, task + at, offset, ids))

        def flush():
            nonlocal sequence
            filled = {}
            for n, start, size, at in deal(np.array([len(x[3]) // 4 for x in ends], np.int64), length, linear):
                key, whole, total, ids = ends[n]
                row(key, whole + start, size, total, sequence + at, filled.get(at, 0), ids[4 * start: 4 * (start + size)])
                filled[at] = filled.get(at, 0) + size
            sequence += len(filled)
            ends.clear()

        def table():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens(text.as_py() or "")
                total = len(ids) // 4
                whole = total - total % length
                for start in range(0, whole, length):
                    row(key, start, length, total, sequence, 0, ids[4 * start: 4 * (start + length)])
                    sequence += 1
                if total > whole:
                    ends.append((key, whole, total, ids[4 * whole:]))
                if len(ends) >= group:
                    flush()
                if len(out) >= 8192:
                    yield table()
        if ends:
            flush()
        if out:
            yield table()

    kind = fields[0].dataType.simpleString()
    return documents.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        tidy(pack_task), f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, "
                   "sequence_id bigint, offset bigint, ids binary")
