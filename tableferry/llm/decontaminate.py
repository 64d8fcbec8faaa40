"""Benchmark decontamination: exact windows of benchmark items found in documents.

A prefix-filtered set join. A window is a set of positioned shingles; for full containment its
prefix is one shingle, and the rarest is taken. Documents are joined to the prefix shingles by
hash; a match says where the window would have to begin (positional bound) and that it must fit
into the document (length bound), and then all words of the window are compared.

The benchmark is taken in blocks of bounded size. Each block is sent to all tasks, and the
documents, in one pass without a shuffle, add what they find to their row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import tidy
from tableferry.llm.hashing import Words, slices, windows, within, word_table

WINDOW = 13
SHINGLE = 3
#: Words of benchmark text per block: bounds what is sent to a task.
BLOCK_WORDS = 1_000_000


def _is_word(byte: int) -> bool:
    return byte >= 128 or chr(byte).isascii() and chr(byte).isalnum()


TABLE = word_table(_is_word, lower=True)


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, size, words) of every item, words as hashes."""
    def cut(batches):
        words = Words(TABLE)
        for batch in slices(batches):
            hashes, starts = words(batch.column(1))
            keys, sizes, found = [], [], []
            for key, a, b in zip(batch.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                size = min(window, b - a)
                for at in range(a, b - size + 1) if size else ():
                    keys.append(key)
                    sizes.append(size)
                    found.append(hashes[at: at + size].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sizes, pa.int32()), pa.array(found, pa.binary())],
                                             names=["item", "size", "words"])

    return items.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).mapInArrow(
        cut, "item string, size int, words binary").distinct()


class Block:
    """The windows of some items, found by their rarest shingle.

    Per shingle size: sorted shingle hashes ``keys`` and, for each, its run in ``window`` and
    ``place`` (the shingle's position in the window).
    """

    def __init__(self, rows: list[tuple[str, int, bytes]]):
        by_words: dict[bytes, list[str]] = {}
        for item, _, words in rows:
            by_words.setdefault(words, []).append(item)
        self.items = sorted({item for item, _, _ in rows})
        number = {item: n for n, item in enumerate(self.items)}
        self.owners = [np.array(sorted(number[i] for i in own), np.int64) for own in by_words.values()]
        self.words = [np.frombuffer(w, np.uint64) for w in by_words]
        shingles = [(min(SHINGLE, len(w)), windows(w, min(SHINGLE, len(w)))) for w in self.words]
        count: dict[tuple[int, int], int] = {}
        for size, hashes in shingles:
            for h in set(hashes.tolist()):
                count[size, h] = count.get((size, h), 0) + 1
        entries: dict[int, list[tuple[int, int, int]]] = {}
        for n, (size, hashes) in enumerate(shingles):
            rarest, place = min((count[size, h], h, at) for at, h in enumerate(hashes.tolist()))[1:]
            entries.setdefault(size, []).append((rarest, n, place))
        self.index = {}
        for size, found in entries.items():
            found.sort()
            hashes = np.array([x[0] for x in found], np.uint64)
            keys, first = np.unique(hashes, return_index=True)
            self.index[size] = (keys, np.append(first, len(found)), np.array([x[1] for x in found]), np.array([x[2] for x in found]))

    def find(self, hashes: np.ndarray, starts: np.ndarray):
        """(text, window, first word) of every occurrence."""
        ends = np.repeat(starts[1:], np.diff(starts))
        begins = np.repeat(starts[:-1], np.diff(starts))
        for size, (keys, first, window, place) in self.index.items():
            at = within(starts, size)
            found = windows(hashes, size)[at] if len(at) else np.zeros(0, np.uint64)
            # One bit per 16-bit hash part sorts out most positions before the search.
            seen = np.zeros(1 << 16, bool)
            seen[(keys >> np.uint64(48)).astype(np.int64)] = True
            near = np.flatnonzero(seen[(found >> np.uint64(48)).astype(np.int64)])
            at, found = at[near], found[near]
            slot = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            hit = np.flatnonzero(keys[slot] == found)
            for p, s in zip(at[hit].tolist(), slot[hit].tolist(), strict=True):
                for entry in range(first[s], first[s + 1]):
                    words = self.words[window[entry]]
                    begin = p - int(place[entry])
                    if begin >= begins[p] and begin + len(words) <= ends[p] and np.array_equal(hashes[begin: begin + len(words)], words):
                        yield int(np.searchsorted(starts, p, "right")) - 1, int(window[entry]), begin


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, into: str = "overlap",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents`` with one more column, a struct of ``n_words``, ``spans`` and ``items``.

    Words are runs of letters and digits (all characters beyond ASCII count), A-Z in lower
    case. A window is ``window`` consecutive words of an item, or all words of a shorter one.
    ``spans`` are the words (start, end) inside occurring windows, joined and in order;
    ``items`` are the ids, as sorted strings, of the items whose windows occur.

    All rows and columns of ``documents`` stay, repeated rows too; a column named ``into`` is
    replaced. A null or empty text has no words. Items without words or id have no windows;
    repeated items count once. Without items nothing is hit.
    """
    cut = item_windows(benchmark.where(F.col(item_id).isNotNull()), item_id, item_text, window)
    # Blocks by item, each of about block_words words; the driver holds one at a time.
    sizes = cut.agg(F.sum("size").alias("n")).first()["n"] or 0
    blocks = max(1, -(-sizes // (block_words * window)))
    kind = "struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, items: array<string>>"
    names = [c for c in documents.columns if c != into]
    found = documents.select(*names, F.lit(None).cast(kind).alias(into))
    spark = documents.sparkSession
    for number in range(blocks):
        rows = cut.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        shared = spark.sparkContext.broadcast(Block([tuple(r) for r in rows]))
        found = found.mapInArrow(tidy(_adder(shared, names.index(text), len(names))), found.schema)
    return found


def _adder(shared, text_at: int, into_at: int):
    def add(batches):
        words, block = Words(TABLE), shared.value
        for batch in slices(batches, text_at):
            hashes, starts = words(batch.column(text_at))
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            for n, w, begin in block.find(hashes, starts):
                start = begin - int(starts[n])
                spans.setdefault(n, []).append((start, start + len(block.words[w])))
                items.setdefault(n, set()).update(block.owners[w].tolist())
            before = batch.column(into_at)
            out = []
            for n, size in enumerate(np.diff(starts).tolist()):
                old = before[n].as_py() if before[n].is_valid else {"spans": [], "items": []}
                if n in spans:
                    old["spans"] = [{"start": a, "end": b} for a, b in _joined(spans[n] + [(x["start"], x["end"]) for x in old["spans"]])]
                    old["items"] = sorted({*old["items"], *(block.items[i] for i in items[n])})
                out.append(old | {"n_words": size})
            columns = [*batch.columns[:into_at], pa.array(out, before.type)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    return add
