"""Language-model scores from a sharded Elias-Fano bigram trie.

A task reads documents in chunks, hashes their words and sends, to every shard of the word and
word-pair space, the sorted distinct hashes it has seen and how often they occur in training
texts. A shard adds up what all chunks sent. It lays its pairs out as a trie in a memory-mapped
file: the contexts, monotone pointers to their followers, and the followers, each level an Elias-Fano
sequence, with an 8-bit code per pair for its count in the smoothed log-probability. It looks up the pairs of
each chunk (context, then successor within the context's followers) and answers with codes, the
few counts that are beyond the codes, and word counts. A chunk, which sent itself its own words along, then scores its documents.

Everything a task holds is bounded by the chunk or the shard; a frequent word or pair costs each
chunk one entry. Nothing but the number of tokens reaches the driver.

The model: P(w | v) = (C(v, w) + WEIGHT * P(w)) / (C(v) + WEIGHT), where P(w) is the smoothed
share of the word alone and C(v, w) is the pair's count as its code tells it. A count beyond the
largest code's is kept as it is, so the error is the same for any size of corpus.
"""

from __future__ import annotations

import json
import mmap
import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import tidy
from tableferry.llm.elias_fano import EliasFano
from tableferry.llm.hashing import SPACES, Words, mixed, slices, word_table

TABLE = word_table(lambda b: b not in SPACES, lower=True)
#: Hashes of the tokens that are no words.
END, BEGIN = np.uint64(0xE2D0C0DE5EED0001), np.uint64(0xBE61C0DE5EED0002)
PRIOR = 0.1
#: How many observations of a context the single-word distribution weighs.
WEIGHT = 30.0
CHUNK_TOKENS = 3_000_000
#: Bytes of text per shard.
SHARD_BYTES = 1 << 25
#: Counts up to this have a code of their own; larger ones share codes, 5 % apart, up to the last level.
EXACT = 100
LEVELS = np.concatenate((np.arange(EXACT + 1), EXACT * 1.05 ** np.arange(1, 256 - EXACT)))
ROWS = "target bigint, chunk bigint, kind string, body binary"
LIMIT = 1 << 64
#: Bits of a pair's number below those of its context.
PAIR_BITS = np.uint64(40)
OWN = np.uint64((1 << 40) - 1)


def code_of(counts: np.ndarray) -> np.ndarray:
    """8-bit codes of counts, of the nearest level on a logarithmic scale."""
    bounds = np.sqrt(np.maximum(LEVELS[1:-1], 1) * LEVELS[2:])
    return np.where(counts > 0, 1 + np.searchsorted(bounds, counts, "right"), 0).astype(np.uint8)


def pack(**parts) -> bytes:
    """Arrays and byte strings under names, compressed where that helps."""
    head, bodies = {}, []
    for name, part in parts.items():
        raw, kind = (part, "") if isinstance(part, bytes) else (part.tobytes(), part.dtype.str)
        body = zlib.compress(raw, 1) if kind else raw
        head[name] = (kind, len(body))
        bodies.append(body)
    lead = json.dumps(head).encode()
    return len(lead).to_bytes(4, "little") + lead + b"".join(bodies)


def unpack(block: bytes) -> dict:
    size = int.from_bytes(block[:4], "little")
    at, out = 4 + size, {}
    for name, (kind, length) in json.loads(block[4: at]).items():
        body = block[at: at + length]
        out[name] = np.frombuffer(zlib.decompress(body), kind) if kind else body
        at += length
    return out


def pair_of(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Pairs as numbers that their contexts sort: the context's first bits, then a hash of both words whole.

    Words that share some bits share no pairs by that. As many as a million million different pairs, or a context
    of a thousand million followers, leave a share of under 1 in 1,000 of them with another's number.
    """
    return (before >> PAIR_BITS << PAIR_BITS) | (mixed(mixed(before) + word) >> np.uint64(64 - PAIR_BITS))


class Chunk:
    """The tokens of some documents as places in their distinct words, and their distinct pairs."""

    def __init__(self, words: np.ndarray, place: np.ndarray, sizes: np.ndarray):
        self.words, self.place, self.sizes = words, place, sizes
        first = np.cumsum(sizes) - sizes
        known = np.append(words, BEGIN)
        before = np.empty(len(place), np.int64)
        before[1:] = place[:-1]
        before[first] = len(words)
        self.before = before
        self.pairs, self.pair_place = np.unique(pair_of(known[before], known[place]), return_inverse=True)

    def by_shard(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each shard's words begin, the pairs' order by shard, and where theirs begin."""
        of = lambda hashes: ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        own = of(mixed(self.pairs))
        order = np.argsort(own, kind="stable")
        edges = np.arange(shards + 1)
        return np.searchsorted(of(self.words), edges), order, np.searchsorted(own[order], edges)


def send(shards: int):
    """Documents (doc_id, text, training) to the rows that a chunk sends."""
    def run(batches):
        words, task, number = Words(TABLE), TaskContext.get().partitionId() << 24, 0
        tokens, sizes, ids, training, held = [], [], [], [], 0

        def rows():
            nonlocal number
            flat = np.concatenate(tokens)
            distinct, place = np.unique(flat, return_inverse=True)
            size = np.concatenate(sizes)
            chunk = Chunk(distinct, place, size)
            train = np.concatenate(training)
            weight = np.repeat(train, size).astype(np.float64)
            count = np.bincount(place, weight, len(distinct)).astype(np.uint32)
            pair_count = np.bincount(chunk.pair_place, weight, len(chunk.pairs)).astype(np.uint32)
            at, order, pair_at = chunk.by_shard(shards)
            out = []
            for n in range(shards):
                own, pairs = slice(at[n], at[n + 1]), order[pair_at[n]: pair_at[n + 1]]
                out.append((n, "ask", pack(words=EliasFano.encode(distinct[own], LIMIT), counts=count[own],
                                           pairs=EliasFano.encode(chunk.pairs[pairs], LIMIT), pair_counts=pair_count[pairs])))
            # The chunk's own tokens travel with the questions, so that they are answered in one place.
            key, data = task + number, pa.ipc.new_stream
            sink = pa.BufferOutputStream()
            with data(sink, pa.schema([("id", ids[0].type)])) as writer:
                for part in ids:
                    writer.write_batch(pa.RecordBatch.from_arrays([part], names=["id"]))
            out.append((key % shards, "self", pack(
                words=EliasFano.encode(distinct, LIMIT), place=place.astype(np.uint32), sizes=size.astype(np.int32),
                training=train, ids=sink.getvalue().to_pybytes())))
            number += 1
            for x in (tokens, sizes, ids, training):
                x.clear()
            for target, kind, body in out:  # one row at a time: a batch of all would be a copy of the chunk
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([key]), pa.array([kind]), pa.array([body], pa.binary())],
                                                 names=["target", "chunk", "kind", "body"])

        for batch in slices(batches):
            hashes, starts = words(batch.column(1))
            # One end after each text's words.
            ends = starts[1:] + np.arange(batch.num_rows)
            flat = np.full(len(hashes) + batch.num_rows, END, np.uint64)
            inside = np.ones(len(flat), bool)
            inside[ends] = False
            flat[inside] = hashes
            tokens.append(flat)
            sizes.append(np.diff(starts) + 1)
            ids.append(batch.column(0))
            training.append(np.asarray(batch.column(2).fill_null(False)))
            held += len(flat)
            if held >= CHUNK_TOKENS:
                yield from rows()
                held = 0
        if held:
            yield from rows()

    return run


class Trie:
    """Contexts and their followers, memory-mapped; every level is an Elias-Fano sequence.

    A context is told by the first bits of its hash; of two that share them, the followers lie
    between the same pointers and stay different by their own bits.
    """

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        contexts, first = np.unique(pairs >> PAIR_BITS, return_index=True)
        pointers = np.append(first, len(pairs)).astype(np.uint64)
        # A follower is stored relative to its context's number, which keeps the level ascending.
        number = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(pointers.astype(np.int64)))
        followers = (number << PAIR_BITS) | (pairs & OWN)
        blocks = [EliasFano.encode(contexts, LIMIT >> int(PAIR_BITS)), EliasFano.encode(pointers, len(pairs) + 1),
                  EliasFano.encode(followers, max(1, len(contexts)) << int(PAIR_BITS)), code_of(counts).tobytes()]
        self.file = tempfile.TemporaryFile()  # has no name, so it goes with the task
        starts = []
        for block in blocks:
            self.file.write(b"\0" * (-self.file.tell() % 8))
            starts.append(self.file.tell())
            self.file.write(block)
        self.file.write(b"\0")
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        self.contexts, self.pointers, self.followers = (EliasFano(self.map, at) for at in starts[:3])
        self.codes = np.frombuffer(self.map, np.uint8, len(pairs), starts[3])
        #: Places and counts of the pairs beyond the last level: at most one per so many tokens.
        self.far = np.flatnonzero(counts > LEVELS[-1])
        self.far_counts = counts[self.far].astype(np.int64)

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of pairs, 0 for those that training has not seen; which are beyond the codes, and their counts."""
        context = self.contexts.find(pairs >> PAIR_BITS)
        out = np.zeros(len(pairs), np.uint8)
        known = np.flatnonzero(context >= 0)
        if not len(known):
            return out, known.astype(np.uint32), known.astype(np.int64)
        context = context[known]
        # The successor is searched among the context's own followers.
        low, high = (self.pointers.access(context + k).astype(np.int64) for k in (0, 1))
        at = self.followers.find((context.astype(np.uint64) << PAIR_BITS) | (pairs[known] & OWN), low, high)
        hit = at >= 0
        known, at = known[hit], at[hit]
        out[known] = self.codes[at]
        beyond = np.isin(at, self.far)
        return out, known[beyond].astype(np.uint32), self.far_counts[np.searchsorted(self.far, at[beyond])]


def answer(table: pa.Table) -> pa.Table:
    """All rows sent to one shard, to the answers for every chunk; rows of kind self pass."""
    keys, kinds, bodies = (table.column(n).combine_chunks() for n in (1, 2, 3))
    asked, out = [], {"target": [], "chunk": [], "kind": [], "body": []}

    def row(chunk, kind, body):
        for name, value in zip(out, (chunk, chunk, kind, body), strict=True):
            out[name].append(value)

    for key, kind, body in zip(keys.to_pylist(), kinds.to_pylist(), bodies, strict=True):
        if kind == "self":
            row(key, kind, body.as_py())
        else:
            asked.append((key, unpack(body.as_py())))

    def total(name, counts):
        values = np.concatenate([EliasFano(a[name]).values() for _, a in asked])
        count = np.concatenate([a[counts] for _, a in asked]).astype(np.int64)
        distinct, place = np.unique(values, return_inverse=True)
        summed = np.bincount(place, count, len(distinct)).astype(np.int64)
        return distinct, summed

    if asked:
        words, counts = total("words", "counts")
        pairs, pair_counts = total("pairs", "pair_counts")
        seen = pair_counts > 0
        trie = Trie(pairs[seen], pair_counts[seen])
        for key, own in asked:
            found = counts[np.searchsorted(words, EliasFano(own["words"]).values())] if len(words) else counts
            codes, far, far_counts = trie.look_up(EliasFano(own["pairs"]).values())
            row(key, "answer", pack(shard=np.array(table.column(0)[0].as_py()), counts=found, codes=codes, far=far, far_counts=far_counts,
                                    totals=np.array([counts.sum(), (counts > 0).sum()])))
    return pa.Table.from_pydict(out, schema=pa.schema([("target", pa.int64()), ("chunk", pa.int64()), ("kind", pa.string()), ("body", pa.binary())]))


def finish(shards: int, prior: float, weight: float):
    """What a chunk sent itself and all answers to it, to the scores of its documents."""
    def run(table: pa.Table) -> pa.Table:
        answers, own = {}, None
        for kind, body in zip(table.column(2).to_pylist(), table.column(3), strict=True):
            found = unpack(body.as_py())
            if kind == "self":
                own = found
            else:
                answers[int(found["shard"].item())] = found
        if own is None or len(answers) != shards:
            raise RuntimeError("a chunk of documents changed between two runs of one task")
        chunk = Chunk(EliasFano(own["words"]).values(), own["place"].astype(np.int64), own["sizes"].astype(np.int64))
        _, order, _ = chunk.by_shard(shards)
        parts = [answers[n] for n in range(shards)]
        counts = np.concatenate([p["counts"] for p in parts]).astype(np.float64)
        seen = np.zeros(len(chunk.pairs), np.float64)
        at = 0
        for p in parts:
            own_pairs = order[at: at + len(p["codes"])]
            seen[own_pairs] = LEVELS[p["codes"]]
            seen[own_pairs[p["far"]]] = p["far_counts"]
            at += len(own_pairs)
        tokens, types = np.sum([p["totals"] for p in parts], axis=0).tolist()
        alone = (counts + prior) / (tokens + prior * (types + 1))
        # A text begins as often as one ends.
        context = np.append(counts, counts[np.searchsorted(chunk.words, END)])
        single = np.log10(alone)[chunk.place]
        both = np.log10((seen[chunk.pair_place] + weight * alone[chunk.place]) / (context[chunk.before] + weight))
        starts = np.cumsum(chunk.sizes) - chunk.sizes
        ids = pa.ipc.open_stream(own["ids"]).read_all().column(0)
        add = lambda values: pa.array(np.add.reduceat(values, starts))
        return pa.table({
            "doc_id": ids, "training": pa.array(own["training"]), "n_tokens": pa.array(chunk.sizes),
            "n_known": add((counts[chunk.place] > 0).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(starts), tokens, np.int64)), "base_score": add(single), "score": add(both)})

    return run


def score_texts(documents: DataFrame, training: Column, *, id_column: str = "doc_id", text: str = "text",
                prior: float = PRIOR, weight: float = WEIGHT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, training, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows where ``training`` holds (null: not) and scores all. Tokens
    are the words between white space (A-Z in lower case), then one end. ``n_known`` counts
    tokens that occur in training texts, ``train_tokens`` all tokens of training texts;
    ``base_score`` and ``score`` are log10 probabilities of the text, by single words and by
    the model.

    All rows are scored, repeated ones too and whatever their id; a null or empty text is the
    end alone. Other columns are ignored. Without training rows all words are equally likely.
    An empty table gives an empty table.
    """
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), training.alias("training"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        rows.mapInArrow(tidy(send(shards)), ROWS)
        .groupBy("target").applyInArrow(answer, ROWS)
        .groupBy("chunk").applyInArrow(finish(shards, prior, weight), f"doc_id {kind}, training boolean, n_tokens bigint, "
                                       "n_known bigint, train_tokens bigint, base_score double, score double")
    )
