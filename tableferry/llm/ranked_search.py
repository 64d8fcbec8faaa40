"""Ranked lexical search by MaxScore whose bounds also know pairs of terms.

``build_index`` cuts the documents into segments, one row each: the postings of all their terms,
packed. A search takes its queries in blocks. For a block the frequencies of its terms are summed over
all segments, and every segment's postings become impact lists with their largest impact; for
pairs of heavy terms of a query it makes intersection lists with the largest joint impact.

A query then visits a segment with an upper bound for each set of its terms: the sum of the largest
impacts, less what pairs save, because a document has both terms (at most the joint maximum), one of
them, or none. Terms that together cannot reach the score to beat are not searched for
candidates, and a segment that cannot is skipped. The score to beat starts as the k-th best of the
partial scores in the lists of all segments. Bounds only skip what cannot be in the result, which is exact.

Terms are compared as 64-bit hashes. Scores are whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableferry.llm.common import discard, kept, tidy
from tableferry.llm.hashing import Words, slices, word_table

TABLE = word_table(lambda b: b >= 128 or chr(b).isalnum(), lower=True)
TOP = 20
#: Words of documents in a segment; a longer document is a segment of its own.
SEGMENT_TERMS = 2_000_000
#: Different terms of the queries that are searched at once (a query is not divided).
BLOCK_TERMS = 200_000
#: Terms of a query, those with the largest weights, whose pairs have intersection lists.
PAIRED = 8
#: Parts in which the best documents of a query are brought together first.
SPREAD = 64
INDEX = "n_docs bigint, n_terms bigint, ids binary, known binary, lengths binary, terms binary, offsets binary, docs binary, counts binary"
LISTS = ("ids binary, known binary, terms binary, offsets binary, docs binary, impacts binary, pairs binary, joint binary,"
         " pair_offsets binary, pair_docs binary, pair_impacts binary")


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, none negative, in the fewest bytes each that hold the largest; the first byte tells how many."""
    kind = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def record(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
    fields = [field.split() for field in schema.split(",")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(name, kinds[kind]) for name, kind in fields]))


def build_index(documents: DataFrame, *, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments of the documents, written to the shared folder; every document with a term is in one.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. Texts that are
    null or have no term are left out. Rows with one id, or repeated rows, are documents of their own,
    and so are rows without an id. Other columns are ignored. An empty table has no segments.
    """
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, hashes, lengths, size = Words(TABLE), [], [], [], 0

        def segment() -> pa.RecordBatch:
            key, length, terms = pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(hashes)
            docs = np.repeat(np.arange(len(length)), length)
            order = np.argsort(terms, kind="stable")
            terms, docs = terms[order], docs[order]
            first = np.ones(len(terms), bool)
            first[1:] = (terms[1:] != terms[:-1]) | (docs[1:] != docs[:-1])
            begin = np.flatnonzero(first)
            counts, terms, docs = np.diff(np.append(begin, len(terms))), terms[begin], docs[begin]
            new = np.ones(len(terms), bool)
            new[1:] = terms[1:] != terms[:-1]
            for x in (ids, hashes, lengths):
                x.clear()
            return record([{
                "n_docs": len(length), "n_terms": int(length.sum()), "known": np.asarray(key.is_valid()).tobytes(),
                "ids": key.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), "lengths": packed(length),
                "terms": terms[new].tobytes(), "offsets": packed(np.append(np.flatnonzero(new), len(terms))),
                "docs": packed(docs), "counts": packed(counts)}], INDEX)

        for batch in slices(batches):
            found, starts = words(batch.column(1))
            length = np.diff(starts)
            some = length > 0
            if some.any():
                ids.append(batch.column(0).filter(pa.array(some)))
                hashes.append(found)
                lengths.append(length[some])
                size += len(found)
            if size >= SEGMENT_TERMS:
                yield segment()
                size = 0
        if size:
            yield segment()

    rows = documents.select(F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text}`"))
    return kept(rows.mapInArrow(tidy(index), INDEX), "index")


def query_terms(queries: DataFrame, id_column: str, text: str) -> DataFrame:
    """(item, term, n) of the queries; rows that agree in id and text are one, all texts of an id are one query."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(TABLE)
        for batch in slices(batches):
            found, starts = words(batch.column(1))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(found.view(np.int64))], names=["item", "term"])

    rows = queries.select(F.col(f"`{id_column}`").alias("item"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL").distinct()
    kind = rows.schema["item"].dataType.simpleString()
    return rows.mapInArrow(tidy(split), f"item {kind}, term bigint").groupBy("item", "term").agg(F.count("*").alias("n"))


@dataclass
class Block:
    """Queries that are searched together: sorted different terms, weights, and per query places of terms and repeats."""

    terms: np.ndarray
    weights: np.ndarray
    queries: list[tuple[np.ndarray, np.ndarray]]
    n_docs: int
    n_terms: int
    #: Pairs of places of terms, and per query the places of its pairs.
    pairs: np.ndarray
    own_pairs: list[np.ndarray]


def weight_of(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


def make_block(queries: list[tuple[np.ndarray, np.ndarray]], frequency: dict[int, int], n_docs: int, n_terms: int) -> Block:
    """``queries``: hashes of the different terms and how often each occurs; terms that no document has are left out."""
    terms = np.sort(np.array([t for t, n in frequency.items() if n], np.int64).view(np.uint64))
    weights = np.array([weight_of(n_docs, frequency[t]) for t in terms.view(np.int64).tolist()], np.int64)
    placed, listed, own = [], {}, []
    for hashes, repeats in queries:
        place = np.searchsorted(terms, hashes)
        there = np.array([bool(frequency.get(t)) for t in hashes.view(np.int64).tolist()], bool)
        place, repeats = place[there], repeats[there]
        order = np.lexsort((place, -(weights[place] * repeats)))
        place, repeats = place[order], repeats[order]
        placed.append((place, repeats))
        heavy = np.sort(place[:PAIRED][weights[place[:PAIRED]] > 0]).tolist()
        own.append(np.array([listed.setdefault((a, b), len(listed)) for i, a in enumerate(heavy) for b in heavy[i + 1:]], np.int64))
    return Block(terms, weights, placed, n_docs, n_terms, np.array(list(listed), np.int64).reshape(-1, 2), own)


def saturation(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's share of its weight, in whole numbers, given its count in documents of these lengths."""
    if 25 * int(lengths.max(initial=0)) * n_docs < 1 << 62:
        norm = 75 + 25 * lengths * n_docs // n_terms
    else:
        norm = np.array([75 + 25 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 12 * norm)


def impact_lists(row: dict, block: Block) -> dict:
    """A segment's impact lists of the block's terms, and its intersection lists of the block's pairs."""
    own = np.frombuffer(row["terms"], np.uint64)
    at = np.minimum(np.searchsorted(own, block.terms), len(own) - 1)
    here = np.flatnonzero(own[at] == block.terms)
    offsets, docs, counts, lengths = (unpacked(row[x]) for x in ("offsets", "docs", "counts", "lengths"))
    begin, size = offsets[at[here]], offsets[at[here] + 1] - offsets[at[here]]
    bounds = np.append(0, np.cumsum(size))
    take = np.repeat(begin - bounds[:-1], size) + np.arange(bounds[-1])
    docs, counts = docs[take], counts[take]
    impacts = saturation(counts, lengths[docs], block.n_docs, block.n_terms) * np.repeat(block.weights[here], size)
    # Intersections: one term's impacts by document, looked up for all its partners.
    place = np.full(len(block.terms), -1)
    place[here] = np.arange(len(here))
    pairs = np.flatnonzero((place[block.pairs] >= 0).all(axis=1)) if len(block.pairs) else np.zeros(0, np.int64)
    pairs = pairs[np.argsort(block.pairs[pairs, 0], kind="stable")] if len(pairs) else pairs
    dense, last = np.zeros(len(lengths), np.int64), None
    used, joint, pair_docs, pair_impacts = [], [], [], []
    for pair, (a, b) in zip(pairs.tolist(), place[block.pairs[pairs]].tolist(), strict=True):
        if a != last:
            if last is not None:
                dense[docs[bounds[last]: bounds[last + 1]]] = 0
            dense[docs[bounds[a]: bounds[a + 1]]], last = impacts[bounds[a]: bounds[a + 1]], a
        other = docs[bounds[b]: bounds[b + 1]]
        first = dense[other]
        both = np.flatnonzero(first)
        if len(both):
            sums = first[both] + impacts[bounds[b]: bounds[b + 1]][both]
            used.append(pair)
            joint.append(int(sums.max()))
            pair_docs.append(other[both])
            pair_impacts.append(sums)
    none = np.zeros(0, np.int64)
    return {
        "ids": row["ids"], "known": row["known"], "terms": packed(here), "offsets": packed(bounds), "docs": packed(docs), "impacts": packed(impacts),
        "pairs": packed(np.array(used, np.int64)), "joint": packed(np.array(joint, np.int64)),
        "pair_offsets": packed(np.append(0, np.cumsum([len(x) for x in pair_docs], dtype=np.int64))),
        "pair_docs": packed(np.concatenate([none, *pair_docs])), "pair_impacts": packed(np.concatenate([none, *pair_impacts]))}


class Segment:
    """A segment's lists, opened."""

    def __init__(self, row: dict, block: Block):
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
        self.offsets, self.docs, self.impacts = unpacked(row["offsets"]), unpacked(row["docs"]), unpacked(row["impacts"])
        self.place = np.full(len(block.terms), -1)
        terms = unpacked(row["terms"])
        self.place[terms] = np.arange(len(terms))
        self.largest = np.maximum.reduceat(self.impacts, self.offsets[:-1]) if len(terms) else np.zeros(0, np.int64)
        self.joint = np.zeros(len(block.pairs), np.int64)
        pairs = unpacked(row["pairs"])
        self.joint[pairs] = unpacked(row["joint"])
        self.pair_place = np.full(len(block.pairs), -1)
        self.pair_place[pairs] = np.arange(len(pairs))
        self.pair_offsets, self.pair_docs, self.pair_impacts = (unpacked(row[x]) for x in ("pair_offsets", "pair_docs", "pair_impacts"))

    def list_of(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.offsets[place], self.offsets[place + 1])
        return self.docs[part], self.impacts[part]

    def at_least(self, block: Block, query: int, top: int) -> np.ndarray:
        """Scores that ``top`` or fewer different documents reach: the best in the query's intersection lists and heavy lists."""
        terms, repeats = block.queries[query]
        best = np.zeros(len(self.ids), np.int64)
        for term, n in zip(terms[:PAIRED].tolist(), repeats[:PAIRED].tolist(), strict=True):
            if self.place[term] >= 0:
                docs, impacts = self.list_of(self.place[term])
                best[docs] = np.maximum(best[docs], n * impacts)
        for place in self.pair_place[block.own_pairs[query]].tolist():
            if place >= 0:
                part = slice(self.pair_offsets[place], self.pair_offsets[place + 1])
                docs = self.pair_docs[part]
                best[docs] = np.maximum(best[docs], self.pair_impacts[part])
        best = best[best > 0]
        return np.partition(best, len(best) - top)[-top:] if len(best) > top else best

    def bounds(self, block: Block, query: int, places: np.ndarray, terms: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Upper bounds of what the first 0, 1, 2, ... of these terms can give one document.

        Pairs are chosen by what they save, each term in one pair at most; a pair saves within
        every set that holds both of its terms.
        """
        largest = repeats * self.largest[places]
        sums = np.append(0, np.cumsum(largest))
        pairs = block.own_pairs[query]
        if len(pairs) and len(terms):
            # Terms that this segment does not have are marked; their pairs save nothing.
            at = np.full(len(block.terms), -1) if len(block.terms) < 4096 else None
            where = {t: i for i, t in enumerate(terms.tolist())} if at is None else None
            if at is not None:
                at[terms] = np.arange(len(terms))
                a, b = at[block.pairs[pairs, 0]], at[block.pairs[pairs, 1]]
            else:
                a, b = (np.array([where.get(t, -1) for t in block.pairs[pairs, k].tolist()], np.int64) for k in (0, 1))
            use = (a >= 0) & (b >= 0)
            a, b, joint = a[use], b[use], self.joint[pairs[use]]
            # With repeats, the joint maximum as often as the term that is repeated more.
            most = np.maximum(np.maximum(largest[a], largest[b]), np.maximum(repeats[a], repeats[b]) * joint)
            saved = largest[a] + largest[b] - most
            taken = set()
            for k in np.argsort(-saved, kind="stable").tolist():
                if saved[k] <= 0:
                    break
                if a[k] not in taken and b[k] not in taken:
                    taken.update((a[k], b[k]))
                    sums[max(a[k], b[k]) + 1:] -= saved[k]
        return sums

    def search(self, block: Block, query: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all that score ``bar``, which is over 0, or more."""
        terms, repeats = block.queries[query]
        here = self.place[terms] >= 0
        terms, repeats = terms[here], repeats[here]
        places = self.place[terms]
        order = np.argsort(repeats * self.largest[places], kind="stable")
        terms, repeats, places = terms[order], repeats[order], places[order]
        most = self.bounds(block, query, places, terms, repeats)
        # Of growing sets of terms, the last that cannot reach the bar by itself.
        idle = int(np.searchsorted(np.maximum.accumulate(most), bar, "left")) - 1
        if idle == len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores = np.zeros(len(self.ids), np.int64)
        for k in range(idle, len(terms)):
            docs, impacts = self.list_of(places[k])
            scores[docs] += repeats[k] * impacts
        found = np.flatnonzero(scores)
        for k in range(idle - 1, -1, -1):
            found = found[scores[found] + most[k + 1] >= bar]
            docs, impacts = self.list_of(places[k])
            if 8 * len(found) < len(docs):
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores[found] += np.where(docs[at] == found, repeats[k] * impacts[at], 0)
            else:
                scores[docs] += repeats[k] * impacts
        found = found[scores[found] >= bar]
        return found, scores[found]


def best_of(frame: DataFrame, order: list, top: int) -> DataFrame:
    """The first ``top`` rows of each ``place``, with their ``rank``; brought together in parts first, by the task they come from."""
    part = frame.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    ranked = lambda rows, *keys: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return ranked(ranked(part, "place", "part").drop("rank", "part"), "place")


def search(index: DataFrame, queries: DataFrame, top: int = TOP, *, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """The ``top`` best documents of the index for each query: id_column, rank, doc_id and score.

    Equal scores are ranked by doc_id, documents without an id last; documents that agree in both (rows with one id)
    have ranks of their own. Only scores above 0 count, so a query may have fewer rows, or none: one whose text is null,
    empty or has no term of the index. Terms count as often as the query repeats them. Rows of
    queries that agree in id and text are one; different texts of one id (null is one too) are one query. An empty index has no results.

    A block of queries (``BLOCK_TERMS`` different terms, or one longer query) is what each task holds beside one segment.
    """
    spark, context = index.sparkSession, index.sparkSession.sparkContext
    kind = queries.schema[id_column].dataType.simpleString()
    size = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")).first()
    terms = kept(query_terms(queries, id_column, text), "queries")
    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    terms = terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    found = []
    for number in range(blocks if size.docs else 0):
        # One block of queries at a time is brought here, to be sent to all tasks.
        rows = terms.where(F.col("block") == number).groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", "n"))).alias("terms")).collect()
        if not rows:
            continue
        asked = [(np.array([t.term for t in r.terms], np.int64).view(np.uint64), np.array([t.n for t in r.terms], np.int64)) for r in rows]
        frequency = document_frequencies(index, context.broadcast(np.unique(np.concatenate([hashes for hashes, _ in asked]))))
        block = context.broadcast(make_block(asked, frequency, size.docs, size.terms))
        ranked, lists = search_block(index, block, len(rows), top)
        names = spark.createDataFrame([(n, r.item) for n, r in enumerate(rows)], f"place int, `{id_column}` {kind}")
        found.append(kept(ranked.join(F.broadcast(names), "place").select(f"`{id_column}`", "rank", "doc_id", "score"), "ranked"))
        discard(lists)
    discard(terms)
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], f"`{id_column}` {kind}, rank int, doc_id bigint, score bigint")


def document_frequencies(index: DataFrame, wanted) -> dict[int, int]:
    """In how many documents each of the ``wanted`` (broadcast, sorted) terms is."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                terms, offsets = np.frombuffer(row["terms"], np.uint64), unpacked(row["offsets"])
                at = np.minimum(np.searchsorted(terms, wanted.value), len(terms) - 1)
                total += np.where(terms[at] == wanted.value, offsets[at + 1] - offsets[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted.value[some].view(np.int64)), pa.array(total[some])], names=["term", "n"])

    counted = index.select("terms", "offsets").mapInArrow(tidy(count), "term bigint, n bigint")
    return {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def search_block(index: DataFrame, block, n_queries: int, top: int) -> tuple[DataFrame, DataFrame]:
    """(place, rank, doc_id, score) of the block's queries, and the lists it reads them from."""
    def lists_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield record([impact_lists(batch.slice(at, 1).to_pylist()[0], block.value)], LISTS)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield Segment(batch.slice(at, 1).to_pylist()[0], block.value)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64)] * n_queries
        for segment in segments(batches):
            for n in range(n_queries):
                best[n] = np.sort(np.append(best[n], segment.at_least(block.value, n, top)))[-top:]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(n_queries, dtype=np.int32), [len(b) for b in best])), pa.array(np.concatenate(best))], names=["place", "score"])

    lists = kept(index.mapInArrow(tidy(lists_of), LISTS), "lists")
    ends = best_of(lists.mapInArrow(tidy(reached), "place int, score bigint"), [F.desc("score")], top).where(F.col("rank") == top)
    bars = np.ones(n_queries, np.int64)
    for row in ends.select("place", "score").collect():
        bars[row.place] = row.score
    bars = index.sparkSession.sparkContext.broadcast(bars)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bar = bars.value.copy()
        # Per query the best so far: without an id or not, id, score.
        best = [np.zeros((3, 0), np.int64)] * n_queries
        for segment in segments(batches):
            for n in range(n_queries):
                docs, scores = segment.search(block.value, n, int(bar[n]))
                if len(docs):
                    rows = np.hstack((best[n], np.array([~segment.known[docs], segment.ids[docs], scores], np.int64)))
                    best[n] = rows = rows[:, np.lexsort((rows[1], rows[0], -rows[2]))[:top]]
                    if rows.shape[1] == top:
                        bar[n] = max(bar[n], rows[2, -1])
        place = np.repeat(np.arange(n_queries, dtype=np.int32), [b.shape[1] for b in best])
        rows = np.hstack(best) if best else np.zeros((3, 0), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(rows[1], mask=rows[0] != 0), pa.array(rows[2])], names=["place", "doc_id", "score"])

    hits = lists.mapInArrow(tidy(find), "place int, doc_id bigint, score bigint")
    return best_of(hits, [F.desc("score"), F.asc_nulls_last("doc_id")], top), lists


def ranked_search(documents: DataFrame, queries: DataFrame, top: int = TOP, *, id_column: str = "doc_id", text: str = "text",
                  query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """``search`` over an index made for it and removed again."""
    index = build_index(documents, id_column=id_column, text=text)
    found = search(index, queries, top, id_column=query_id, text=query_text)
    discard(index)
    return found
