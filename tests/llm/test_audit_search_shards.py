"""Filter audit, ranked search and sharding against plain versions, and on odd rows."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableferry.llm import queries, ranked_search as rs
from tableferry.llm.common import kept
from tableferry.llm.filter_audit import failing_ids, filter_audit, orders_of, text_filters
from tableferry.llm.sharding import MULTIPLIER, assign_shards, jump_shard, shard_slots, write_shards

from .conftest import LOWER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def jump(key, shards):
    key, at, coming = key % 2**64, -1, 0
    while coming < shards:
        at, key = coming, (key * MULTIPLIER + 1) % 2**64
        coming = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 300])
def test_jump_equals_the_published_loop(spark, shards):
    draw = random.Random(shards)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(draw.randrange(-(2**63), 2**63) for _ in range(400))]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            frame = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", jump_shard(F.col("k"), shards).alias("s"))
            assert {r.k: r.s for r in frame.collect()} == {k: jump(k, shards) for k in keys}
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_one_more_shard_takes_only_what_it_needs(spark):
    rows = assign_shards(spark.range(30_000).withColumnRenamed("id", "doc_id"), 9, grown_into="later").collect()
    moved = [r for r in rows if r.shard != r.later]
    assert all(r.later == 9 for r in moved) and abs(len(moved) - 3000) < 200
    assert all(abs(n - 30_000 / 9) < 300 for n in Counter(r.shard for r in rows).values())


def test_shards_of_odd_rows(spark, odd, nothing, tmp_path):
    rows = shard_slots(odd, 3).collect()
    assert len(rows) == odd.count()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.shard == jump(r.doc_id or 0, 3) and r.grown_shard == jump(r.doc_id or 0, 4)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(1, 0)}
    assert shard_slots(nothing).count() == 0
    # A third of all rows with one id: its rows span partitions, slots stay gapless.
    hot = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).cast("bigint").alias("doc_id"), F.lit("same").alias("text")).repartition(5)
    slots = [r.slot for r in shard_slots(hot, 1).collect()]
    assert sorted(slots) == list(range(3000))
    write_shards(odd, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((str(r.doc_id), r.shard) for r in back.collect()) == sorted((str(r.doc_id), r.shard) for r in rows)
    # Keys of other types are hashed; a column with the new name is replaced.
    named = assign_shards(spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "doc_id string, shard string"), 8).collect()
    assert named[0].shard == named[1].shard and named[2].shard == 0


def test_sharding_runs_no_python(spark, tiny):
    plan = queries.op13(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def audit_of(rows, fails, good):
    """rows: (part, failed letters, id); the plain audit."""
    names, found = sorted(fails), {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in itertools.permutations(names):
            left = own
            for step, f in enumerate(order, start=1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                found[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own), sum(r[2] in good for r in gone), f]
        for key in [k for k in found if k[0] == part]:
            found[key][-1] = shapley[found[key][-1]]
    return {k: tuple(v) for k, v in found.items()}


@pytest.mark.parametrize("n", [1, 3, 4])
def test_audit_equals_a_plain_one(spark, n):
    draw = random.Random(n)
    letters = "PQRS"[:n]
    rows = [(i if i % 9 else None, draw.choice(["x", "y", None]), "".join(c for c in letters if draw.random() < 0.4), f"text {i}") for i in range(300)]
    # A source with a third of all rows, and ids that repeat with other texts.
    rows += [(i % 40, "hot", draw.choice(["", letters]), f"more {i}") for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, failed string, text string").repartition(4)
    failing = failing_ids(frame, {c: F.col("failed").contains(c) for c in letters})
    good = spark.createDataFrame([(i,) for i in [*range(0, 300, 2), 4, None, 10_000]], "doc_id bigint")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley)
           for r in filter_audit(failing, {"good": good}).collect()}
    assert got == audit_of([(p or "", set(f), i) for i, p, f, _ in rows], letters, {*range(0, 300, 2)})
    assert len(orders_of(list(letters))) == n * math.factorial(n)


def test_audit_of_odd_rows(spark, odd, nothing):
    rows = odd.withColumn("source", F.when(F.col("doc_id") > 5, "s"))
    failing = failing_ids(rows, text_filters(), repeats="E")
    # Equal texts: 2 has that of 1 (both empty), 6 that of 5; rows with one id do not fail for each other.
    assert sorted(r.doc_id for r in failing.tables["E"].collect()) == [2, 6]
    found = filter_audit(failing, {"good": rows.where("doc_id = 5").select("doc_id"), "toxic": rows.where("false").select("doc_id")})
    assert found.count() == 2 * 120 * 5 and found.select(F.min("kept"), F.max("toxic_lost")).first() == (0, 0)
    assert found.where("removed + redundant > 0 AND part = ''").count() > 0
    assert filter_audit(failing_ids(nothing.withColumn("source", F.lit("")), text_filters(), repeats="E")).count() == 0
    # Nothing fails: all rows stay, and zeros are there.
    easy = filter_audit(failing_ids(rows, {"A": F.lit(None).cast("boolean"), "B": F.lit(False)}))
    assert easy.count() == 2 * 2 * 2 and easy.agg(F.sum("removed"), F.sum("shapley")).first() == (0, 0)
    with pytest.raises(ValueError):
        failing_ids(rows, {c: F.lit(True) for c in "ABCDEFGH"})


def ranking(documents, query, top):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in documents]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    scores = []
    for i, bag in bags:
        m = 75 + 25 * sum(bag.values()) * n_docs // n_terms
        score = sum(q * rs.weight_of(n_docs, sum(t in b for _, b in bags)) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
                    for t, q in Counter(TERM.findall((query or "").translate(LOWER))).items() if bag[t])
        if score:
            scores.append((-score, i is None, i or 0))
    return [(rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:top], start=1)]


@pytest.mark.parametrize("segment,block", [(60, 5), (2_000, 40), (2_000_000, 200_000)])
def test_search_equals_brute_force(spark, monkeypatch, segment, block):
    monkeypatch.setattr(rs, "SEGMENT_TERMS", segment)
    monkeypatch.setattr(rs, "BLOCK_TERMS", block)
    draw = random.Random(segment)
    vocabulary = [f"w{n}" for n in range(60)] + ["É", "straße", "a1"]
    often = [1 / (n + 1) for n in range(len(vocabulary))]
    documents = [(i, " ".join(draw.choices(vocabulary, often, k=draw.randrange(0, 40)))) for i in range(400)]
    documents += [(i, "W3 w3, w7") for i in range(500, 560)] + [(3, "w9 w9 w50"), (None, "w50 w51"), (None, None), (700, ""), (701, " ".join(["w5"] * 900))]
    asked = [(n, " ".join(draw.choices(vocabulary, k=draw.randrange(1, 14)))) for n in range(12)]
    asked += [(50, "w3 w3 w3 w7"), (51, None), (52, ""), (53, "unknown"), (54, "w0"), (55, "W50 w51 É")]
    frame = spark.createDataFrame(documents, "doc_id bigint, text string").withColumn("score", F.lit(1)).repartition(3)
    items = spark.createDataFrame([*asked, asked[0]], "item_id bigint, text string")
    got = {}
    for r in rs.ranked_search(frame, items, 7).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    for item, text in asked:
        assert got.get(item, []) == ranking(documents, text, 7), (item, text)


def test_bounds_of_pairs_hold_and_tighten(spark):
    draw = random.Random(3)
    # Two terms that no document has together, and others at random.
    documents = [(i, " ".join([["left", "right"][i % 2]] * draw.randrange(1, 5) + draw.choices(["a", "b", "c", "d"], k=8))) for i in range(200)]
    index = rs.build_index(spark.createDataFrame(documents, "doc_id bigint, text string").coalesce(1))
    row = index.collect()[0].asDict()
    words = ["left", "right", "a", "b"]
    hashes = np.sort(rs.Words(rs.TABLE)(pa.array([" ".join(words)]))[0])
    terms, offsets = np.frombuffer(row["terms"], np.uint64), rs.unpacked(row["offsets"])
    at = np.searchsorted(terms, hashes)
    frequency = dict(zip(hashes.view(np.int64).tolist(), (offsets[at + 1] - offsets[at]).tolist(), strict=True))
    block = rs.make_block([(hashes, np.array([1, 2, 1, 1]))], frequency, row["n_docs"], row["n_terms"])
    segment = rs.Segment(rs.impact_lists(row, block), block)
    own, repeats = block.queries[0]
    order = np.argsort(repeats * segment.largest[segment.place[own]], kind="stable")
    own, repeats = own[order], repeats[order]
    most = segment.bounds(block, 0, segment.place[own], own, repeats)
    independent = np.append(0, np.cumsum(repeats * segment.largest[segment.place[own]]))
    scores = np.zeros(len(segment.ids), np.int64)
    for k, (term, n) in enumerate(zip(own.tolist(), repeats.tolist(), strict=True)):
        docs, impacts = segment.list_of(segment.place[term])
        scores[docs] += n * impacts
        assert scores.max() <= most[k + 1] <= independent[k + 1]
    assert most[-1] < independent[-1]
    # A bar that nothing reaches skips the segment; each lower one finds all that reach it.
    assert len(segment.search(block, 0, int(most[-1]) + 1)[0]) == 0
    for bar in sorted(set(scores.tolist()))[1::7]:
        assert set(segment.search(block, 0, bar)[0].tolist()) == set(np.flatnonzero(scores >= bar).tolist())
    assert sorted(segment.at_least(block, 0, 20))[-1] <= scores.max()


def test_search_of_empty_tables(spark, odd, nothing):
    items = spark.createDataFrame([("q", "same text")], "item_id string, text string")
    assert rs.ranked_search(nothing, items).count() == 0
    found = rs.ranked_search(odd, items.where("false"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    rows = rs.ranked_search(odd, items).collect()
    assert [(r.rank, r.doc_id) for r in rows if r.doc_id in (5, 6)] == [(1, 5), (2, 5), (3, 6)]


def test_large_counts_do_not_overflow():
    lengths, counts = np.array([3_000_000, 5]), np.array([10**6, 1])
    n_docs, n_terms = 2 * 10**11, 10**14
    norm = [75 + 25 * n * n_docs // n_terms for n in lengths.tolist()]
    assert rs.saturation(counts, lengths, n_docs, n_terms).tolist() == [10**9 * c // (1000 * c + 12 * m) for c, m in zip(counts.tolist(), norm, strict=True)]


def test_discarded_files_are_gone(spark):
    from tableferry.llm.common import discard

    frame = kept(spark.range(5), "spare")
    files = frame.inputFiles()
    discard(frame)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(files[0].rsplit("/", 1)[0]).count()
