"""Groups of the similarity join: blocks, crowded signatures, ids with several texts, cuts by chance."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableferry.llm import ngram_join as nj

from .test_brute_force import brute_groups


def family(rnd, n, size, edits):
    base = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
    for _ in range(n):
        own = list(base)
        for _ in range(edits):
            own[rnd.randrange(size)] = f"e{rnd.randrange(10**6)}"
        yield " ".join(own)


@pytest.mark.parametrize("block,few", [(300_000, 100), (700, 100), (700, 3), (60, 1)])
def test_groups_in_blocks_and_crowds(spark, monkeypatch, block, few):
    """Families around the bar, of unlinked near copies, and one that all tasks' blocks share."""
    for name, value in {"BLOCK_ELEMENTS": block, "FEW": few, "CHUNK_TEXTS": 20, "SHARD_SIGNATURES": 3_000, "TIED_SETS": 30}.items():
        monkeypatch.setattr(nj, name, value)
    rnd = random.Random(block + few)
    texts = [t for n, size, edits in ((40, 60, 1), (25, 60, 2), (20, 80, 4), (12, 9, 1), (6, 30, 0)) for t in family(rnd, n, size, edits)]
    rnd.shuffle(texts)
    rows = nj.ngram_join(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_groups(dict(enumerate(texts)))


@pytest.mark.parametrize("backwards", [False, True])
def test_an_id_with_several_texts_is_linked_by_all(spark, backwards):
    one, two = (" ".join(f"{c}{i}" for i in range(30)) for c in "pq")
    rows = [(5, one), (5, two), (7, one + " x"), (8, two + " y"), (9, "alone"), (5, one)]
    rows = rows[::-1] if backwards else rows
    found = nj.ngram_join(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 5), (7, 5), (8, 5), (9, 9)} and len(found) == 6


@pytest.mark.parametrize("size", [900, 2_500, 9_000])
def test_large_sets_share_signatures(size):
    """Where parts are cut by chance: pairs just at the bar, also of two bands and with common elements."""
    bands, rnd = nj.Bands(), np.random.default_rng(size)
    assert bands.chance[bands.of(size)]
    for trial in range(40):
        pool = rnd.integers(0, 1 << 63, 2 * size, np.int64).astype(np.uint64)
        gone = size // 7 if trial % 2 else 0  # equal sizes, or one inside the other
        a = np.unique(pool[:size])
        b = np.unique(pool[gone: size + gone]) if gone else np.unique(pool[: size * 3 // 4 + 1])
        both = len(np.intersect1d(a, b))
        assert 4 * both >= 3 * (len(a) + len(b) - both)
        common = nj.Common({int(x): 20 for x in pool[: trial % 4 * size // 8].view(np.int64)})
        assert len(np.intersect1d(bands.signatures(a, common), bands.signatures(b, common))) >= nj.SHARED


def test_long_texts_with_one_passage_in_common_are_not_tied(spark):
    """Unlike texts of 3,000 words that share 80 of them form no group."""
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(10**7)}"
    passage = [word() for _ in range(80)]
    sets = nj.Sets(5)
    texts = [" ".join([*(word() for _ in range(3_000)), *passage]) for _ in range(12)]
    signed = [nj.Bands().signatures(s, nj.Common({})) for s in sets(pa.array(texts))]
    assert max(len(np.intersect1d(x, y)) for i, x in enumerate(signed) for y in signed[:i]) < nj.SHARED
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert nj.ngram_join(rows).where(F.col("doc_id") != F.col("component_id")).count() == 0


def test_forest_finds_components():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 10, 300):
        a, b = rnd.integers(0, n, n // 2), rnd.integers(0, n, n // 2)
        want = np.arange(n)
        for _ in range(n):
            for x, y in zip(a, b, strict=True):
                want[x] = want[y] = min(want[x], want[y])
        assert (nj.forest(n, a, b) == want).all()
