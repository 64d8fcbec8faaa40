"""Language model: words whose hashes agree in part, and searches among a context's followers."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.llm.elias_fano import EliasFano
from tableferry.llm.hashing import Words
from tableferry.llm.ngram_lm import TABLE, Trie, pair_of, score_texts


def hashes_of(*words):
    return Words(TABLE)(pa.array([" ".join(words)]))[0]


def test_words_that_share_half_their_bits_share_no_pairs(spark):
    a, b, x = hashes_of("w219030", "w275467", "x").reshape(3, 1)
    assert (a >> np.uint64(32) == b >> np.uint64(32)).all() and a != b
    assert pair_of(a, x) != pair_of(b, x) and pair_of(x, a) != pair_of(x, b)
    texts = ["w275467 x"] * 50 + ["x w275467"] * 20 + ["w219030 y"] * 5 + ["w219030 x", "x w219030"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r.score for r in score_texts(frame, F.col("doc_id") < 75).collect()}
    alone, both, context = Counter(), Counter(), Counter()
    for text in texts[:75]:
        tokens = [*text.split(), "</>"]
        alone.update(tokens)
        both.update(zip(["<>", *tokens], tokens))
        context.update(["<>", *tokens])
    context["<>"] = alone["</>"]
    total = sum(alone.values())
    for n, text in enumerate(texts):
        tokens = [*text.split(), "</>"]
        share = {t: (alone[t] + 0.1) / (total + 0.1 * (len(alone) + 1)) for t in tokens}
        brute = sum(math.log10((both[v, w] + 30 * share[w]) / (context[v] + 30)) for v, w in zip(["<>", *tokens], tokens))
        assert rows[n] == pytest.approx(brute, abs=1e-6)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 60)), max_size=200), st.lists(st.tuples(st.integers(0, 14), st.integers(0, 70)), max_size=60))
def test_trie_finds_what_it_holds_and_nothing_else(held, asked):
    number = lambda pairs: np.array([(c << 40) | (f << 30) for c, f in pairs], np.uint64)
    counts = Counter(held)
    pairs = sorted(counts)
    trie = Trie(number(pairs), np.array([counts[p] for p in pairs], np.int64))
    codes, far, _ = trie.look_up(number(asked))
    assert [int(c) for c in codes] == [counts[p] for p in asked] and not len(far)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=80), st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 80), st.integers(0, 80)), min_size=1, max_size=40),
       st.sampled_from([5001, 1 << 20, 1 << 40, 1 << 64]))
def test_searches_between_two_places(values, asked, limit):
    values = sorted(set(values))
    sequence = EliasFano(EliasFano.encode(np.array(values, np.uint64), limit))
    wanted, first, last = (np.array(x) for x in zip(*asked))
    first, last = np.minimum(first, len(values)), np.minimum(last, len(values))
    got = sequence.find(wanted.astype(np.uint64), first, last).tolist()
    assert got == [values.index(w) if w in values[a:b] else -1 for w, a, b in zip(wanted.tolist(), first.tolist(), last.tolist())]
