"""The pipeline and each of its stages against plain versions of them, on planted documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tableferry.llm.quality_rules import BUCKETS, PRIOR

from .conftest import LOWER, WORDS
from .test_brute_force import brute_groups

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Planted personal data and what masking makes of it.
PRIVATE = {"a.b@example.com": "<email>", "jоhn@example.org": "<email>", "+1 555 one two 3 4567": "<phone>", "joe.doe at example.net": "<email>",
           "10.20.30.40": "<ip>", "4111 1111 1111 1111": "<card>"}


def planted():
    """Documents, the trusted ids and benchmark items."""
    rnd = random.Random(7)
    words = lambda n, letters="abcdefgh": [" ".join("".join(rnd.choice(letters) for _ in range(5)) for _ in range(n))][0]
    plain = [words(60) for _ in range(30)]
    items = [words(30), words(6), None]
    texts = dict(enumerate(plain))
    trusted = list(texts)
    add = lambda *own: [texts.__setitem__(len(texts), t) for t in own]
    add("too short", None, "", " ".join(["again and again we say"] * 6), *(words(60, "uvwxyz") for _ in range(5)))  # rejects
    trusted += range(len(texts), len(texts) + 12)
    add(plain[0], plain[0], plain[1] + " last", "first " + plain[2], plain[3][:250] + " " + words(3))  # copies
    add(f"{plain[4][:200]} {items[0]} {words(4)}", f"{words(9)} {items[1].upper()} {words(9)}", f"{words(20)} {items[0][:60]} {words(9)}")  # contamination
    add(words(20) + " " + " or ".join(PRIVATE) + " " + words(9), words(50) + " jоhn@example.org", words(900) + " <|endoftext|> " + words(900), words(3) + "\n\n" + words(40))
    # A repeated row, and a row without an id.
    return [*texts.items(), (5, texts[5]), (None, plain[0])], set(trusted), items


def quality(rows, trusted, _):
    def features(own):
        first = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in own]
        pairs = [xxhash.xxh64_intdigest(b.encode(), seed=h) for h, b in zip(first, own[1:])]
        return [(h - (1 << 64) if h >> 63 else h) % BUCKETS for h in first + pairs]

    raw, good, out = Counter(), Counter(), []
    for key, text in rows:
        raw.update(own := features(WORDS.findall(text or "")))
        good.update(own if key in trusted else ())
    shift = math.log(raw.total() + PRIOR * BUCKETS) - math.log(good.total() + PRIOR * BUCKETS)
    for key, text in rows:
        own = WORDS.findall(text or "")
        grams = [tuple(own[i: i + 5]) for i in range(len(own) - 4)]
        count = Counter(grams)
        inside = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
        if len(own) >= 10 and 100 * len(inside) <= 20 * len(own):
            score = sum(math.log((good[b] + PRIOR) / (raw[b] + PRIOR)) + shift for b in features(own)) / len(features(own))
            assert abs(score + 0.1) > 0.01  # no planted document is near the bar
            out += [(key, text)] * (score >= -0.1)
    return out


def near_duplicates(rows, *_):
    groups = brute_groups({k: t for k, t in rows if k is not None})
    return [(k, t) for k, t in dict(r for r in rows if r[0] is not None).items() if groups[k][1] == k] + [r for r in rows if r[0] is None]


def decontamination(rows, _, items):
    windows = set()
    for item in items:
        w = TERMS.findall((item or "").translate(LOWER))
        size = min(13, len(w))
        windows |= {tuple(w[p: p + size]) for p in range(len(w) - size + 1)} if w else set()
    out = []
    for key, text in rows:
        w = TERMS.findall(text.translate(LOWER))
        hit = {p + k for size in {len(x) for x in windows} for p in range(len(w) - size + 1) if tuple(w[p: p + size]) in windows for k in range(size)}
        out += [(key, text)] * (not hit or 20 * len(hit) < len(w))
    return out


def masking(rows, *_):
    for private, kind in PRIVATE.items():
        rows = [(k, t.replace(private, kind)) for k, t in rows]
    return rows


BRUTE = {"quality_rules": quality, "ngram_join": near_duplicates, "decontamination": decontamination, "pii": masking}
order = lambda rows: sorted(rows, key=str)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, trusted, items = planted()
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.createDataFrame([(k, t, "en", "web", None if t is None else len(t)) for k, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k in trusted), int(k == 99)) for k in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, trusted, items


def packed(pieces):
    """The ids of each document by its start; every sequence is filled from 0 without gaps."""
    ids, fill = {}, {}
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.start)):
        assert p.start == len(ids.setdefault(p.doc_id, [])) and 4 * p.length == len(p.ids)
        ids[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill.get(p.sequence_id, 0)
        fill[p.sequence_id] = p.offset + p.length
    assert max(fill.values()) <= 1024
    return ids


def token_ids(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return {k: tokenizer.encode(t, add_special_tokens=False).ids + [0] for k, t in rows}


def test_stages_and_run_equal_brute_force(spark, tables):
    folder, rows, trusted, items = tables
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame([(k, t, "en", "web", None if t is None else len(t)) for k, t in rows],
                                      "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
        found = stage(spark, frame, folder)
        want = BRUTE[name](rows, trusted, items)
        assert found.columns == frame.columns and want != rows, name  # every stage has something to do
        got = found.collect()
        assert order((r.doc_id, r.text) for r in got) == order(want), name
        assert all(r.n_chars == len(r.text) for r in got)
        rows = want
    ids = token_ids(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert packed(corpus_pipeline.STAGES[-1][1](spark, frame, folder).collect()) == ids
    assert packed(corpus_pipeline.run(spark, folder).collect()) == ids
    assert len(ids) == len(rows) and max(map(len, ids.values())) > 1024
