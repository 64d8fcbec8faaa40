"""Operators against plain versions of them, on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entry_queries.common import TABLES
from tableferry.llm import pii, queries
from tableferry.llm.elias_fano import EliasFano
from tableferry.llm.hashing import Words, windows, within
from tableferry.llm.ngram_join import TABLE, Bands, Common, Sets, ngram_join
from tableferry.llm.ngram_lm import code_of, score_texts, LEVELS
from tableferry.llm.packing import deal, pack
from tableferry.llm.quality_rules import BUCKETS, PRIOR, quality_rules
from tableferry.llm.secret_scan import matches, running_sums
from tools.check_queries import bag

from .conftest import LOWER, WORDS

PUNCTUATION = st.text(alphabet="ab1 .-+@()[]\n\té,4", max_size=40)


@pytest.fixture(scope="module")
def documents(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_queries_equal_their_statements(spark, tiny, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tiny}/{table}.parquet')")
    query, sql = queries.QUERIES[name]
    frame, cursor = query(spark, tiny), con.execute(sql)
    assert bag(frame.columns, frame.collect()) == bag([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["op4_secret_scan", "op6_chat_format", "op10_quality_rules"])
def test_native_operators_run_no_python(spark, tiny, name):
    plan = queries.QUERIES[name][0](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- hashing ---------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abAB \t\né漢", max_size=12), max_size=8))
def test_hashed_words_are_told_apart_like_words(texts):
    hashes, starts = Words(TABLE)(pa.array(texts, pa.string()))
    words = [WORDS.findall(t.translate(LOWER)) for t in texts]
    assert np.diff(starts).tolist() == [len(w) for w in words]
    flat = [w for own in words for w in own]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    for size in (1, 2, 5):
        at = within(starts, size)
        assert len(at) == sum(max(0, len(w) - size + 1) for w in words)
        named = {(tuple(flat[p: p + size]), int(windows(hashes, size)[p])) for p in at.tolist()}
        assert len(named) == len({a for a, _ in named}) == len({b for _, b in named})


# --- 1: language model -----------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.sampled_from([64, 40, 12, 6]))
def test_elias_fano_round_trip_and_search(numbers, bits):
    values = np.sort(np.array([n >> (64 - bits) for n in numbers], np.uint64))
    sequence = EliasFano(EliasFano.encode(values, 1 << bits))
    assert sequence.values().tolist() == values.tolist()
    assert sequence.access(np.arange(len(values))).tolist() == values.tolist()
    wanted = np.concatenate((values, values ^ np.uint64(1), np.arange(5, dtype=np.uint64)))
    first = {v: n for n, v in reversed(list(enumerate(values.tolist())))}
    assert sequence.find(wanted).tolist() == [first.get(v, -1) for v in wanted.tolist()]


def test_count_codes():
    counts = np.array([0, 1, 2, 99, 100, 105, 10_000])
    assert np.allclose(LEVELS[code_of(counts)], counts, rtol=0.026)
    assert (LEVELS[code_of(counts[:5])] == counts[:5]).all()


@pytest.mark.parametrize("shard_bytes", [1 << 15, 1 << 30])
def test_language_model_scores(documents, texts, shard_bytes):
    tokens = {k: WORDS.findall(t.translate(LOWER)) + [None] for k, t in texts.items()}
    one, two = Counter(), Counter()
    for key, own in tokens.items():
        if zlib.crc32(str(key).encode()) % 10:
            one.update(own)
            two.update(zip([0, *own], own))
    total, types = sum(one.values()), len(one)
    alone = lambda w: (one[w] + 0.1) / (total + 0.1 * (types + 1))
    rows = score_texts(documents, queries.crc_of_id(10) != 0, weight=30, shard_bytes=shard_bytes).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(one[w] > 0 for w in own), total)
        assert math.isclose(r.base_score, sum(math.log10(alone(w)) for w in own), rel_tol=1e-9)
        exact = sum(math.log10((two[v, w] + 30 * alone(w)) / (one[v if v != 0 else None] + 30)) for v, w in zip([0, *own], own))
        assert abs(r.score - exact) < 0.01 * len(own)
    held = [r for r in rows if not r.training]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_counts_beyond_the_codes_are_kept(spark):
    """A pair of over a million occurrences in training, and one just beyond the last level."""
    texts = ["a b " * 200_000] * 6 + ["c d " * 33_000] * 6 + ["x y", None]
    assert 6 * 200_000 > 1_000_000 and 6 * 33_000 > LEVELS[-1]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    one, two = Counter(), Counter()
    for own in ([*(t or "").split(), None] for t in texts):
        one.update(own)
        two.update(zip([0, *own], own))
    total, types = sum(one.values()), len(one)
    alone = lambda w: (one[w] + 0.1) / (total + 0.1 * (types + 1))
    for shard_bytes in (1 << 20, 1 << 30):
        rows = score_texts(frame, F.lit(True), weight=30, shard_bytes=shard_bytes).collect()
        assert len(rows) == len(texts)
        for r in rows:
            own = [*(texts[r.doc_id] or "").split(), None]
            pairs = Counter(zip([0, *own], own))
            exact = sum(n * math.log10((two[v, w] + 30 * alone(w)) / (one[v if v != 0 else None] + 30)) for (v, w), n in pairs.items())
            assert abs(r.score - exact) < 1e-6 * len(own) + 0.05


# --- 3: quality classifier --------------------------------------------------------------


def test_quality_classifier_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op3(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 80 and sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)


# --- 4: secrets -------------------------------------------------------------------------


def test_base_secrets(spark, tiny, texts):
    patterns = {"assign": re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
                "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
    least = {"assign": 8, "access": 16, "hex": 32}

    def brute(text):
        spans = [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for n, (kind, p) in enumerate(patterns.items())
                 for m in p.finditer(text) if len(m[p.groups]) >= least[kind]]
        return ",".join(s for *_, s in sorted(spans))

    rows = queries.op4(spark, tiny).collect()
    assert {r.doc_id: r.base_sha256 for r in rows} == {k: hashlib.sha256(brute(t).encode()).hexdigest() for k, t in texts.items()}
    made = ["token=secret:abcdefgh1", "\U0001F600é password='abcdefgh' AKIA" + "A" * 11, "API_KEY : " + "f" * 40, "tokenpasswd==x=y=z===", "AKIA" * 9,
            "secret = " * 3 + "12345678", "token=abc token=abcdefgh, " * 700]
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    for r in queries.find_secrets(frame, [0.0] * 128 * 128).collect():
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.secrets.base) == brute(made[r.doc_id])
        assert all(made[r.doc_id][s.start: s.end].endswith(s.value) for s in r.secrets.base)


def test_running_sums(spark):
    sizes = [list(range(n)) for n in (0, 1, 255, 256, 257, 1000)]
    rows = spark.createDataFrame([(s,) for s in sizes], "s array<bigint>").select("s", running_sums(F.col("s")).alias("r")).collect()
    assert all(r.r == np.cumsum(r.s).tolist() for r in rows)


def test_markov_models_tell_random_strings_from_words(spark):
    rnd = random.Random(5)
    random_string = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(30))
    name = lambda: "".join(rnd.choice(["get", "Name", "user", "list", "Value", "count", "Index", "file"]) for _ in range(6))
    samples = [(random_string(), True) for _ in range(300)] + [(name(), False) for _ in range(300)]
    ratios = queries.train(spark.createDataFrame([*samples, (None, True), ("", False), ("x", None)], "token string, is_random boolean"))
    held = [(random_string(), True) for _ in range(100)] + [(name(), False) for _ in range(100)]
    found = queries.find_secrets(spark.createDataFrame(held, "text string, random boolean"), ratios, threshold=0.5)
    right = found.where((F.size("secrets.added") == 1) == F.col("random")).count()
    assert right >= 196
    span = found.where("random").first()
    assert [(s.kind, s.start, s.end) for s in span.secrets.added] == [("random", 0, 30)]


# --- 7: packing -------------------------------------------------------------------------


def test_packed_pieces_hold_every_token_once(documents, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    odd = {-1: "two  spaces \n and\n\n\nbreaks \u3000x\u00a0 y ", -2: " leading", -3: "<|endoftext|> 's it's\t", -4: "\n", -5: "a \nb\n c", -6: "", -7: "x" * 9000}
    frame = documents.union(documents.sparkSession.createDataFrame(list(odd.items()), documents.schema))
    pieces, ids, fill = pack(frame, *queries.vocabulary(), group=64).collect(), {}, {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == len(ids.setdefault(p.doc_id, [])) and p.length == len(p.ids) // 4
        ids[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
    assert ids == {k: tokenizer.encode(t, add_special_tokens=False).ids + [0] for k, t in {**texts, **odd}.items()}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill.get(p.sequence_id, 0)
        fill[p.sequence_id] = p.offset + p.length
    assert max(fill.values()) <= 1024
    groups = len(frame.collect()) // 64 + frame.rdd.getNumPartitions()
    assert sum(1024 - n for n in fill.values()) <= 1024 * groups


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 1023), max_size=60))
def test_deal_balances_and_fills(lengths):
    pieces = deal(np.array(lengths, np.int64))
    used, total = Counter(), Counter()
    for end, start, size, at in pieces:
        assert start == total[end]
        total[end] += size
        used[at] += size
    assert [total[n] for n in range(len(lengths))] == lengths
    assert all(n <= 1024 for n in used.values()) and len(used) == -(-sum(lengths) // 1024)


# --- 8: personal data -------------------------------------------------------------------


def _luhn(digits):
    return sum(d if n % 2 == 0 else 2 * d - 9 * (d > 4) for n, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_pii(text):
    only = lambda m: re.sub("[^0-9]", "", m[0])
    found = {
        "email": re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text),
        "ip": (m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))),
        "card": (m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(only(m)) <= 19 and _luhn(only(m))),
        "phone": (m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(only(m)) <= 15),
    }
    return sorted(((k, m.start(), m.end()) for k, ms in found.items() for m in ms), key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a@.1 -+2(%4)0", max_size=40))
def test_base_detectors(text):
    assert pii.detect(text) == brute_pii(text)


def test_base_personal_data_of_documents(texts):
    assert all(pii.detect(t) == brute_pii(t) for t in texts.values())


@settings(max_examples=300, deadline=None)
@given(PUNCTUATION)
def test_added_spans_leave_base_spans_alone(text):
    base, extra = pii.all_spans(text)
    assert base == brute_pii(text)
    spans = sorted(s[1:] for s in extra)
    assert all(0 <= a < b <= len(text) for a, b in spans) and all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
    assert not any(a < y and x < b for a, b in spans for _, x, y in base)


@pytest.mark.parametrize(("text", "kind", "hidden"), [
    ("mail bob.smith [at] example [dot] com now", "email", "bob.smith [at] example [dot] com"),
    ("joe at mail dot example dot org", "email", "joe at mail dot example dot org"),
    ("аdmin@еxample.com!", "email", "аdmin@еxample.com"),
    ("call five five five one two three four five six seven now", "phone", "five five five one two three four five six seven"),
    ("plus four nine one five one two three four five six seven", "phone", "plus four nine one five one two three four five six seven"),
    ("é ４１１１１１１１１１１１１１１１.", "card", "４１１１１１１１１１１１１１１１"),
    ("ip １９２.168.1.１", "ip", "１９２.168.1.１"),
])
def test_disguises(text, kind, hidden):
    base, extra = pii.all_spans(text)
    assert [(k, text[a:b]) for k, a, b in extra] == [(kind, hidden)] and (base == [] or base[0][1] > text.index(hidden))


@pytest.mark.parametrize(("before", "hidden", "after", "kind"), [
    ("call ", "+1 555 one two 3 4567", " now", "phone"),
    ("call ", "nine nine nine eight eight eight eight nine nine nine", ".", "phone"),
    ("(", "five five five) one one one; two two two two", "", "phone"),
    ("card (", "four 111 1111 1111 1111", ")", "card"),
    ("ask ", "jane.doe at example.com", ", or look at example.com", "email"),
    ("please e-mail ", "jane at example.org", " today", "email"),
    ("", "a.b.c.d.e.f.g [at] example [dot] com", "", "email"),
    ("", "a dot b dot c dot d dot e dot f at example dot com", " now", "email"),
    ("look at ", "john.smith@example [dot] com", "", "email"),
])
def test_disguises_of_few_words_or_marks(before, hidden, after, kind):
    text = before + hidden + after
    base, extra = pii.all_spans(text)
    assert [(k, text[a:b]) for k, a, b in extra] == [(kind, hidden)] and not base


@pytest.mark.parametrize("text", ["visit us at example.com", "In 1990, 1991, 1992, one of them", "it is version 2.0 at example.org", "one 1" + "1" * 5000 + "x"])
def test_plain_language_near_disguises_is_left_alone(text):
    assert pii.all_spans(text) == ([], [])
    assert pii.all_spans("+1 (848) 555-1373 Un, a.b@example.com dot then")[1] == []


@pytest.mark.parametrize(("text", "plain", "kind"), [
    ("jоhn@example.com", "hn@example.com", "email"),
    ("john dot smith@example.com", "smith@example.com", "email"),
    ("john@example.cоm", "john@example.c", "email"),
    ("john@mail.example [dot] com", "john@mail.example", "email"),
    ("+49 170 12345 ６７８", "+49 170 12345", "phone"),
    ("+4111 1111 1111 111１", "+4111 1111 1111 111", "card"),
])
def test_disguises_around_a_plain_remainder(text, plain, kind):
    before = f"é x, {text}; y"
    base, extra = pii.all_spans(before)
    assert [before[a:b] for _, a, b in base] == [plain] and {k for k, *_ in extra} == {kind}
    covered = {n for _, a, b in base + extra for n in range(a, b)}
    assert "".join(c for n, c in enumerate(before) if n in covered).lstrip("+") == text.lstrip("+")
    masked = pii.mask(before, pii.detect(before) + pii.disguised(before))
    assert masked in (f"é x, <{kind}>; y", "é x, <phone>; y")


@pytest.mark.parametrize("text", ["look at the dot. that is it", "un un un un un un un un un", "the at home dot that", "meet me at five or six", "one two three"])
def test_plain_language_is_left_alone(text):
    assert pii.all_spans(text) == ([], [])


# --- 9: similarity join -------------------------------------------------------------------


def brute_groups(texts, shingle=5):
    sets = {}
    for key, text in texts.items():
        w = WORDS.findall(text.translate(LOWER))
        sets[key] = {tuple(w[i: i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(s), find(k)) for k, s in sets.items()}


def test_similar_groups_of_edited_copies(spark):
    """Families of copies with more and more edits, a line that a third of all share, and chains."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    line = " ".join(word() for _ in range(12))
    texts = {}
    for size in (1, 3, 5, 6, 7, 9, 12, 20, 40, 90, 250):
        base = [word() for _ in range(size)]
        for _ in range(14):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                own[rnd.randrange(size)] = word()
            texts[len(texts)] = (line + " " if len(texts) % 3 == 0 else "") + " ".join(own[: rnd.randint(size * 4 // 5, size)])
    texts |= {len(texts) + n: line for n in range(40)}
    rows = ngram_join(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_groups(texts)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 300), st.integers(0, 80), st.integers(0, 2**32), st.booleans())
def test_similar_sets_share_signatures(size, edits, seed, common):
    rnd = np.random.default_rng(seed)
    pool = rnd.integers(0, 1 << 63, size + edits, np.int64).astype(np.uint64)
    a, b = np.unique(pool[:size]), np.unique(pool[min(edits, size - 1) // 2: size + edits // 2])
    both = len(np.intersect1d(a, b))
    known = Common({int(x): int(rnd.integers(16, 5000)) for x in pool[::2].view(np.int64)} if common else {})
    shared = len(np.intersect1d(Bands().signatures(a, known), Bands().signatures(b, known)))
    if 100 * both >= 75 * (len(a) + len(b) - both):
        assert shared >= (4 if min(len(a), len(b)) >= 24 else 1)


# --- 10: quality rules ----------------------------------------------------------------------


def test_quality_rules(spark, tiny, documents, texts):
    good = {r.doc_id for r in queries.trusted_ids(spark, tiny).collect()}

    def features(words):
        first = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
        pairs = [xxhash.xxh64_intdigest(b.encode(), seed=h) for h, b in zip(first, words[1:])]
        return [(h - (1 << 64) if h >> 63 else h) % BUCKETS for h in first + pairs]

    words = {k: WORDS.findall(t) for k, t in texts.items()}
    raw, trusted = Counter(), Counter()
    for key, own in words.items():
        raw.update(features(own))
        if key in good:
            trusted.update(features(own))
    shift = math.log(raw.total() + PRIOR * BUCKETS) - math.log(trusted.total() + PRIOR * BUCKETS)
    ratio = lambda b: math.log((trusted[b] + PRIOR) / (raw[b] + PRIOR)) + shift
    rows = quality_rules(documents, queries.trusted_ids(spark, tiny)).select("doc_id", "rules.*").collect()
    assert len(rows) == len(texts)
    for r in rows:
        own, text = words[r.doc_id], texts[r.doc_id]
        grams = [tuple(own[i: i + 5]) for i in range(len(own) - 4)]
        count = Counter(grams)
        inside = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))
        assert r.base_failed == (len(own) < 10 or 100 * len(inside) > 20 * len(own))
        score = sum(map(ratio, features(own))) / len(features(own)) if own else 0.0
        assert abs(r.score - score) < 1e-3
        assert r.kept == (not r.base_failed and r.score >= -0.1)


def test_split_and_matches_agree(spark):
    """Positions come from what lies between matches; wide characters and edges count as one."""
    rows = ["", "x", "xx\U0001F600x", "é漢x\nxx", "axbxc", "xax"]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select("t", matches(F.col("t"), "x+", "k").alias("m")).collect()
    for r in got:
        assert [(m.start, m.end, m.value) for m in r.m] == [(m.start(), m.end(), m[0]) for m in re.finditer("x+", r.t)]
