"""Secret scan at its defaults: recall of planted keys, ordinary runs left alone, models against plain versions."""

from __future__ import annotations

import base64
import math
import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableferry.llm import secret_scan
from tableferry.llm.common import read
from tableferry.llm.secret_scan import find_secrets, labelled_samples, ratio_of, train

FOLDER = "/root/testdata/sf0.01"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {"letters_digits": LETTERS + LETTERS.upper() + "0123456789", "lower_digits": LETTERS + "0123456789",
             "lower_hex": "0123456789abcdef", "upper_hex": "0123456789ABCDEF"}
WORDS = "get set user name list value count index file report table order item market price review summer garden travel music school number system value water people".split()


@pytest.fixture(scope="module")
def ratios(spark):
    return train(labelled_samples(read(spark, FOLDER, "documents")))


def planted(rnd):
    for size in (16, 20, 32, 40):
        for name, alphabet in ALPHABETS.items():
            for _ in range(200):
                yield name, size, "".join(rnd.choice(alphabet) for _ in range(size))
        for _ in range(200):
            yield "base64", size, base64.b64encode(rnd.randbytes(size * 3 // 4)).decode()


def ordinary(rnd):
    word = lambda: rnd.choice(WORDS)
    for _ in range(300):
        yield "uuid", str(uuid.UUID(int=rnd.getrandbits(128)))
        yield "path", "/" + "/".join(word() for _ in range(rnd.randrange(3, 7)))
        yield "slug", "-".join(word() for _ in range(rnd.randrange(3, 7)))
        yield "dated", f"20{rnd.randrange(10, 30)}-{rnd.randrange(1, 13):02}-{rnd.randrange(1, 29):02}-" + "-".join(word() for _ in range(rnd.randrange(2, 5)))
        yield "camel", word() + "".join(word().title() for _ in range(rnd.randrange(2, 6)))
        yield "snake", "_".join(word() for _ in range(rnd.randrange(3, 7)))
        yield "constant", "_".join(word().upper() for _ in range(rnd.randrange(3, 6)))
        yield "number", str(rnd.randrange(10**15, 10**19))


def test_recall_and_false_alarms_at_defaults(spark, ratios):
    rnd = random.Random(4)
    keys = [(f"{name} {size}", True, key) for name, size, key in planted(rnd)]
    plain = [(name, False, run) for name, run in ordinary(rnd)]
    frame = spark.createDataFrame([(n, r, k, f"see the {k} here") for n, r, k in keys + plain], "name string, random boolean, run string, text string")
    found = find_secrets(frame, ratios)
    hit = F.size("secrets.added") + F.size("secrets.base") > 0
    shares = {r.name: (r.random, r.share) for r in found.groupBy("name", "random").agg(F.avg(hit.cast("int")).alias("share")).collect()}
    print(sorted(shares.items()))
    assert not {n: s for n, (random_, s) in shares.items() if (s < 0.9 if random_ else s > 0.05)}
    # A key that is found is found whole.
    assert found.where("random AND size(secrets.added) > 0 AND secrets.added[0].value <> run").count() == 0


def test_words_of_documents_are_no_secrets(spark, ratios):
    found = find_secrets(read(spark, FOLDER, "documents"), ratios).select(F.explode("secrets.added").alias("s")).count()
    assert found <= 5


def test_free_parts_of_runs_are_judged(spark, ratios):
    key, hexes = "Zq7Xw2Lk9Vb4Nt6Rm1Pz", "0f" * 16
    texts = [f"AKIA{'B7' * 8}{'z' + key}", f"{key}+{hexes}+{key}", f"token={key}", None, ""]
    rows = find_secrets(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), ratios).orderBy("id").collect()
    assert [[(s.start, s.end) for s in r.secrets.added] for r in rows] == [[(20, 41)], [(0, 21), (53, 74)], [], [], []]
    for r in rows:
        assert all(r.text[s.start: s.end] == s.value for s in r.secrets.added)


def test_models_against_a_plain_version(spark):
    samples = [("Ab1xQ", True), ("zz9", True), ("get_Name", False), ("list", False), ("é-x", False)]
    ratios = train(spark.createDataFrame(samples, "token string, is_random boolean"), share=0.0)
    code = lambda c: ord(c) if ord(c) < 128 else 1
    counts = (Counter(), Counter())
    for token, is_random in samples:
        codes = [0, *map(code, token)]
        counts[not is_random].update(zip(codes, codes[1:]))
        if not is_random:  # what is small is also written in capitals
            capitals = [0, *map(code, token.upper())]
            counts[1].update(pair for pair, last in zip(zip(capitals, capitals[1:]), token, strict=True) if last.islower() and last.isascii())
    alone = Counter()
    for (_, b), n in counts[1].items():
        alone[b] += n
    sets = [set(a) for a in secret_scan.ALPHABETS]

    def chance(kind, a, b):
        total = sum(n for (x, _), n in counts[kind].items() if x == a)
        prior = (1.0, 0.1)[kind]
        return (counts[kind][a, b] + prior) / (total + prior * 67)

    def brute(a, b):
        able = [s for s in sets if chr(a) in s] or sets
        even = sum(1 / len(s) for s in able if chr(b) in s) / len(able) or 1 / 128 / 67
        plain = 0.1 * (alone[b] + 1) / (sum(alone.values()) + 67) + 0.9 * chance(1, a, b)
        return math.log(0.7 * even + 0.3 * chance(0, a, b)) - math.log(plain)

    assert all(abs(ratios[a * 128 + b] - brute(a, b)) < 1e-4 for a in range(128) for b in range(128))
    model = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    for token in ("Ab1xQ", "é-x", "other_Names9"):
        got = spark.range(1).select(ratio_of(F.lit(token), model).alias("r")).first().r
        codes = [0, *map(code, token)]
        assert abs(got - sum(brute(a, b) for a, b in zip(codes, codes[1:])) / len(token)) < 1e-3


def test_joined_samples_count_ends_and_beginnings():
    plain = Counter()
    for token in ("ab", "cb"):
        codes = [0, *map(ord, token)]
        plain.update(a * 128 + b for a, b in zip(codes, codes[1:]))
    out = secret_scan.joined(plain, 0.5)
    at = lambda a, b: out.get(ord(a) * 128 + ord(b), 0)
    # Two samples as they are and two in capitals; each begins once with a, c, A and C.
    assert (at("b", "-"), at("B", "-"), at("-", "a"), at("-", "C"), at("a", "-"), at("0", "a"), at("b", "7"), at("1", "2")) == (1.0, 1.0, 0.5, 0.5, 0, 0.05, 0.1, 0.04)
    # A capital follows an end: once for each of its two forms.
    assert at("b", "A") == 0.5 and at("B", "C") == 0.5
    assert at("a", "b") == at("A", "B") == plain[97 * 128 + 98] and secret_scan.joined({}, 0.5) == {}


def test_forms_that_are_no_keys():
    assert re.search(secret_scan.NO_KEY, "1234-5678") and re.search(secret_scan.NO_KEY, "=" + str(uuid.UUID(int=5)))
    assert not re.search(secret_scan.NO_KEY, "1234a") and not re.search(secret_scan.NO_KEY, str(uuid.UUID(int=5)) + "-ab")
