"""Secret scan: fixed patterns, and Markov models of random strings and ordinary identifiers.

Native: DataFrame functions only. Candidates are runs of key characters outside known spans. Two
first-order Markov models over their characters, one learned from values known to be random and
one from ordinary words and identifiers, give each candidate a log-likelihood ratio, which must
pass a bar for its whole and one per character: a short run must show itself more clearly.

Not judged are runs of under 16 characters without a digit (too near to names), numbers, and
UUIDs, which are identifiers by their form.

Positions come from the pieces between matches and the matches themselves: their lengths in
code points are summed up. A text without the signs of a kind is not searched for it. The model
has one number per pair of ASCII characters and is a constant of the plan.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import let, text_of

KINDS = ("assign", "access", "hex", "random")
#: The patterns of known kinds. A run that is too short for its kind is no match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_SIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ASSIGN_VALUE = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: Runs that the models judge, and those among them that are none by their form.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z0-9+/_=-]{16,}+|(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{8,}+)"
NO_KEY = r"^(?:[^A-Za-z]*|[^0-9A-Za-z]*[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}[^0-9A-Za-z]*)$"
#: Nats per character, and in all, by which a run must be likelier as a random string.
THRESHOLD = 0.55
TOTAL = 9.0
CODES = 128
SYMBOLS = 67  # 26 + 26 + 10 + 5
#: Added to the counts of random and of ordinary pairs.
PRIORS = (1.0, 0.1)
#: Share of the random model that is uniform over one of the usual alphabets of keys: known keys show few of them.
UNIFORM = 0.7
_LOWER, _UPPER, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
ALPHABETS = (_DIGITS + "abcdef", _DIGITS + "ABCDEF", _DIGITS + _LOWER, _DIGITS + _UPPER, _DIGITS + _LOWER + _UPPER, _DIGITS + _LOWER + _UPPER + "+/_=-")
#: Share of the ordinary model that looks at the character alone.
ALONE = 0.1
#: Share of ordinary samples that also count as joined to another, by one of ``JOINTS``, a capital or a number, and
#: of such numbers that have a further digit.
JOINED = 0.03
LONGER = 0.2
JOINTS = "-_/="
#: Words and identifiers that serve as ordinary samples.
ORDINARY = "[A-Za-z0-9+/_=-]{12,}"
BLOCK = 256

EMPTY = "array<struct<kind: string, start: bigint, end: bigint, value: string>>"


def running_sums(sizes: Column) -> Column:
    """Sums up to each element, by blocks, so that no step copies more than a block."""
    def within(block):
        return F.aggregate(block, F.array().cast("array<bigint>"), lambda out, x: F.array_append(
            out, x + F.coalesce(F.get(out, F.size(out) - 1), F.lit(0).cast("bigint"))))

    def joined(blocks):
        return let(within(F.transform(blocks, lambda x: x[F.size(x) - 1])), lambda ends: F.flatten(F.transform(
            blocks, lambda x, n: let(F.coalesce(F.get(ends, n - 1), F.lit(0).cast("bigint")), lambda low: F.transform(x, lambda v: v + low)))))

    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(sizes) / BLOCK).cast("int") - 1),
                         lambda n: within(F.slice(sizes, n * BLOCK + 1, F.lit(BLOCK))))
    return F.when(F.size(sizes) > 0, let(blocks, joined)).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: str, kind: str, value_group: int = 0, least: int = 0) -> Column:
    """Spans of all matches, leftmost and without overlap, with the text of ``value_group``.

    A match whose value is shorter than ``least`` is dropped after the search.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    size = lambda x: F.char_length(x).cast("bigint")
    def spans(m):
        # What precedes a match, and the match: the end of match n is the n-th running sum.
        steps = let(F.split(text, pattern, -1), lambda gaps: F.transform(m, lambda x, n: size(gaps[n]) + size(x)))
        return let(values, lambda v: let(running_sums(steps), lambda ends: F.filter(F.transform(m, lambda x, n: F.struct(
            F.lit(kind).alias("kind"), (ends[n] - size(x)).alias("start"), ends[n].alias("end"), v[n].alias("value"))),
            lambda s: F.char_length(s["value"]) >= least)))

    return let(found, spans)


def base_spans(text: Column) -> Column:
    """Spans of the known kinds, by start and then by kind."""
    empty = F.array().cast(EMPTY)
    every = F.concat(
        F.when(text.rlike(ASSIGN_SIGN), matches(text, ASSIGN, "assign", 2, ASSIGN_VALUE)).otherwise(empty),
        F.when(F.contains(text, F.lit("AKIA")), matches(text, ACCESS, "access")).otherwise(empty),
        F.when(text.rlike(HEX), matches(text, HEX, "hex")).otherwise(empty),
    )
    return in_order(every)


def in_order(spans: Column) -> Column:
    place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    return F.transform(F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], place(s), s["end"], s.alias("span")))),
                       lambda x: x["span"])


def candidates(text: Column, base: Column) -> Column:
    """Runs of key characters, or the parts of them that base spans leave, that may be keys."""
    def free(run):
        def parts(inside):
            # Each part begins where all base spans before it have ended.
            ends = F.transform(inside, lambda b: b["end"])
            starts = F.concat(F.array(run["start"]), F.transform(ends, lambda _, n: F.array_max(F.slice(ends, F.lit(1), n + 1))))
            stops = F.concat(F.transform(inside, lambda b: b["start"]), F.array(run["end"]))
            return let(stops, lambda upto: F.filter(F.transform(starts, lambda a, n: F.struct(
                F.lit("random").alias("kind"), a.alias("start"), upto[n].alias("end"),
                F.substring(run["value"], (a - run["start"] + 1).cast("int"), F.greatest(upto[n] - a, F.lit(0)).cast("int")).alias("value"))),
                lambda p: p["value"].rlike(CANDIDATE)))

        return let(F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])),
                   lambda inside: F.when(F.size(inside) == 0, F.array(run)).otherwise(parts(inside)))

    empty = F.array().cast(EMPTY)
    return F.when(text.rlike(CANDIDATE), F.filter(
        F.flatten(F.transform(matches(text, CANDIDATE, "random"), free)), lambda c: ~c["value"].rlike(NO_KEY))).otherwise(empty)


def labelled_samples(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """Distinct (token, is_random): values of known secrets, and long words and identifiers beside them."""
    def of(t, b):
        random = F.transform(b, lambda s: F.struct(s["value"].alias("token"), F.lit(True).alias("is_random")))
        rest = F.when(F.size(b) > 0, F.regexp_replace(t, f"{ASSIGN}|{ACCESS}|{HEX}", " ")).otherwise(t)
        plain = F.transform(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0)),
                            lambda w: F.struct(w.alias("token"), F.lit(False).alias("is_random")))
        return F.concat(random, plain)

    rows = documents.select(text_of(text).alias("text")).select(
        let(F.col("text"), lambda t: let(base_spans(t), lambda b: of(t, b))).alias("samples"))
    return rows.select(F.explode("samples").alias("s")).select("s.*").distinct()


def _codes(token: Column) -> Column:
    """The characters' codes, after a 0 for the beginning; other characters than ASCII are 1."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(token, ""), lambda c: F.when(F.ascii(c) < CODES, F.ascii(c)).otherwise(1)))


def _pairs(codes: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(codes) - 1), lambda i: codes[i - 1] * CODES + codes[i])


def joined(plain: dict[int, float], share: float = JOINED) -> dict[int, float]:
    """Counts of pairs as if all samples that ``plain`` counts were also written in capitals, and ``share`` of them joined to others.

    Samples end in the characters that more pairs lead to than away from, and begin with those that
    follow the 0. Between an end and a beginning stands a joint, nothing (then a capital follows), or a number.
    """
    capital = lambda code: ord(chr(code).upper())
    samples, plain = plain, dict(plain)
    for pair, n in samples.items():
        if chr(pair % CODES).islower():
            upper = capital(pair // CODES) * CODES + capital(pair % CODES)
            plain[upper] = plain.get(upper, 0) + n
    first = {pair % CODES: n for pair, n in plain.items() if pair < CODES}
    every = sum(first.values())
    last: dict[int, float] = {}
    for pair, n in plain.items():
        last[pair % CODES] = last.get(pair % CODES, 0) + n
        if pair >= CODES:
            last[pair // CODES] = last.get(pair // CODES, 0) - n
    out = dict(plain)

    def add(a, b, n):
        if n > 0:
            out[a * CODES + b] = out.get(a * CODES + b, 0) + n

    digits = range(48, 58)
    for a, n in last.items():
        for mark in map(ord, JOINTS):
            add(a, mark, n * share)
        for b, m in first.items():
            add(a, capital(b), n * share * m / every)
        for digit in digits:
            add(a, digit, n * share / 10)
    for mark in map(ord, JOINTS):
        for b, m in first.items():
            add(mark, b, m * share)
        for digit in digits:
            add(mark, digit, every * share / 10)
            add(digit, mark, every * share / 10)
    for digit in digits:
        add(0, digit, every * share / 10)
        for b, m in first.items():
            add(digit, b, m * share / 10)
        for other in digits:
            add(digit, other, every * share * LONGER / 10)
    return out


def train(samples: DataFrame, *, token: str = "token", is_random: str = "is_random", priors: tuple[float, float] = PRIORS,
          uniform: float = UNIFORM, share: float = JOINED) -> list[float]:
    """Log-likelihood ratio of every pair of characters, random against ordinary.

    Null or empty tokens and null labels are ignored. Without samples all ratios are 0. The
    driver gets one row per pair of ASCII characters at most.
    """
    pairs = samples.where(F.col(is_random).isNotNull() & (F.char_length(token) > 0)).select(
        F.col(is_random).alias("random"), F.explode(let(_codes(F.col(token)), _pairs)).alias("pair"))
    rows = pairs.groupBy("pair").agg(F.count_if("random").alias("random"), F.count_if(~F.col("random")).alias("plain")).collect()
    if not rows:
        return [0.0] * CODES * CODES
    counts = ({r["pair"]: r["random"] for r in rows}, joined({r["pair"]: r["plain"] for r in rows if r["plain"]}, share))
    totals = tuple([0.0] * CODES for _ in counts)
    for of, total in zip(counts, totals, strict=True):
        for pair, n in of.items():
            total[pair // CODES] += n

    alone = [0.0] * CODES
    for pair, n in counts[1].items():
        alone[pair % CODES] += n
    every = sum(alone)

    def chance(kind, pair):
        return (counts[kind].get(pair, 0) + priors[kind]) / (totals[kind][pair // CODES] + priors[kind] * SYMBOLS)

    def ratio(pair):
        random = uniform * any_alphabet(chr(pair // CODES), chr(pair % CODES)) + (1 - uniform) * chance(0, pair)
        plain = ALONE * (alone[pair % CODES] + 1) / (every + SYMBOLS) + (1 - ALONE) * chance(1, pair)
        return round(math.log(random) - math.log(plain), 4)

    return [ratio(pair) for pair in range(CODES * CODES)]


def any_alphabet(before: str, char: str) -> float:
    """Chance of a character after another if all alphabets that hold the first, or else all, are equally likely."""
    able = [a for a in ALPHABETS if before in a] or ALPHABETS
    return sum((char in a) / len(a) for a in able) / len(able) or 1 / CODES / SYMBOLS


def ratio_of(token: Column, model: Column) -> Column:
    """Mean log-likelihood ratio per character."""
    return let(_codes(token), lambda c: let(_pairs(c), lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + model[x]) / F.size(p)))


def find_secrets(documents: DataFrame, ratios: list[float], *, text: str = "text", into: str = "secrets",
                 threshold: float = THRESHOLD, total: float = TOTAL) -> DataFrame:
    """``documents`` with one more column, a struct of ``base`` and ``added`` spans.

    A span is (kind, start, end, value): code points of the text, end exclusive, by start and
    then in the order of ``KINDS``. ``added`` are runs that the models call random (at least
    ``threshold`` per character and ``total`` in all); they overlap no base span. ``ratios``
    comes from ``train``.

    All rows and columns of ``documents`` stay, repeated rows too; a column named ``into`` is
    replaced. A null or empty text has no spans.
    """
    model = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    return documents.withColumn(into, let(text_of(text), lambda t: let(base_spans(t), lambda b: F.struct(
        b.alias("base"), F.filter(candidates(t, b), lambda c: ratio_of(c["value"], model) >= F.greatest(F.lit(threshold), F.lit(total) / F.char_length(c["value"]))).alias("added")))))
