"""Quality rules: counts of a text, and how much its n-grams look like trusted text.

Native: DataFrame functions only. A document's words and word pairs are hashed into a fixed
number of buckets. Two multinomials over the buckets, of trusted documents and of the whole
corpus, give every bucket a log-likelihood ratio; a document's score is the mean ratio of its
n-grams. Documents below a fixed threshold are rejected.

Nothing is shuffled but bucket counts (at most ``buckets`` per task); the model is a constant array of ``buckets`` numbers in the plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import if_small, let, text_of, words_of

BUCKETS = 1 << 14
#: Nats per n-gram. Clean text lies around 0, text of foreign n-grams far below.
THRESHOLD = -0.1
#: Added to each bucket's count, in both multinomials.
PRIOR = 1.0
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def ngram_buckets(words: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of all words and of all pairs of neighbours."""
    return let(words, lambda w: F.concat(
        F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int")),
        F.when(F.size(w) > 1, F.transform(
            F.sequence(F.lit(1), F.size(w) - 1),
            lambda i: F.pmod(F.xxhash64(w[i - 1], w[i]), F.lit(buckets)).cast("int"),
        )).otherwise(F.array().cast("array<int>")),
    ))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that the text holds more than once."""
    hashes = lambda w: F.when(F.size(w) >= window, F.transform(
        F.sequence(F.lit(0), F.size(w) - window),
        lambda i: F.xxhash64(*(w[i + k] for k in range(window))),
    )).otherwise(F.array().cast("array<bigint>"))
    starts = lambda order: F.sort_array(F.transform(
        F.filter(order, lambda x, j: F.coalesce(F.get(order, j - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(order, j + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"],
    ))
    ordered = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    covered = lambda at: F.aggregate(
        F.transform(at, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - x, F.lit(window)))),
        F.lit(0).cast("bigint"), lambda total, x: total + x)
    return let(words, lambda w: let(hashes(w), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), let(let(ordered(h), starts), covered)
    ).otherwise(F.lit(0).cast("bigint"))))


def ngram_model(documents: DataFrame, trusted: DataFrame, *, id_column: str = "doc_id", text: str = "text",
                buckets: int = BUCKETS, prior: float = PRIOR) -> list[float]:
    """The log-likelihood ratio of every bucket, to four places.

    The driver gets one row per bucket, however many documents there are.

    ``trusted`` holds the ids of the trusted documents; ids that are null or repeated count
    once or not at all. Without a single trusted n-gram, all ratios are 0.
    """
    good = if_small(trusted.select(F.col(id_column).alias("__good")).dropna().distinct())
    marked = documents.select(F.col(id_column).alias("__id"), text_of(text).alias("__text")).join(
        good, F.col("__id") == F.col("__good"), "left")
    counts = (
        marked.select(F.col("__good").isNotNull().alias("good"),
                      F.explode(ngram_buckets(words_of(F.col("__text")), buckets)).alias("bucket"))
        .groupBy("bucket").agg(F.count_if("good").alias("good"), F.count("*").alias("raw"))
    )
    found = {row["bucket"]: (row["good"], row["raw"]) for row in counts.collect()}
    n_good, n_raw = (sum(pair[k] for pair in found.values()) for k in (0, 1))
    if not n_good:
        return [0.0] * buckets
    shift = math.log(n_raw + prior * buckets) - math.log(n_good + prior * buckets)
    pairs = (found.get(bucket, (0, 0)) for bucket in range(buckets))
    return [round(math.log((good + prior) / (raw + prior)) + shift, 4) for good, raw in pairs]


def quality_rules(documents: DataFrame, trusted: DataFrame, *, id_column: str = "doc_id", text: str = "text",
                  into: str = "rules", buckets: int = BUCKETS, threshold: float = THRESHOLD,
                  prior: float = PRIOR) -> DataFrame:
    """``documents`` with one more column, a struct of the counts, the score and the verdict.

    All rows and columns of ``documents`` stay, repeated rows too; a column named ``into`` is
    replaced. A null or empty text has no words, the score 0 and fails the base rules. Equal
    texts get equal results. An empty table gives an empty table.

    Fields: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` (fewer than 10 words, or over a fifth of them in repeated windows),
    ``score`` and ``kept`` (not failed, and the score is at least ``threshold``).
    """
    ratios = ngram_model(documents, trusted, id_column=id_column, text=text, buckets=buckets, prior=prior)
    model = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # one constant of the plan
    return documents.withColumn(into, let(text_of(text), lambda body: let(
        words_of(body), lambda w: _verdict(body, w, model, buckets, threshold))))


def _verdict(body: Column, w: Column, model: Column, buckets: int, threshold: float) -> Column:
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    counts = F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
        let(ngram_buckets(w, buckets), lambda found: F.coalesce(F.aggregate(
            found, F.lit(0.0), lambda total, b: total + model[b]) / F.nullif(F.size(found), F.lit(0)), F.lit(0.0))).alias("score"),
    )
    failed = lambda c: (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    return let(counts, lambda c: F.struct(
        *(c[name].alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed(c).alias("base_failed"), c["score"].alias("score"),
        (~failed(c) & (c["score"] >= threshold)).alias("kept")))
