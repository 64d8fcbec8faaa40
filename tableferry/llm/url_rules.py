"""URL filter: block and allow rules looked up by hashed host-suffix and path-prefix expressions.

A URL's host is expanded into its suffixes at dots and its path into prefixes, but only of
the sizes that some rule has. Every expression joins the rules by the first four bytes of its
digest; a full digest confirms the match, and the longest rule decides.

Addresses that occur more than once are looked up once. The rules are broadcast when they are
counted to be few; otherwise Spark shuffles both sides, and adaptive execution splits an
expression that many addresses share, because the rules' side has one row for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import if_small, text_of


def host_of(url: Column) -> Column:
    """From after the first ``://`` to the first of ``/?#``; A-Z in lower case."""
    rest = F.substring_index(F.substring(url, F.locate("://", url) + 3, F.char_length(url)), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.when(F.contains(url, F.lit("://")), F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column, host: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    rest = F.substring(url, F.locate("://", url) + 3 + F.char_length(host), F.char_length(url))
    return F.when(F.contains(url, F.lit("://")), F.substring_index(F.substring_index(rest, "?", 1), "#", 1)).otherwise("")


def _digest(host: Column, path: Column) -> Column:
    # The separator cannot occur in a host.
    return F.sha2(F.concat(host, F.lit("/"), path), 256)


def _n_labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def url_rules(pages: DataFrame, rules: DataFrame, *, url: str = "url", into: str = "url_rule",
              default: str = "allow") -> DataFrame:
    """``pages`` with one more column, a struct of ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has the columns host, path and verdict (``allow`` or ``block``). A rule fits its
    host and all subdomains when the path starts with the rule's. The rule of most characters
    wins, then the one with the longer host, then ``allow``; rules with a null are ignored and
    repeated rules count once. Without a rule the verdict is ``default`` and ``rule`` is null.

    All rows and columns of ``pages`` stay; a column named ``into`` is replaced. A null URL, or
    one without ``://``, has an empty host and path.
    """
    known = rules.select(*(F.col(c).alias(c) for c in ("host", "path", "verdict"))).dropna().distinct()
    sizes = known.agg(F.collect_set(_n_labels(F.col("host"))).alias("depths"), F.collect_set(F.char_length("path")).alias("lengths")).first()
    depths, lengths = sorted(sizes["depths"]), sorted(sizes["lengths"])
    located = pages.withColumn(into, F.struct(host_of(text_of(url)).alias("host"))).withColumn(
        into, F.struct(F.col(f"{into}.host"), path_of(text_of(url), F.col(f"{into}.host")).alias("path")))
    addresses = located.select(F.col(f"{into}.host").alias("__host"), F.col(f"{into}.path").alias("__path")).distinct()
    labels = F.split("__host", r"\.", -1)
    suffixes = F.array_distinct(F.array(*(
        F.when(F.size(labels) >= n, F.substring_index("__host", ".", -n)) for n in depths)).cast("array<string>"))
    prefixes = F.array_distinct(F.array(*(
        F.when(F.char_length("__path") >= n, F.substring("__path", 1, n)) for n in lengths)).cast("array<string>"))
    expressions = (
        addresses.select("__host", "__path", F.explode(suffixes).alias("__suffix"), prefixes.alias("__prefixes"))
        .select("__host", "__path", "__suffix", F.explode("__prefixes").alias("__prefix"))
        .where("__suffix IS NOT NULL AND __prefix IS NOT NULL")
        .select("__host", "__path", _digest(F.col("__suffix"), F.col("__prefix")).alias("__digest"))
        .withColumn("__key", F.substring("__digest", 1, 8))
    )
    table = known.select("host", "path", "verdict", _digest(F.col("host"), F.col("path")).alias("digest"))
    table = table.withColumn("key", F.substring("digest", 1, 8))
    found = (
        expressions.join(if_small(table), F.col("__key") == F.col("key"))
        .where(F.col("__digest") == F.col("digest"))
        .groupBy("__host", "__path")
        .agg(F.max(F.struct(
            (F.char_length("host") + F.char_length("path")).alias("size"), F.char_length("host").alias("part"),
            (F.col("verdict") == "allow").alias("allows"), F.concat("host", "path").alias("rule"), F.col("verdict"),
        )).alias("__best"))
    )
    judged = located.join(found, (F.col(f"{into}.host") == F.col("__host")) & (F.col(f"{into}.path") == F.col("__path")), "left")
    return judged.withColumn(into, F.struct(
        F.col(f"{into}.host"), F.col(f"{into}.path"), F.col("__best.rule").alias("rule"),
        F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict"),
    )).drop("__host", "__path", "__best")
