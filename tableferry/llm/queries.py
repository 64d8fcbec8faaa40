"""The queries of this package over the given tables, and their DuckDB statements.

``QUERIES``: name -> (callable(spark, sf_dir), SQL text or None where SQL cannot express it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.chat import collapse_and_render
from tableferry.llm.common import read
from tableferry.llm.compression_quality import compression_quality, fit
from tableferry.llm.decontaminate import decontaminate
from tableferry.llm.filter_audit import failing_ids, filter_audit, text_filters
from tableferry.llm.ngram_join import ngram_join
from tableferry.llm.ngram_lm import score_texts
from tableferry.llm.packing import pack
from tableferry.llm.pii import KINDS, find_pii
from tableferry.llm.quality_rules import quality_rules
from tableferry.llm.ranked_search import ranked_search
from tableferry.llm.secret_scan import KINDS as SECRET_KINDS
from tableferry.llm.secret_scan import find_secrets, labelled_samples, train
from tableferry.llm.sharding import MULTIPLIER, SHARDS, shard_slots
from tableferry.llm.url_rules import url_rules


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good and not toxic."""
    return read(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")


# The rules of the query's contract: host, path, verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

SQL_OP2 = """
WITH rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
    SELECT page_id,
        translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
        row_number() OVER () AS n
    FROM pages),
fits AS (
    SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
    FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY n)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (n)
"""

SQL_OP6 = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, count(*) AS n_turns, list({'role': role, 'text': text} ORDER BY turn, role, text) AS body,
        string_agg('<|im_start|>' || role || chr(10) || replace(replace(text, '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>')
            || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text
    FROM turns GROUP BY conv_id),
prefixes AS (SELECT DISTINCT body[:k] AS body FROM (SELECT body, unnest(range(1, n_turns)) AS k FROM convs)),
firsts AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies FROM convs GROUP BY body)
SELECT conv_id, 0 AS part, n_turns, n_copies, text
FROM firsts JOIN convs USING (conv_id) WHERE NOT EXISTS (SELECT 1 FROM prefixes WHERE prefixes.body = convs.body)
"""


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(read(spark, sf_dir, "documents"), crc_of_id(10) != 0)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules(read(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "url_rule.*")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_and_render(read(spark, sf_dir, "conversations"))


def crc_of_id(divisor: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, read(spark, sf_dir, "labels").where(crc_of_id(3) != 1))
    scored = compression_quality(documents, model)
    return scored.select("doc_id", (crc_of_id(3) == 1).alias("held_out"), "quality_score.score", "quality_score.predicted")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(documents, train(labelled_samples(documents)))
    count = lambda kind: F.size(F.filter("secrets.base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, SECRET_KINDS[:3]), F.sha2(spans_text(F.col("secrets.base")), 256).alias("base_sha256"),
                        spans_text(in_order(F.concat("secrets.base", "secrets.added"), SECRET_KINDS)).alias("spans"))


SQL_OP5 = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS w
    FROM documents),
i AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS body
    FROM i, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS body
    FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(p) WHERE len(w) >= size),
hits AS (SELECT doc_id, p, size, item_id FROM places JOIN windows USING (size, body)),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + size)) AS t(q) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def n_hit(overlap: str) -> Column:
    """Words inside benchmark windows."""
    return F.aggregate(f"{overlap}.spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])


def is_contaminated(overlap: str) -> Column:
    """At least a twentieth of the words, and one, are inside benchmark windows."""
    return (n_hit(overlap) > 0) & (20 * n_hit(overlap) >= F.col(f"{overlap}.n_words"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "overlap.n_words", n_hit("overlap").alias("n_hit"), F.size("overlap.items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("overlap.items", ","), 256).alias("items_sha256"), is_contaminated("overlap").alias("contaminated"))


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Ranks and pattern of an installed vocabulary; read here once and sent to the tasks.

    It is the vocabulary of ``byte_bpe_50k.json`` and gives the same ids.
    """
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="ascii") as file:
        return file.read(), public_tokenizers.PATTERN


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"), *vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def in_order(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans by start, then by the place of their kind in ``kinds``."""
    place = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"])
    rows = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], place(s), s["end"], s.alias("span"))))
    return F.transform(rows, lambda x: x["span"])


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(spans_text(F.col("pii.base")), 256).alias("base_sha256"),
                        spans_text(in_order(F.concat("pii.base", "pii.added"), KINDS)).alias("spans"))


SQL_OP9 = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w
    FROM documents),
sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS shingle
    FROM d, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text"), trusted_ids(spark, sf_dir))
    return marked.select("doc_id", "rules.n_words", "rules.word_chars", "rules.n_symbols", "rules.n_dup_lines",
                         "rules.n_repeat_words", "rules.base_failed", "rules.score", "rules.kept")


SQL_OP11 = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w
    FROM documents),
fails AS (
    SELECT doc_id, part,
        CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
    FROM d),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS before FROM orders, unnest(range(1, 6)) AS t(step)),
marked AS (
    SELECT part, failed, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
    FROM fails),
patterns AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY ALL),
found AS (
    SELECT part, filter_order, step, f,
        CAST(sum(CASE WHEN translate(before || f, failed, '') = before || f THEN n ELSE 0 END) AS BIGINT) AS kept,
        CAST(sum(CASE WHEN contains(failed, f) AND translate(before, failed, '') = before THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN contains(failed, f) AND translate(before, failed, '') <> before THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN failed = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN contains(failed, f) AND translate(before, failed, '') = before THEN good ELSE 0 END) AS BIGINT) AS good_lost,
        CAST(sum(CASE WHEN contains(failed, f) AND translate(before, failed, '') = before THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM patterns, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM found
"""


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = failing_ids(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), text_filters(), repeats="E")
    labels = read(spark, sf_dir, "labels")
    return filter_audit(failing, {"good": labels.where("quality = 1"), "toxic": labels.where("toxic = 1")})


SQL_OP12 = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term
    FROM documents),
counted AS (SELECT row, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
lengths AS (SELECT row, sum(tf)::BIGINT AS n FROM counted GROUP BY row),
total AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM lengths),
i AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term
    FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS q FROM i GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM counted, total WHERE term IN (SELECT term FROM asked) GROUP BY term, nd),
scores AS (
    SELECT item_id, row, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (row), total GROUP BY ALL),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
"""


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))


def _crc_of_nibble(n: int) -> int:
    for _ in range(4):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


SQL_OP13 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
            string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(.)(.)', '\\2\\1', 'g'), ''), lambda h: CAST(strpos('0123456789ABCDEF', h) - 1 AS BIGINT))),
            lambda crc, h: CASE WHEN h < 0 THEN crc ELSE xor(crc >> 4, CAST({[_crc_of_nibble(n) for n in range(16)]} AS BIGINT[])[(xor(crc, h) & 15) + 1]) END)) AS text_crc32
    FROM documents),
walk(doc_id, key, pos, coming) AS (
    SELECT DISTINCT doc_id, CASE WHEN doc_id < 0 THEN doc_id + 18446744073709551616::HUGEINT ELSE coalesce(doc_id, 0)::HUGEINT END, -1::BIGINT, 0::BIGINT FROM documents
    UNION ALL
    SELECT doc_id, k, coming, CAST(floor((coming + 1)::DOUBLE * (2147483648::DOUBLE / (k // 8589934592 + 1)::DOUBLE)) AS BIGINT)
    FROM (SELECT doc_id, pos, coming, (key * {MULTIPLIER} + 1) % 18446744073709551616::HUGEINT AS k FROM walk WHERE coming <= {SHARDS})),
shards AS (SELECT doc_id, max(pos) FILTER (pos < {SHARDS}) AS shard, max(pos) AS grown FROM walk GROUP BY doc_id)
SELECT d.doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY d.doc_id, size, text_crc32) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM d JOIN shards ON d.doc_id IS NOT DISTINCT FROM shards.doc_id
"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_slots(read(spark, sf_dir, "documents"), SHARDS).withColumn("law", F.lit("key"))


QUERIES = {
    "op1_lm_scoring": (op1, None),
    "op2_url_rules": (op2, SQL_OP2),
    "op3_compression_quality": (op3, None),
    "op4_secret_scan": (op4, None),
    "op5_decontamination": (op5, SQL_OP5),
    "op6_chat_format": (op6, SQL_OP6),
    "op7_packing": (op7, None),
    "op8_pii": (op8, None),
    "op9_ngram_join": (op9, SQL_OP9),
    "op10_quality_rules": (op10, None),
    "op11_filter_audit": (op11, SQL_OP11),
    "op12_ranked_search": (op12, SQL_OP12),
    "op13_sharding": (op13, SQL_OP13),
}
