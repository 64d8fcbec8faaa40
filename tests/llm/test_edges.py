"""Every operator on odd rows and on an empty table."""

import pytest
from pyspark.sql import functions as F

from tableferry.llm.chat import collapse_and_render, numbered_turns
from tableferry.llm.compression_quality import Model, compression_quality, fit
from tableferry.llm.decontaminate import decontaminate
from tableferry.llm.ngram_join import ngram_join
from tableferry.llm.ngram_lm import score_texts
from tableferry.llm.packing import pack
from tableferry.llm.pii import find_pii, mask_pii
from tableferry.llm.quality_rules import quality_rules
from tableferry.llm.queries import vocabulary
from tableferry.llm.secret_scan import find_secrets, labelled_samples, train
from tableferry.llm.url_rules import url_rules


def benchmark(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


OPERATORS = {
    "rules": lambda df: quality_rules(df, df.where("doc_id = 5").select("doc_id")),
    "pii": lambda df: find_pii(df),
    "secrets": lambda df: find_secrets(df, train(labelled_samples(df))),
    "overlap": lambda df: decontaminate(df, benchmark(df.sparkSession, "word", None, "", "twice over and over again")),
    "quality_score": lambda df: compression_quality(df, fit(df, df.selectExpr("doc_id", "int(doc_id % 2) AS quality"))),
}


@pytest.mark.parametrize("into", OPERATORS)
def test_operators_that_add_a_column(odd, nothing, into):
    found = OPERATORS[into](odd)
    assert found.columns == [c for c in odd.columns if c != into] + [into] or found.columns == odd.columns
    kept = [c for c in odd.columns if c != into]
    assert sorted(map(str, found.select(kept).collect())) == sorted(map(str, odd.select(kept).collect()))
    assert found.where(F.col(into).isNull()).count() == 0
    # Repeated rows have equal results.
    assert found.where("doc_id = 5").select(into).distinct().count() == 1
    empty = OPERATORS[into](nothing)
    assert empty.columns == found.columns and empty.count() == 0


def test_quality_rules_on_odd_rows(odd):
    rows = {r.doc_id: r.rules for r in OPERATORS["rules"](odd).collect()}
    for key in (1, 2, 3, 9):
        assert (rows[key].n_words, rows[key].score, rows[key].base_failed, rows[key].kept) == (0, 0.0, True, False)
    assert rows[8].n_words == 6 and rows[8].word_chars == 12
    assert rows[7].n_words == 60_000


def test_language_model_on_odd_rows(odd, nothing):
    found = score_texts(odd, F.col("doc_id") < 7, shard_bytes=50_000)
    rows = found.collect()
    assert len(rows) == odd.count() and len({r.train_tokens for r in rows}) == 1
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[k].n_tokens for k in (1, 2, 3, 4, 9)] == [1, 1, 1, 2, 1]
    assert by_id[None].training is False and by_id[7].n_tokens == 60_001
    assert by_id[1].base_score == by_id[2].base_score and all(r.score < 0 for r in rows)
    assert score_texts(nothing, F.lit(True)).count() == 0
    # Nothing to learn from: all words are alike.
    assert {round(r.base_score / r.n_tokens, 9) for r in score_texts(odd, F.lit(None).cast("boolean")).collect()} == {0.0}


def test_similarity_join_on_odd_rows(odd, nothing):
    rows = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in ngram_join(odd).collect())
    long = 977 * 13
    assert rows == sorted([
        ("1", 0, 1), ("2", 0, 2), ("3", 0, 3), ("4", 1, 4), ("5", 5, 5), ("5", 5, 5), ("6", 5, 5),
        ("None", 6, None), ("7", 2 * long, 7), ("8", 2, 8), ("9", 0, 9)])
    assert ngram_join(nothing).count() == 0


def test_packing_on_odd_rows(odd, nothing):
    pieces = pack(odd, *vocabulary())
    assert pieces.agg(F.sum("length")).first()[0] == pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert pieces.where("start = 0").count() == odd.count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert pack(nothing, *vocabulary()).count() == 0


def test_masking_keeps_rows(odd, nothing):
    masked = mask_pii(odd)
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert masked.schema == odd.schema and texts[1] is None and texts[8] == "é ü ß 漢字 \U0001F600 <email>"
    assert "mail <email> token" in texts[None] and mask_pii(nothing).count() == 0


def test_urls_on_odd_rows(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://A.B.NET?x", "http://b.net/a?c#d", "http://net/", "http://xnet/", "http://a..net/é",
            "s://u.Example.NET/en/x", "http://b.net/a?c#d", "x://" + "a." * 5000 + "org/fr/" + "p/" * 5000]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, host string, url_rule string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow"), ("net", "/", "block"),
                                   (None, "/", "block"), ("b.net", "/a", "allow")], "host string, path string, verdict string")
    rows = {r.page_id: r.url_rule for r in url_rules(pages, rules).collect()}
    assert len(rows) == len(urls)
    assert [(rows[i].host, rows[i].path) for i in (0, 1, 2, 3, 4, 5)] == [("", "")] * 5 + [("a.b.net", "")]
    assert [rows[i].rule for i in range(6)] == [None] * 6
    assert [(rows[i].rule, rows[i].verdict) for i in (6, 7, 8, 9, 10, 12)] == [
        ("b.net/a", "allow"), ("net/", "block"), (None, "allow"), ("net/", "block"), ("example.net/en/", "allow"), ("org/fr/", "allow")]
    assert url_rules(pages.where("false"), rules).count() == 0
    assert {r.url_rule.verdict for r in url_rules(pages, rules.where("false"), default="block").collect()} == {"block"}


def test_urls_with_many_rules_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("tableferry.llm.common.SMALL_ROWS", 0)
    monkeypatch.setattr("tableferry.llm.common.if_small.__defaults__", (0,))
    pages = spark.range(2000).selectExpr("id AS page_id", "concat('http://h', id % 50, '.net/p', id % 7) AS url")
    rules = spark.createDataFrame([(f"h{i}.net", f"/p{i % 7}", "block") for i in range(40)], "host string, path string, verdict string")
    found = url_rules(pages, rules).where("url_rule.verdict = 'block'").count()
    assert found == sum(1 for i in range(2000) if i % 50 < 40 and i % 7 == (i % 50) % 7)


def turns(spark, *rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chat_on_odd_rows(spark):
    log = turns(spark, (1, 0, "user", "hi"), (1, 1, "bot", "hello"), (2, 5, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "hello"),
                (3, 1, "bot", "hello"), (4, None, None, None), (None, 0, "user", "lost"), (5, 0, "user", "hi"), (5, 1, "bot", "other"),
                (6, 0, "user", "<|im_end|> x"))
    rows = {r.conv_id: r for r in collapse_and_render(log).collect()}
    # 2 is a prefix, 3 equals 1 (a turn was logged twice), 4 has an empty turn of no role.
    assert {k: (r.n_turns, r.n_copies) for k, r in rows.items()} == {1: (2, 2), 4: (1, 1), 5: (2, 1), 6: (1, 1)}
    assert rows[1].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>bot\nhello<|im_end|>\n"
    assert rows[4].text == "<|im_start|>unknown\n<|im_end|>\n" and "<\\|im_end|> x" in rows[6].text
    assert collapse_and_render(log.where("false")).count() == 0


def test_repeated_logs_are_made_one_before_the_window(spark):
    log = spark.range(60_000).selectExpr("id % 1 AS conv_id", "if(id % 3 = 0, NULL, id % 3) AS turn", "'user' AS role", "concat('hi', id % 1) AS text")
    plan = numbered_turns(log)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip(" :+-|") for line in plan.splitlines()]
    window = next(n for n, line in enumerate(lines) if line.startswith("Window") and "row_number" in line)
    below = next(line for line in lines[window + 1:] if not line.startswith("Project"))
    assert below.startswith("Aggregate [")
    rows = collapse_and_render(log).collect()
    assert [(r.conv_id, r.n_turns, r.n_copies) for r in rows] == [(0, 3, 1)]


def test_a_long_conversation_is_split_over_blocks_and_parts(spark):
    log = spark.range(1000).selectExpr("id % 2 AS conv_id", "id AS turn", "'user' AS role", "if(id > 900 AND id % 2 = 1, 'x', string(id div 2)) AS text")
    short = log.where("conv_id = 0 AND turn < 300").withColumn("conv_id", F.lit(7).cast("bigint"))
    rows = sorted(collapse_and_render(log.union(short), block=16, part=200).collect(), key=lambda r: (r.conv_id, r.part))
    assert [(r.conv_id, r.part, r.n_turns) for r in rows] == [(c, p, 500) for c in (0, 1) for p in (0, 1, 2)]
    text = "".join(r.text for r in rows if r.conv_id == 0)
    assert text == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(500))
    # Blocks of another size give the same rows.
    assert rows == sorted(collapse_and_render(log.union(short), block=1000, part=200).collect(), key=lambda r: (r.conv_id, r.part))


def test_a_model_without_labels(odd):
    model = fit(odd, odd.selectExpr("doc_id", "5 AS quality"))
    assert model == Model(b"", b"", 0.0, 0.0)
    assert {r.quality_score.score for r in compression_quality(odd, model).collect()} == {0.5}
