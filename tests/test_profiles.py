"""Widths kept per file: equal to a full scan, read from new files only."""

import pytest
from pyspark.sql import functions as F

from tableferry import InvalidArgument, NotFound, apply_many, ingest, load_parquet, plan_columns, plan_stored, profile_stored, profile_text
from tableferry.operators.folder import table_folder


def scanned(spark, table):
    return {r["column"]: r.max_bytes for r in profile_text(spark.table(table)).collect()}


def files(spark, table):
    return set(spark.table(table).inputFiles())


def test_appends_updates_and_deletions(spark, tiny, table):
    documents = load_parquet(spark, f"{tiny}/documents.parquet").select("doc_id", "text", "source", "n_chars")
    ingest(documents.where("doc_id < 100").repartition(3), table, options={"clob_columns": "text,source"})
    first = profile_stored(spark, table)
    assert (first.widths, first.files_read) == (scanned(spark, table), len(files(spark, table)))
    assert profile_stored(spark, table).files_read == 0
    before = files(spark, table)
    ingest(documents.where("doc_id >= 100").repartition(2), table, "append")
    second = profile_stored(spark, table)
    assert (second.widths, second.files_read) == (scanned(spark, table), len(files(spark, table) - before))
    # The row with the widest text goes: its file is another now.
    widest = spark.table(table).orderBy(F.octet_length("TEXT").desc()).limit(1).select("DOC_ID")
    before = files(spark, table)
    apply_many(spark, table, widest, ["DOC_ID"], "delete")
    third = profile_stored(spark, table)
    assert (third.widths, third.files_read) == (scanned(spark, table), len(files(spark, table) - before))
    assert third.widths["TEXT"] < second.widths["TEXT"] and third.files_read < len(files(spark, table))
    assert plan_stored(spark, table, {"max_string_size": "extended"}) == plan_columns(spark.table(table), {"max_string_size": "extended"})
    # The profile is no part of the table.
    assert spark.table(table).count() == documents.count() - 1


def test_a_profile_that_is_lost_or_half_written_is_made_again(spark, table):
    ingest(spark.createDataFrame([(1, "aé"), (2, None)], "id int, t string"), table)
    assert profile_stored(spark, table).widths == {"T": 3}
    folder = table_folder(spark, table)
    kept = [name for name in folder.files("_tableferry_widths") if name.startswith("profile-")]
    folder.move(folder.at("_tableferry_widths", kept[0]), folder.at("_tableferry_widths", "staged-1"))
    again = profile_stored(spark, table)
    assert again.widths == {"T": 3} and again.files_read > 0
    assert profile_stored(spark, table).files_read == 0


def test_new_columns_no_text_and_no_rows(spark, table):
    spark.sql(f"CREATE TABLE {table} (k INT) USING parquet")
    assert profile_stored(spark, table).widths == {}
    spark.sql(f"INSERT INTO {table} VALUES (1)")
    assert profile_stored(spark, table).widths == {}
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`a b` STRING)")
    assert profile_stored(spark, table).widths == {"a b": 0}
    spark.sql(f"INSERT INTO {table} VALUES (2, 'xyz'), (3, NULL)")
    assert profile_stored(spark, table).widths == {"a b": 3}
    spark.sql(f"TRUNCATE TABLE {table}")
    assert profile_stored(spark, table).widths == {"a b": 0}


def test_refused_tables(spark, table):
    with pytest.raises(NotFound):
        profile_stored(spark, table)
    spark.createDataFrame([(1, "a")], "k int, p string").write.partitionBy("p").saveAsTable(table)
    with pytest.raises(InvalidArgument):
        profile_stored(spark, table)
