"""A and D rows that move a table in parts: planned splits, loads in commit groups, folded stream batches."""

from pyspark.sql import functions as F

from tableferry import LoadStopped, compact_stream, ingest, ingest_groups, ingest_stream, loaded_rows, plan_splits, profile_stored, record_bytes, split_number
from tableferry.session import shared_folder

from .common import new_table, read

QUERIES = {}
SPLIT_KEYS = {"l_orderkey": "l_orderkey", "hot": "CASE WHEN l_linenumber % 3 = 0 THEN 77 ELSE l_orderkey END",
              "gaps": "nullif(l_linenumber, 2) * l_orderkey", "day": "l_shipdate"}


def planned_splits(spark, sf_dir):
    """Lines by the split they are in, told apart by one condition each; no split is much heavier than the mean."""
    result = None
    for name, key in SPLIT_KEYS.items():
        lines = read(spark, sf_dir, "lineitem").select("*", F.expr(key).alias("split_key"))
        splits = plan_splits(lines, "split_key", 8)
        hits = sum((F.coalesce(F.expr(s.condition), F.lit(False)).cast("int") for s in splits), F.lit(0))
        parts = lines.groupBy(split_number(splits).alias("split")).agg(
            F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"), F.min(hits).alias("least"), F.max(hits).alias("most"),
            F.min("split_key").alias("low"), F.max("split_key").alias("high"))
        planned = F.create_map(*[F.lit(x) for number, s in enumerate(splits) for x in (number, s.rows)])
        total = sum(s.weight for s in splits if not s.condition.endswith("` IS NULL"))
        even = F.create_map(*[F.lit(x) for number, s in enumerate(splits) for x in (number, s.weight <= 1.5 * total / 8)])
        rows = parts.agg(
            F.sum("n").alias("n"), F.sum("quantity").alias("quantity"), F.min("least").alias("least"), F.max("most").alias("most"),
            F.bool_and(F.col("n") == planned[F.col("split")]).alias("as_planned"),
            F.bool_and(even[F.col("split")] | F.col("low").eqNullSafe(F.col("high"))).alias("even"),
        ).select(F.lit(name).alias("key"), "*")
        result = rows if result is None else result.unionByName(rows)
    return result


QUERIES["a7_planned_splits"] = (
    planned_splits,
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"key\", count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity, 1 AS least, 1 AS most,"
        " true AS as_planned, true AS even FROM lineitem" for name in SPLIT_KEYS),
)


def resumed(spark, sf_dir):
    """A load that fails in its third group of five, and goes on from there."""
    table, lines = new_table(spark, "d9r"), read(spark, sf_dir, "lineitem")
    splits = plan_splits(lines, "l_orderkey", 5)
    broken = lines.withColumn("l_tax", F.when(F.expr(splits[2].condition), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("l_tax")))
    committed = 0
    try:
        ingest_groups(broken, table, "first", splits)
    except LoadStopped as stop:
        committed = stop.rows
    done = ingest_groups(lines, table, "first", splits)
    again = ingest_groups(lines, table, "first", splits)  # a finished load changes nothing
    return spark.table(table).groupBy("L_RETURNFLAG").agg(
        F.count("*").alias("n"), F.sum("L_ORDERKEY").alias("keys"), F.sum("L_LINENUMBER").alias("numbers"),
    ).select("*", F.lit(done.rows).cast("bigint").alias("reported"), F.lit(committed == splits[0].rows + splits[1].rows > 0).alias("kept"),
             F.lit(again.rows == done.rows).alias("harmless"))


QUERIES["d9_resumed"] = (
    resumed,
    """SELECT l_returnflag AS "L_RETURNFLAG", count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(sum(l_linenumber) AS BIGINT) AS numbers,
        (SELECT count(*) FROM lineitem) AS reported, true AS kept, true AS harmless FROM lineitem GROUP BY l_returnflag""",
)


def compacted(spark, sf_dir):
    """Lines that arrive in eight files, one micro-batch each, folded on the way and at the end."""
    table = new_table(spark, "d7c")
    folder, checkpoint = f"{shared_folder(spark)}/{table}_in", f"{shared_folder(spark)}/{table}"
    lines = read(spark, sf_dir, "lineitem")
    lines.repartition(8, "l_orderkey").write.option("maxRecordsPerFile", 0).parquet(folder)
    arriving = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    ingest_stream(arriving, table, checkpoint, compact_every=3).awaitTermination()
    compact_stream(spark, table)
    left = spark.sql(f"SHOW PARTITIONS {table}").count()
    return loaded_rows(spark, table).groupBy("L_RETURNFLAG").agg(
        F.count("*").alias("n"), F.sum(F.col("L_QUANTITY").cast("bigint")).alias("quantity"), F.sum("L_ORDERKEY").alias("keys"),
    ).select("*", F.lit(left <= 2).alias("folded"))


QUERIES["d7_stream_compacted"] = (
    compacted,
    'SELECT l_returnflag AS "L_RETURNFLAG", count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,'
    " CAST(sum(l_orderkey) AS BIGINT) AS keys, true AS folded FROM lineitem GROUP BY l_returnflag",
)


DEALT = {"by_source": lambda d: d.repartition(32, "source"), "small": lambda d: d.repartition(48), "one": lambda d: d.repartition(1)}


def by_size(spark, sf_dir):
    """Six files of the same size, whether one source holds most rows, all partitions are small, or there is one."""
    documents, result = read(spark, sf_dir, "documents"), None
    total, largest = documents.select(record_bytes(documents.schema).alias("b")).agg(F.sum("b"), F.max("b")).first()
    for name, deal in DEALT.items():
        table, size = new_table(spark, f"d8s_{name}"), total // 6 + 1
        ingest(deal(documents), table, options={"ingest_file_bytes": size})
        stored = spark.table(table)
        by_file = stored.select("DOC_ID", record_bytes(stored.schema).alias("b"), F.input_file_name().alias("file")).groupBy("file").agg(
            F.count("*").alias("n"), F.sum("DOC_ID").alias("ids"), F.sum("b").alias("bytes"))
        rows = by_file.agg(F.count("*").alias("files"), F.sum("n").alias("n"), F.sum("ids").alias("ids"), F.sum("bytes").alias("bytes"),
                           (F.max("bytes") <= 2 * size + largest).alias("even")).select(F.lit(name).alias("dealt"), "*")
        result = rows if result is None else result.unionByName(rows)
    return result


_BYTES = " + ".join(["16", *[f"coalesce(octet_length(encode({c})), 0)" for c in ("text", "lang", "source")]])
QUERIES["d8_by_size"] = (
    by_size,
    " UNION ALL ".join(
        f"SELECT '{name}' AS dealt, 6 AS files, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids, CAST(sum({_BYTES}) AS BIGINT) AS bytes,"
        " true AS even FROM documents" for name in DEALT),
)


def stored_widths(spark, sf_dir):
    """Widths after a load and after an append; the second time only the appended files are read."""
    table, documents, result = new_table(spark, "s1p"), read(spark, sf_dir, "documents"), None
    for step, rows in enumerate((documents.where("n_chars < 1000"), documents.where("n_chars >= 1000 OR n_chars IS NULL"))):
        before = set(spark.table(table).inputFiles()) if step else set()
        ingest(rows, table, "append" if step else "create", {"clob_columns": "text,lang,source"} if step else None)
        spark.catalog.refreshTable(table)
        new = set(spark.table(table).inputFiles()) - before
        found = profile_stored(spark, table)
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(w).cast("bigint").alias("max_bytes")) for c, w in found.widths.items()])
        rows = spark.range(1).select(F.lit(step).alias("step"), F.lit(found.files_read == len(new)).alias("new_only"), F.inline(pairs))
        result = rows if result is None else result.unionByName(rows)
    return result


QUERIES["s1_stored_widths"] = (
    stored_widths,
    " UNION ALL ".join(
        f"SELECT {step} AS step, true AS new_only, '{c.upper()}' AS \"column\", coalesce(max(octet_length(encode({c}))), 0) AS max_bytes"
        f" FROM documents WHERE {where}" for step, where in enumerate(("n_chars < 1000", "true")) for c in ("text", "lang", "source")),
)
