"""A rows: SQL texts, bound parameters, parameter tables, scans."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import (
    Affine, apply_many, load_parquet, measure_scan, preview, run_many, run_query, run_update, scan_geometry,
)

from .common import TABLES, new_table, read, views
from .shapes import POINT_X_SQL, POINT_Y_SQL, event_points

QUERIES = {}

FLAGSHIP = """
    SELECT n_name, o_orderpriority, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           max(o_totalprice) AS largest
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_totalprice > {low} AND c_mktsegment <> {segment}
    GROUP BY n_name, o_orderpriority
"""
FLAGSHIP_SCHEMA = (
    T.StructType().add("n_name", T.StringType()).add("o_orderpriority", T.StringType())
    .add("n_orders", T.LongType()).add("total", T.DoubleType()).add("largest", T.DoubleType())
)


def bound_join(spark, sf_dir):
    views(spark, sf_dir, "orders", "customer", "nation")
    return run_query(spark, FLAGSHIP.format(low=":1", segment=":2"), [1000.5, "MACHINERY"], FLAGSHIP_SCHEMA)


QUERIES["a1_bound_join"] = (bound_join, FLAGSHIP.format(low="1000.5", segment="'MACHINERY'"))


def sql_shape(name, spark_sql, duck_sql, *tables, params=None):
    def query(spark, sf_dir):
        views(spark, sf_dir, *tables)
        return run_query(spark, spark_sql, params)

    QUERIES[name] = (query, duck_sql)


sql_shape(
    "a1_constants",
    "SELECT o_orderkey, 42 AS int_val, 3.14D AS float_val, 'hello' AS str_val,"
    " hex(cast('bytes' AS BINARY)) AS raw_val FROM orders",
    "SELECT o_orderkey, 42 AS int_val, CAST(3.14 AS DOUBLE) AS float_val, 'hello' AS str_val,"
    " hex(encode('bytes')) AS raw_val FROM orders",
    "orders",
)
sql_shape("a1_count", *["SELECT count(*) AS n FROM lineitem"] * 2, "lineitem")
sql_shape(
    "a1_distinct_and_width",
    *["SELECT count(*) AS n, count(DISTINCT lang) AS langs, CAST(max(length(text)) AS BIGINT) AS longest FROM documents"] * 2,
    "documents",
)
sql_shape(
    "a1_value_lengths",
    *["SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE lang = 'de'"] * 2, "documents",
)
sql_shape(
    "a1_time_formats",
    "SELECT event_id, date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS micros,"
    " date_format(ts, 'yyyy-MM-dd') AS day FROM events",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS micros,"
    " strftime(ts, '%Y-%m-%d') AS day FROM events",
    "events",
)
sql_shape(
    "a1_union_sorted",
    *["SELECT name, kind FROM (SELECT c_name AS name, 'CUSTOMER' AS kind FROM customer"
      " UNION ALL SELECT s_name AS name, 'SUPPLIER' AS kind FROM supplier) q ORDER BY name, kind"] * 2,
    "customer", "supplier",
)
sql_shape(
    "a1_counted_elements",
    "SELECT e.vec_id, (SELECT count(*) FROM LATERAL explode(e.embedding) AS t(v)) AS n FROM embeddings e",
    "SELECT e.vec_id, (SELECT count(*) FROM unnest(e.embedding) AS t(v)) AS n FROM embeddings e",
    "embeddings",
)
sql_shape("a1_bound_projection", "SELECT o_orderkey, :1 AS val, ':1' AS kept FROM orders",
          "SELECT o_orderkey, CAST(42 AS BIGINT) AS val, ':1' AS kept FROM orders", "orders", params=[42])


def bound_filter(spark, sf_dir):
    views(spark, sf_dir, "orders")
    one_row = spark.range(1).selectExpr("'O' AS a", "50000.25D AS b")
    return run_query(
        spark,
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> :1 AND o_totalprice > :2 -- not :3",
        one_row,
    )


QUERIES["a2_bound_filter"] = (
    bound_filter,
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'O' AND o_totalprice > 50000.25",
)


def many_select(spark, sf_dir):
    params = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_acctbal")
    return run_many(
        read(spark, sf_dir, "orders"), params, {"o_custkey": "c_custkey"}, "select",
        where="o_totalprice > 10 * c_acctbal",
    ).frame.select("c_custkey", "c_acctbal", "o_orderkey", "o_totalprice")


QUERIES["a4_many_select"] = (
    many_select,
    "SELECT c_custkey, c_acctbal, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey"
    " WHERE c_mktsegment = 'BUILDING' AND o_totalprice > 10 * c_acctbal",
)


def _updates(spark, sf_dir):
    changes = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        "l_orderkey", F.col("l_linestatus").alias("new_status"),
        F.struct("l_shipdate", "l_linenumber", "l_linestatus").alias("seq"),
    )
    return run_many(
        read(spark, sf_dir, "orders"), changes, {"o_orderkey": "l_orderkey"}, "update",
        assign={"o_orderstatus": "new_status"}, order_by="seq",
    )


def _cheap_customers(spark, sf_dir):
    return read(spark, sf_dir, "customer").where("c_acctbal < 500").select("c_custkey")


QUERIES["a4_many_update"] = (
    lambda spark, sf_dir: _updates(spark, sf_dir).frame,
    """
    WITH last AS (
        SELECT l_orderkey, l_linestatus, row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_linestatus DESC) AS r
        FROM lineitem WHERE l_returnflag = 'R')
    SELECT o_orderkey, o_custkey, coalesce(l_linestatus, o_orderstatus) AS o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders LEFT JOIN last ON o_orderkey = l_orderkey AND r = 1
    """,
)
QUERIES["a4_many_delete"] = (
    lambda spark, sf_dir: run_many(
        read(spark, sf_dir, "orders"), _cheap_customers(spark, sf_dir), {"o_custkey": "c_custkey"}, "delete"
    ).frame,
    "SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 500)",
)


def many_update_nulls(spark, sf_dir):
    """Some order keys are missing: such a row comes before all others, and counts if it is alone."""
    changes = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr(
        "l_orderkey", "CAST(l_linenumber AS STRING) AS new_customer", "CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber END AS seq")
    return run_many(read(spark, sf_dir, "orders"), changes, {"o_orderkey": "l_orderkey"}, "update",
                    assign={"o_custkey": "new_customer"}, order_by="seq").frame.select("o_orderkey", "o_custkey")


QUERIES["a4_many_update_nulls"] = (
    many_update_nulls,
    """
    WITH last AS (
        SELECT l_orderkey, l_linenumber, row_number() OVER (
            PARTITION BY l_orderkey ORDER BY CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber END DESC NULLS LAST,
            CAST(l_linenumber AS BIGINT) DESC) AS r
        FROM lineitem WHERE l_returnflag = 'R')
    SELECT o_orderkey, CASE WHEN r = 1 THEN l_linenumber ELSE o_custkey END AS o_custkey
    FROM orders LEFT JOIN last ON o_orderkey = l_orderkey AND r = 1
    """,
)
QUERIES["a4_many_delete_self"] = (
    lambda spark, sf_dir: (lambda orders: run_many(orders, orders.where("o_totalprice > 200000"), ["o_custkey"], "delete").frame)(
        read(spark, sf_dir, "orders")),
    "SELECT * FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)",
)


def _bands(spark, sf_dir):
    """A price band per customer, some open to no row, and a null here and there."""
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "100 * abs(c_acctbal) AS low",
        "CASE WHEN c_custkey % 11 > 0 THEN 100 * abs(c_acctbal) + 10 * (c_custkey % 100) END AS high", "c_custkey % 7 AS step", "c_mktsegment AS segment")


BANDS = """bands AS (
    SELECT c_custkey, 100 * abs(c_acctbal) AS low, CASE WHEN c_custkey % 11 > 0 THEN 100 * abs(c_acctbal) + 10 * (c_custkey % 100) END AS high,
        c_custkey % 7 AS step, c_mktsegment AS segment FROM customer)"""


def many_range(spark, sf_dir):
    return run_many(read(spark, sf_dir, "orders"), _bands(spark, sf_dir).select("c_custkey", "low", "high"), {}, "select",
                    between={"o_totalprice": ("low", "high")}).frame.select("c_custkey", "o_orderkey", "o_totalprice")


QUERIES["a4_many_range"] = (
    many_range,
    f"WITH {BANDS} SELECT c_custkey, o_orderkey, o_totalprice FROM orders JOIN bands ON o_totalprice BETWEEN low AND high",
)


def many_range_update(spark, sf_dir):
    """The last band that holds an order's price sets its priority; one end of the range only for the second statement."""
    changed = run_many(read(spark, sf_dir, "orders"), _bands(spark, sf_dir), {}, "update",
                       assign={"o_orderpriority": "segment"}, order_by="step", between={"o_totalprice": ("low", "high")})
    again = run_many(changed.frame, _bands(spark, sf_dir).where("step = 3"), {}, "update",
                     assign={"o_orderstatus": "segment"}, order_by="low", between={"o_totalprice": ("low", None)})
    return again.frame.select("o_orderkey", "o_orderpriority", "o_orderstatus")


QUERIES["a4_many_range_update"] = (
    many_range_update,
    f"""WITH {BANDS},
    hits AS (SELECT o_orderkey, max({{'step': step, 'segment': segment}}) AS last FROM orders JOIN bands ON o_totalprice BETWEEN low AND high GROUP BY o_orderkey),
    over AS (SELECT o_orderkey, max({{'low': low, 'segment': segment}}) AS last FROM orders JOIN bands ON o_totalprice >= low WHERE step = 3 GROUP BY o_orderkey)
    SELECT o_orderkey, coalesce(hits.last.segment, o_orderpriority) AS o_orderpriority, coalesce(over.last.segment, o_orderstatus) AS o_orderstatus
    FROM orders LEFT JOIN hits USING (o_orderkey) LEFT JOIN over USING (o_orderkey)""",
)


def many_range_delete(spark, sf_dir):
    """By key and range of dates: items shipped within the ten days after their order was made, and what is affected."""
    orders = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate AS from_day", "o_orderdate + INTERVAL 10 DAYS AS to_day")
    gone = run_many(read(spark, sf_dir, "lineitem"), orders, {"l_orderkey": "o_orderkey"}, "delete", between={"l_shipdate": ("from_day", "to_day")})
    left = gone.frame.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.max("l_shipdate").alias("last"))
    return left.unionByName(gone.affected.select(F.lit("gone").alias("l_returnflag"), "n", F.lit(None).cast("timestamp_ntz").alias("last")))


QUERIES["a4_many_range_delete"] = (
    many_range_delete,
    """
    WITH hit AS (
        SELECT l.*, EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 10 DAYS) AS gone
        FROM lineitem l)
    SELECT l_returnflag, count(*) AS n, max(l_shipdate) AS last FROM hit WHERE NOT gone GROUP BY l_returnflag
    UNION ALL SELECT 'gone', count(*), NULL FROM hit WHERE gone
    """,
)


def many_increment(spark, sf_dir):
    """Every item of an order changes its customer number in turn: a new number, or twice the one there, or one more."""
    changes = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag = 'R' AS fresh", "CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END AS times", "l_partkey AS plus")
    changed = run_many(read(spark, sf_dir, "orders"), changes, {"o_orderkey": "l_orderkey"}, "update",
                       assign={"o_custkey": Affine(plus="plus", times="times", fresh="fresh")}, order_by="l_linenumber")
    return changed.frame.select("o_orderkey", "o_custkey", "o_totalprice")


QUERIES["a4_many_increment"] = (
    many_increment,
    """
    WITH changes AS (
        SELECT l_orderkey, list({'v': l_partkey, 'times': CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_linestatus = 'F' THEN 2 ELSE 1 END}
            ORDER BY l_linenumber, l_returnflag = 'R', CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_linestatus = 'F' THEN 2 ELSE 1 END, l_partkey) AS steps
        FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, CASE WHEN steps IS NULL THEN o_custkey ELSE CAST(list_reduce(
        list_prepend({'v': CAST(o_custkey AS BIGINT), 'times': 0}, steps), lambda x, y: {'v': x.v * y.times + y.v, 'times': 0}).v AS BIGINT) END AS o_custkey, o_totalprice
    FROM orders LEFT JOIN changes ON o_orderkey = l_orderkey
    """,
)


def applied_changes(spark, sf_dir):
    """A stored copy of orders in several files: one in a hundred is updated, a band of prices deleted, then all is read back."""
    table = new_table(spark, "a4")
    read(spark, sf_dir, "orders").repartitionByRange(8, "o_orderkey").write.saveAsTable(table)
    changes = read(spark, sf_dir, "orders").where("o_orderkey % 100 = 7").selectExpr("o_orderkey AS key", "'CHANGED' AS value", "o_orderdate AS seq")
    updated = apply_many(spark, table, changes, {"o_orderkey": "key"}, "update", assign={"o_orderpriority": "value"}, order_by="seq")
    bands = read(spark, sf_dir, "nation").selectExpr("10000.0 * n_nationkey AS low", "10000.0 * n_nationkey + 500 AS high")
    deleted = apply_many(spark, table, bands, {}, "delete", between={"o_totalprice": ("low", "high")})
    return spark.table(table).select("o_orderkey", "o_orderpriority", "o_totalprice", F.lit(updated).cast("bigint").alias("updated"), F.lit(deleted).cast("bigint").alias("deleted"))


QUERIES["a4_applied_changes"] = (
    applied_changes,
    """
    WITH hit AS (SELECT *, EXISTS (SELECT 1 FROM nation WHERE o_totalprice BETWEEN 10000 * n_nationkey AND 10000 * n_nationkey + 500) AS gone FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 7 THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority, o_totalprice,
        (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 7) AS updated, (SELECT count(*) FROM hit WHERE gone) AS deleted
    FROM hit WHERE NOT gone
    """,
)


def many_insert(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select(
        (F.lit(10_000_000) + F.col("c_custkey")).alias("key"), F.col("c_custkey").alias("cust"), "c_acctbal"
    )
    return run_many(
        read(spark, sf_dir, "orders"), rows, [], "insert",
        assign={"o_orderkey": "key", "o_custkey": "cust", "o_totalprice": "c_acctbal"},
    ).frame


QUERIES["a4_many_insert"] = (
    many_insert,
    "SELECT * FROM orders UNION ALL SELECT 10000000 + c_custkey, c_custkey, NULL, c_acctbal, NULL, NULL FROM customer",
)


def many_affected(spark, sf_dir):
    removed = run_many(
        read(spark, sf_dir, "orders"), _cheap_customers(spark, sf_dir), {"o_custkey": "c_custkey"}, "delete"
    )
    changed = _updates(spark, sf_dir)
    return (
        removed.affected.select(F.lit("delete").alias("action"), "n")
        .unionByName(changed.affected.select(F.lit("update").alias("action"), "n"))
    )


QUERIES["a4_many_affected"] = (
    many_affected,
    """
    SELECT 'delete' AS action, count(*) AS n FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 500)
    UNION ALL
    SELECT 'update', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
    """,
)


def update_statements(spark, sf_dir):
    views(spark, sf_dir, "orders")
    table = new_table(spark, "a5")
    created = run_update(spark, f"CREATE TABLE {table} (k BIGINT, price DOUBLE) USING parquet")
    first = run_update(spark, f"INSERT INTO {table} SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > :1", [1000])
    second = run_update(spark, f"INSERT INTO {table} SELECT o_orderkey, -o_totalprice FROM orders")
    return spark.table(table).agg(F.count("*").alias("n"), F.max("price").alias("highest")).select(
        F.lit(created).alias("created"), F.lit(first).cast("bigint").alias("first"),
        F.lit(second).cast("bigint").alias("second"), "n", "highest",
    )


QUERIES["a5_statements"] = (
    update_statements,
    "SELECT 0 AS created, count(*) FILTER (o_totalprice > 1000) AS first, count(*) AS second,"
    " count(*) + count(*) FILTER (o_totalprice > 1000) AS n, max(o_totalprice) AS highest FROM orders",
)


def partition_overwrite(spark, sf_dir):
    """One partition of a table is replaced; the count is of the rows written, not of the table."""
    views(spark, sf_dir, "orders")
    table = new_table(spark, "a5p")
    run_update(spark, f"CREATE TABLE {table} (k BIGINT, status STRING) USING parquet PARTITIONED BY (status)")
    whole = run_update(spark, f"INSERT INTO {table} SELECT o_orderkey, o_orderstatus FROM orders")
    part = run_update(spark, f"INSERT OVERWRITE {table} PARTITION (status = 'F') SELECT o_orderkey FROM orders WHERE o_totalprice > :1", [100000])
    return spark.table(table).groupBy("status").agg(F.count("*").alias("n")).select(
        "status", "n", F.lit(whole).cast("bigint").alias("whole"), F.lit(part).cast("bigint").alias("part"))


QUERIES["a5_partition_overwrite"] = (
    partition_overwrite,
    """SELECT status, count(*) AS n, (SELECT count(*) FROM orders) AS whole,
        (SELECT count(*) FROM orders WHERE o_totalprice > 100000) AS part
        FROM (SELECT o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'F'
              UNION ALL SELECT 'F' FROM orders WHERE o_totalprice > 100000) q GROUP BY status""",
)


def geometry_scan(spark, sf_dir):
    scanned = scan_geometry(event_points(spark, sf_dir).select("event_id", "geom"))
    tag = scanned.schema["geom"].metadata
    return scanned.select(
        "event_id", F.hex("geom").alias("wkb"),
        F.lit(tag["ARROW:extension:name"]).alias("extension"), F.lit(tag["ARROW:extension:metadata"]).alias("crs"),
    )


QUERIES["a6_geometry_scan"] = (
    geometry_scan,
    f"""SELECT event_id, hex(ST_AsWKB(CAST('POINT(' || {POINT_X_SQL} || ' ' || {POINT_Y_SQL} || ')' AS GEOMETRY))) AS wkb,
        'geoarrow.wkb' AS extension, '{{"crs":"EPSG:4326"}}' AS crs FROM events""",
)
QUERIES["a7_parquet_scan"] = (
    lambda spark, sf_dir: load_parquet(
        spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_shipdate"], "l_quantity > 45"
    ),
    "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem WHERE l_quantity > 45",
)


def all_table_counts(spark, sf_dir):
    counts = [
        read(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in TABLES
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


QUERIES["a7_table_counts"] = (
    all_table_counts, " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES)
)
QUERIES["a8_preview"] = (
    lambda spark, sf_dir: preview(
        read(spark, sf_dir, "orders").select(
            "o_orderkey", F.expr("nullif(o_orderstatus, 'F')").alias("status"), "o_totalprice", "o_orderdate"
        ).orderBy("o_orderkey")
    ),
    r"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(nullif(o_orderstatus, 'F'), 'NULL') AS status,
        regexp_replace(CAST(o_totalprice AS VARCHAR), '\.0$', '') AS o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' +0000 UTC' AS o_orderdate
        FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 20) q""",
)


def scan_count(spark, sf_dir):
    report = measure_scan(read(spark, sf_dir, "lineitem"))
    return spark.range(1).select(F.lit("lineitem").alias("name"), F.lit(report.rows).cast("bigint").alias("n"))


QUERIES["a9_scan_count"] = (scan_count, "SELECT 'lineitem' AS name, count(*) AS n FROM lineitem")
