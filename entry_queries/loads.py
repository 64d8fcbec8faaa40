"""S and D rows: text sizing, column plans, and loads in every mode."""

from pyspark.sql import functions as F

from tableferry import (
    InvalidArgument, batch_bind_kind, ddl_frame, ingest, ingest_stream, load_parquet,
    loaded_rows, normalise_names, plan_columns, plan_frame, profile_text, record_bytes,
    scan_window, violations,
)
from tableferry.plans.columns import declared_width
from tableferry.session import shared_folder

from .common import new_table, read
from .geometries import SPOILT, spoilt


QUERIES = {}
_OCTETS = lambda c: f"octet_length(encode({c}))"
TEXTS = {"documents": ("text", "lang", "source"), "pages": ("url", "html"), "conversations": ("role", "text"),
         "benchmark": ("text",)}


def widths(spark, sf_dir):
    profiles = [profile_text(read(spark, sf_dir, t)).select(F.lit(t).alias("table"), "column", "max_bytes") for t in TEXTS]
    result = profiles[0]
    for more in profiles[1:]:
        result = result.unionByName(more)
    return result


QUERIES["s1_text_widths"] = (
    widths,
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", coalesce(max({_OCTETS(c)}), 0) AS max_bytes FROM {t}"
        for t, columns in TEXTS.items() for c in columns
    ),
)


def _declared_sql(width, limit):
    bucket = f"((greatest({width}, 1) * 2 + 79) // 64) * 64"
    inline = f"CASE WHEN {width} <= 4000 THEN least({bucket}, 4000) ELSE {bucket} END"
    return f"least(greatest({inline}, 64), {limit})"


QUERIES["s3_declared_width"] = (
    lambda spark, sf_dir: read(spark, sf_dir, "documents").select(
        "doc_id", declared_width("octet_length(text)", 4000).alias("standard"),
        declared_width("octet_length(text)", 32767).alias("extended"),
    ),
    f"""SELECT doc_id, {_declared_sql(_OCTETS('text'), 4000)} AS standard,
        {_declared_sql(_OCTETS('text'), 32767)} AS extended FROM documents""",
)

PLANS = {
    "auto": {}, "extended": {"max_string_size": "extended"}, "clob": {"string_type": "clob"},
    "varchar2": {"string_type": "VARCHAR2"}, "named": {"ingest.clob_columns": " lang ,source"},
    "unscanned": {"type_scan_limit_bytes": 0},
}


def column_types(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    result = None
    for name, options in PLANS.items():
        rows = plan_frame(documents, options).select(F.lit(name).alias("variant"), "*")
        result = rows if result is None else result.unionByName(rows)
    return result


def _plan_sql(name, position, column, width, declared):
    kind = "bigint" if column in ("doc_id", "n_chars") else "string"
    return (f"SELECT '{name}' AS variant, {position} AS position, '{column.upper()}' AS name, '{kind}' AS source_type,"
            f" CAST({width} AS BIGINT) AS width, {declared} AS declared, true AS nullable FROM w")


def _plan_oracle():
    rows = []
    for name, options in PLANS.items():
        limit = 32767 if name == "extended" else 4000
        for position, column in enumerate(("doc_id", "text", "lang", "source", "n_chars"), start=1):
            if column in ("doc_id", "n_chars"):
                rows.append(_plan_sql(name, position, column, "NULL", "'NUMBER(19)'"))
            elif name == "clob" or (name == "named" and column != "text"):
                rows.append(_plan_sql(name, position, column, "NULL", "'CLOB'"))
            elif name in ("varchar2", "unscanned"):
                rows.append(_plan_sql(name, position, column, "NULL", "'VARCHAR2(4000)'"))
            else:
                rows.append(_plan_sql(
                    name, position, column, column,
                    f"CASE WHEN {column} > {limit} THEN 'CLOB' ELSE 'VARCHAR2(' || {_declared_sql(column, limit)} || ')' END"))
    return (f"WITH w AS (SELECT max({_OCTETS('text')}) AS text, max({_OCTETS('lang')}) AS lang,"
            f" max({_OCTETS('source')}) AS source FROM documents) " + " UNION ALL ".join(rows))


QUERIES["s4_column_types"] = (column_types, _plan_oracle())


def _batched(spark, sf_dir):
    return read(spark, sf_dir, "documents").withColumn("batch", F.expr("doc_id div 100"))


WINDOW = 400_000
_ROW_BYTES = f"16 + coalesce({_OCTETS('text')}, 0) + coalesce({_OCTETS('lang')}, 0) + coalesce({_OCTETS('source')}, 0)"
QUERIES["s6_scan_window"] = (
    lambda spark, sf_dir: scan_window(_batched(spark, sf_dir), "batch", WINDOW),
    f"""SELECT *, bytes_before < {WINDOW} AS scanned FROM (
        SELECT batch, n_rows, bytes, text, lang, source,
               CAST(coalesce(sum(bytes) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bytes_before
        FROM (SELECT doc_id // 100 AS batch, count(*) AS n_rows, CAST(sum({_ROW_BYTES}) AS BIGINT) AS bytes,
                     max({_OCTETS('text')}) AS text, max({_OCTETS('lang')}) AS lang, max({_OCTETS('source')}) AS source
              FROM documents GROUP BY 1) t) w""",
)


def row_sizes(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("tags", F.array("event_type", F.lit(None), F.lit("x")))
    return events.select("event_id", record_bytes(events.schema).alias("bytes"))


QUERIES["s7_record_bytes"] = (
    row_sizes,
    f"""SELECT event_id, 32 + 2 * {_OCTETS('event_type')} + 1 + coalesce({_OCTETS('props')}, 0) AS bytes FROM events""",
)
QUERIES["s7_vector_bytes"] = (
    lambda spark, sf_dir: (lambda v: v.select("vec_id", record_bytes(v.schema).alias("bytes")))(read(spark, sf_dir, "embeddings")),
    "SELECT vec_id, 8 + 4 * len(embedding) + 4 AS bytes FROM embeddings",
)
QUERIES["s8_batch_kinds"] = (
    lambda spark, sf_dir: batch_bind_kind(_batched(spark, sf_dir), "batch", 4000),
    " UNION ALL ".join(
        f"""SELECT doc_id // 100 AS batch, '{c}' AS "column", coalesce(max({_OCTETS(c)}), 0) AS max_bytes,
            CASE WHEN max({_OCTETS(c)}) > 4000 THEN 'lob' ELSE 'text' END AS kind FROM documents GROUP BY 1"""
        for c in TEXTS["documents"]
    ),
)


def too_wide(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    return violations(documents, plan_columns(documents, {"string_type": "varchar2"}), ["doc_id"])


_HINT = "value is wider than the column chosen from the scanned rows: name the column in clob_columns, or set string_type=clob"
QUERIES["s9_violations"] = (
    too_wide,
    " UNION ALL ".join(
        f"""SELECT doc_id, '{c.upper()}' AS "column", {_OCTETS(c)} AS width, CAST(4000 AS BIGINT) AS declared_bytes, '{_HINT}' AS hint
            FROM documents WHERE {_OCTETS(c)} > 4000""" for c in TEXTS["documents"]
    ),
)


def too_wide_for_window(spark, sf_dir):
    """Planned on what users say, checked on everything: what the other roles' turns break."""
    turns = read(spark, sf_dir, "conversations")
    plan = plan_columns(turns.where("role = 'user'"), {"max_string_size": "extended"})
    return violations(turns, plan, ["conv_id", "turn"])


QUERIES["s9_window_violations"] = (
    too_wide_for_window,
    f"""WITH w AS (SELECT max({_OCTETS('text')}) AS text, max({_OCTETS('role')}) AS role FROM conversations
                   WHERE role = 'user'),
        d AS (SELECT {_declared_sql('text', 32767)} AS text_limit, {_declared_sql('role', 32767)} AS role_limit FROM w)
        SELECT conv_id, turn, 'TEXT' AS "column", {_OCTETS('text')} AS width, text_limit AS declared_bytes, '{_HINT}' AS hint
        FROM conversations, d WHERE {_OCTETS('text')} > text_limit
        UNION ALL
        SELECT conv_id, turn, 'ROLE', {_OCTETS('role')}, role_limit, '{_HINT}' FROM conversations, d WHERE {_OCTETS('role')} > role_limit""",
)
QUERIES["s10_ddl"] = (
    lambda spark, sf_dir: ddl_frame(plan_frame(read(spark, sf_dir, "documents")), "docs_copy"),
    f"""SELECT 'CREATE TABLE DOCS_COPY ("DOC_ID" NUMBER(19), ' || string_agg('"' || c || '" ' ||
            CASE WHEN w > 4000 THEN 'CLOB' ELSE 'VARCHAR2(' || {_declared_sql('w', 4000)} || ')' END, ', ' ORDER BY p)
            || ', "N_CHARS" NUMBER(19)) NOLOGGING' AS ddl
        FROM (SELECT 1 AS p, 'TEXT' AS c, max({_OCTETS('text')}) AS w FROM documents UNION ALL
              SELECT 2, 'LANG', max({_OCTETS('lang')}) FROM documents UNION ALL
              SELECT 3, 'SOURCE', max({_OCTETS('source')}) FROM documents) t""",
)

# --- loads -------------------------------------------------------------------------------

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_ORDERS_SQL = "SELECT " + ", ".join(f'{c} AS "{c.upper()}"' for c in ORDER_COLUMNS) + " FROM orders"


def create(spark, sf_dir):
    table = new_table(spark, "d1")
    ingest(read(spark, sf_dir, "orders"), table)
    return spark.table(table)


def append(spark, sf_dir):
    table, orders = new_table(spark, "d2"), read(spark, sf_dir, "orders")
    ingest(orders.where("o_totalprice < 100000"), table)
    # Another column order, and one column not given.
    ingest(orders.where("o_totalprice >= 100000").select(*reversed(ORDER_COLUMNS[:5])), table, "append")
    return spark.table(table)


def replaced(spark, sf_dir):
    table = new_table(spark, "d3")
    ingest(read(spark, sf_dir, "customer"), table, "replace")
    ingest(read(spark, sf_dir, "orders"), table, "replace")
    return spark.table(table)


def create_append(spark, sf_dir):
    table, orders = new_table(spark, "d4"), read(spark, sf_dir, "orders")
    for condition in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        ingest(orders.where(condition), table, "create_append")
    return spark.table(table)


QUERIES["d1_create"] = (create, _ORDERS_SQL)


def created_decimals(spark, sf_dir):
    """Decimals are stored as decimals: numbers compare and sort as numbers."""
    table = new_table(spark, "d1d")
    rows = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CAST(l_extendedprice AS DECIMAL(18,2)) AS price", "CAST(l_discount / 1000000 AS DECIMAL(12,7)) AS small")
    plan = ingest(rows, table).plan
    stored = spark.table(table)
    kinds = F.lit(f"{stored.schema['PRICE'].dataType.simpleString()} {plan.declared['SMALL']}").alias("kinds")
    return stored.groupBy("L_LINENUMBER").agg(
        F.max("PRICE").cast("double").alias("highest"), F.min("SMALL").cast("double").alias("least"), F.sum("PRICE").cast("double").alias("total"),
    ).select("*", kinds)


QUERIES["d1_decimals"] = (
    created_decimals,
    """SELECT l_linenumber AS "L_LINENUMBER", CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS highest,
        CAST(min(CAST(l_discount / 1000000 AS DECIMAL(12,7))) AS DOUBLE) AS least,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, 'decimal(18,2) NUMBER(12,7)' AS kinds
        FROM lineitem GROUP BY l_linenumber""",
)


def append_widened(spark, sf_dir):
    """The second part has wider texts than the plan allows, until the options say otherwise."""
    table, documents = new_table(spark, "d2w"), read(spark, sf_dir, "documents").select("doc_id", "text")
    ingest(documents.where("octet_length(text) <= 500"), table)
    refused = 0
    try:
        ingest(documents.where("octet_length(text) > 500"), table, "append")
    except Exception as error:
        refused = int("clob_columns" in str(error))
    done = ingest(documents.where("octet_length(text) > 500"), table, "append", {"clob_columns": "text"})
    return spark.table(table).select("DOC_ID", F.octet_length("TEXT").alias("bytes"), F.lit(refused).alias("refused"),
                                     F.lit(done.plan.declared["TEXT"]).alias("declared"))


QUERIES["d2_append_widened"] = (
    append_widened,
    f"SELECT doc_id AS \"DOC_ID\", {_OCTETS('text')} AS bytes, 1 AS refused, 'CLOB' AS declared FROM documents",
)


def wide_lists(spark, sf_dir):
    """Vectors whose text form is longer than any inline text."""
    table = new_table(spark, "d6l")
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.flatten(F.array_repeat("embedding", 12)).alias("numbers"))
    plan = ingest(rows, table).plan
    return spark.table(table).select("VEC_ID", F.size(F.from_json("NUMBERS", "array<double>")).alias("n"),
                                     (F.octet_length("NUMBERS") > 4000).alias("long"), F.lit(plan.declared["NUMBERS"]).alias("declared"))


QUERIES["d6_wide_lists"] = (
    wide_lists, "SELECT vec_id AS \"VEC_ID\", 12 * len(embedding) AS n, true AS long, 'CLOB' AS declared FROM embeddings",
)


def unknown_modes(spark, sf_dir):
    """Every refusal, and the target as it was."""
    table, orders = new_table(spark, "d5"), read(spark, sf_dir, "orders")
    ingest(orders, table)
    refused = []
    for mode in ("upsert", "overwrite", "create append", "bulk.merge"):
        try:
            ingest(orders, table, mode)
        except InvalidArgument:
            refused.append(mode)
    return spark.table(table).agg(F.count("*").alias("n")).select(F.explode(F.array(*map(F.lit, refused))).alias("mode"), "n")


QUERIES["d5_unknown_modes"] = (
    unknown_modes,
    "SELECT unnest(['upsert', 'overwrite', 'create append', 'bulk.merge']) AS mode, (SELECT count(*) FROM orders) AS n",
)


def committed_rows(spark, sf_dir):
    """Rows reported by a load are rows stored, in every file that a task committed."""
    table = new_table(spark, "d9")
    reported = ingest(read(spark, sf_dir, "lineitem"), table, options={"ingest_workers": 3}).rows
    by_file = spark.table(table).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return by_file.agg(F.sum("n").alias("stored"), F.count("*").alias("tasks")).select(
        F.lit(reported).cast("bigint").alias("reported"), "stored", "tasks")


QUERIES["d9_committed_rows"] = (
    committed_rows, "SELECT count(*) AS reported, CAST(count(*) AS BIGINT) AS stored, 3 AS tasks FROM lineitem")
QUERIES["d2_append"] = (
    append,
    _ORDERS_SQL.replace("o_orderpriority AS", "CASE WHEN o_totalprice < 100000 THEN o_orderpriority END AS"),
)
QUERIES["d3_replace"] = (replaced, _ORDERS_SQL)
QUERIES["d4_create_append"] = (create_append, _ORDERS_SQL)


def batch_load(spark, sf_dir):
    table, lineitem = new_table(spark, "d6"), read(spark, sf_dir, "lineitem")
    first = ingest(lineitem, table)
    nothing = ingest(lineitem.where("l_quantity < 0"), table, "append")
    return spark.table(table).agg(F.count("*").alias("stored")).select(
        F.lit(first.rows).cast("bigint").alias("reported"), F.lit(nothing.rows).cast("bigint").alias("empty"), "stored"
    )


QUERIES["d6_batch_load"] = (batch_load, "SELECT count(*) AS reported, CAST(0 AS BIGINT) AS empty, count(*) AS stored FROM lineitem")


def stream_load(spark, sf_dir):
    table = new_table(spark, "d7")
    # The checkpoint belongs to this load alone.
    checkpoint = f"{shared_folder(spark)}/{table}"
    arriving = spark.readStream.schema(read(spark, sf_dir, "lineitem").schema).parquet(f"{sf_dir}/lineitem*.parquet")
    for _ in range(2):  # the second start finds nothing new
        ingest_stream(arriving, table, checkpoint).awaitTermination()
    return loaded_rows(spark, table).groupBy("L_RETURNFLAG").agg(
        F.count("*").alias("n"), F.sum(F.col("L_QUANTITY").cast("bigint")).alias("quantity"), F.max("L_SHIPDATE").alias("last")
    )


QUERIES["d7_stream_load"] = (
    stream_load,
    'SELECT l_returnflag AS "L_RETURNFLAG", count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,'
    " max(l_shipdate) AS last FROM lineitem GROUP BY l_returnflag",
)


def stream_widened(spark, sf_dir):
    """A batch with a wide value stops the stream; started again with the option, all rows are there once."""
    table = new_table(spark, "d7w")
    folder, checkpoint = f"{shared_folder(spark)}/{table}_in", f"{shared_folder(spark)}/{table}"
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")

    def arrive(condition):
        documents.where(condition).write.mode("append").parquet(folder)
        return spark.readStream.schema(documents.schema).parquet(folder)

    ingest_stream(arrive("octet_length(text) <= 500"), table, checkpoint).awaitTermination()
    stopped, arriving = 0, arrive("octet_length(text) > 500")
    try:
        ingest_stream(arriving, table, checkpoint).awaitTermination()
    except Exception as error:
        stopped = int("clob_columns" in str(error))
    ingest_stream(arriving, table, checkpoint, options={"clob_columns": "text"}).awaitTermination()
    return loaded_rows(spark, table).select("DOC_ID", F.octet_length("TEXT").alias("bytes"), F.lit(stopped).alias("stopped"))


QUERIES["d7_stream_widened"] = (
    stream_widened, f"SELECT doc_id AS \"DOC_ID\", {_OCTETS('text')} AS bytes, 1 AS stopped FROM documents")


def fan_out(spark, sf_dir):
    result = None
    for workers in (1, 4):
        table = new_table(spark, f"d8_{workers}")
        ingest(read(spark, sf_dir, "lineitem"), table, options={"ingest_workers": workers})
        rows = spark.table(table).groupBy("L_RETURNFLAG").agg(
            F.count("*").alias("n"), F.sum("L_ORDERKEY").alias("keys")
        ).select(F.lit(workers).alias("workers"), "*")
        result = rows if result is None else result.unionByName(rows)
    return result


QUERIES["d8_fan_out"] = (
    fan_out,
    " UNION ALL ".join(
        f'SELECT {w} AS workers, l_returnflag AS "L_RETURNFLAG", count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys'
        " FROM lineitem GROUP BY l_returnflag" for w in (1, 4)
    ),
)


def parquet_to_table(spark, sf_dir):
    table = new_table(spark, "d10")
    ingest(load_parquet(spark, f"{sf_dir}/part.parquet"), table, "replace")
    return spark.table(table)


QUERIES["d10_parquet_to_table"] = (
    parquet_to_table,
    'SELECT p_partkey AS "P_PARTKEY", p_name AS "P_NAME", p_brand AS "P_BRAND", p_type AS "P_TYPE",'
    ' CAST(p_size AS BIGINT) AS "P_SIZE", p_retailprice AS "P_RETAILPRICE" FROM part',
)


def geometry_load(spark, sf_dir):
    table = new_table(spark, "d11")
    done = ingest(spoilt(spark, sf_dir), table)
    declared = done.plan.declared["GEOM"]
    return spark.table(table).groupBy(F.col("GEOM.gtype").alias("gtype"), F.col("GEOM.srid").alias("srid")).agg(
        F.count("*").alias("n"), F.sum(F.size(F.coalesce("GEOM.ordinates", F.array()))).alias("ordinates")
    ).select("*", F.lit(done.rejected["GEOM"]).cast("bigint").alias("rejected"), F.lit(declared).alias("declared"))


_BAD = sum(1 for _, reason in SPOILT if reason)
QUERIES["d11_geometry_load"] = (
    geometry_load,
    f"""SELECT CASE WHEN vec_id % 8 = 6 THEN 2006 END AS gtype, CASE WHEN vec_id % 8 = 6 THEN 4326 END AS srid, count(*) AS n,
        CAST(sum(CASE WHEN vec_id % 8 = 6 THEN 64 ELSE 0 END) AS BIGINT) AS ordinates,
        (SELECT count(*) FROM embeddings WHERE vec_id % 8 < {_BAD}) AS rejected, 'MDSYS.SDO_GEOMETRY' AS declared
        FROM embeddings GROUP BY 1, 2""",
)
QUERIES["d12_names"] = (lambda spark, sf_dir: normalise_names(read(spark, sf_dir, "orders")), _ORDERS_SQL)
