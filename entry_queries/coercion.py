"""B and C rows: reading loose values into types, and the form values are loaded in."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry import conform, map_source_types, plan_frame, to_load_form
from tableferry.operators.conform import read_back, stored_types

from .common import read
from .stock import PART_INVENTORY_SQL, part_inventory

QUERIES = {}


def schema(*fields):
    result = T.StructType()
    for name, kind in fields:
        result.add(name, kind)
    return result


LONG, DOUBLE, TEXT, BOOL = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
BYTES, WALL, INSTANT = T.BinaryType(), T.TimestampNTZType(), T.TimestampType()

# Number texts of every kind, good and bad, by event_id. The same text builds both sides.
NUMBER_TEXT = """
    CASE event_id % 10
        WHEN 0 THEN CAST(user_id AS {text}) WHEN 1 THEN CAST(value AS {text}) WHEN 2 THEN ' 12'
        WHEN 3 THEN 'abc' WHEN 4 THEN '1e3' WHEN 5 THEN '' WHEN 6 THEN concat('-', CAST(user_id AS {text}), '.9')
        WHEN 7 THEN '99999999999999999999' WHEN 8 THEN '1e400' ELSE concat('+', CAST(user_id AS {text})) END
"""


def _events(spark, sf_dir):
    return read(spark, sf_dir, "events").withColumn("num", F.expr(NUMBER_TEXT.format(text="STRING")))


_EVENTS = f"(SELECT *, {NUMBER_TEXT.format(text='VARCHAR')} AS num FROM events) e"
_IS_INT = r"regexp_matches(num, '^[+-]?[0-9]+$')"
_IS_NUM = r"regexp_matches(num, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')"
_NUM = f"CASE WHEN {_IS_NUM} AND NOT isinf(try_cast(num AS DOUBLE)) THEN try_cast(num AS DOUBLE) END"


def dispatch(spark, sf_dir):
    source = read(spark, sf_dir, "events").select(
        "event_id", F.expr("nullif(event_type, 'click')").alias("kind"), "value"
    )
    # "value" has a target type without conversion, "gone" is not in the source.
    wanted = schema(("EVENT_ID", LONG), ("kind", TEXT), ("value", T.ShortType()), ("gone", DOUBLE))
    return conform(source, wanted).withColumnRenamed("EVENT_ID", "event_id")


QUERIES["b1_dispatch"] = (
    dispatch,
    "SELECT event_id, nullif(event_type, 'click') AS kind, CAST(NULL AS SMALLINT) AS value,"
    " CAST(NULL AS DOUBLE) AS gone FROM events",
)
QUERIES["b2_int64"] = (
    lambda spark, sf_dir: conform(
        _events(spark, sf_dir).select(
            "event_id", "num", "value", F.col("user_id").cast("int").alias("small"), (F.col("value") < 5).alias("flag")
        ),
        schema(("event_id", LONG), ("num", LONG), ("value", LONG), ("small", LONG), ("flag", LONG)),
    ),
    f"""SELECT event_id,
        CASE WHEN {_IS_INT} AND try_cast(num AS BIGINT) IS NOT NULL THEN try_cast(num AS BIGINT)
             ELSE try_cast(trunc({_NUM}) AS BIGINT) END AS num,
        CAST(trunc(value) AS BIGINT) AS value, user_id AS small, CAST(NULL AS BIGINT) AS flag FROM {_EVENTS}""",
)
QUERIES["b3_float64"] = (
    lambda spark, sf_dir: conform(
        _events(spark, sf_dir).select(
            "event_id", "num", F.get_json_object("props", "$.k").alias("k"), F.col("user_id").alias("whole")
        ),
        schema(("event_id", LONG), ("num", DOUBLE), ("k", DOUBLE), ("whole", DOUBLE)),
    ),
    f"""SELECT event_id, {_NUM} AS num, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
        CAST(user_id AS DOUBLE) AS whole FROM {_EVENTS}""",
)
QUERIES["b4_text"] = (
    lambda spark, sf_dir: conform(
        read(spark, sf_dir, "events").select(
            "event_id", "value", (F.col("user_id") * F.lit(1e6)).alias("large"), "event_type",
            F.encode("event_type", "UTF-8").alias("raw"), (F.col("value") < 5).alias("flag"), "ts",
        ),
        schema(("event_id", TEXT), ("value", TEXT), ("large", TEXT), ("event_type", TEXT), ("raw", TEXT),
               ("flag", TEXT), ("ts", TEXT)),
    ),
    r"""SELECT CAST(event_id AS VARCHAR) AS event_id, regexp_replace(CAST(value AS VARCHAR), '\.0$', '') AS value,
        CAST(user_id * 1000000 AS VARCHAR) AS large, event_type, event_type AS raw,
        CASE WHEN value < 5 THEN 'true' ELSE 'false' END AS flag,
        regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\.?0*$', '') || ' +0000 UTC' AS ts FROM events""",
)

# An order date in each accepted layout, and in one that is refused.
LAYOUTS = """
    CASE o_orderkey % 6
        WHEN 0 THEN concat({day}, 'T03:04:05.25+02:00') WHEN 1 THEN concat({day}, ' 03:04:05.123456789 -05:30')
        WHEN 2 THEN concat({day}, ' 23:59:59.5') WHEN 3 THEN {day}
        WHEN 4 THEN concat({day}, 'T03:04:05') ELSE concat({day}, 'T03:04:05Z') END
"""


def _orders(spark, sf_dir):
    day = "date_format(o_orderdate, 'yyyy-MM-dd')"
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.expr(LAYOUTS.format(day=day)).alias("txt"))


def micros(*names):
    return [F.unix_micros(F.col(n).cast("timestamp")).alias(n) for n in names]


_DAY = "epoch_us(date_trunc('day', o_orderdate))"
_WALL = f"""CASE o_orderkey % 6 WHEN 0 THEN {_DAY} + 11045250000 WHEN 1 THEN {_DAY} + 11045123456
    WHEN 2 THEN {_DAY} + 86399500000 WHEN 3 THEN {_DAY} WHEN 5 THEN {_DAY} + 11045000000 END"""
_SHIFT = "CASE o_orderkey % 6 WHEN 0 THEN -7200000000 WHEN 1 THEN 19800000000 ELSE 0 END"


def wall_clock(spark, sf_dir):
    source = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_orderdate").cast("timestamp").alias("instant"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").alias("number"),
    )
    wanted = schema(("o_orderkey", LONG), ("o_orderdate", WALL), ("instant", WALL), ("day", WALL), ("number", WALL))
    return conform(source, wanted, zone="Asia/Tokyo")


QUERIES["b5a_wall_clock"] = (
    wall_clock,
    "SELECT o_orderkey, o_orderdate, o_orderdate + INTERVAL 9 HOUR AS instant, date_trunc('day', o_orderdate) AS day,"
    " CAST(NULL AS TIMESTAMP) AS number FROM orders",
)
QUERIES["b5b_instant"] = (
    lambda spark, sf_dir: conform(
        read(spark, sf_dir, "events").select("event_id", "ts", F.col("ts").cast("date").alias("day"), "user_id"),
        schema(("event_id", LONG), ("ts", INSTANT), ("day", INSTANT), ("user_id", INSTANT)),
    ).select("event_id", *micros("ts", "day", "user_id")),
    "SELECT event_id, epoch_us(ts) AS ts, epoch_us(date_trunc('day', ts)) AS day, CAST(NULL AS BIGINT) AS user_id FROM events",
)
QUERIES["b5c_layouts"] = (
    lambda spark, sf_dir: conform(
        _orders(spark, sf_dir).select("o_orderkey", F.col("txt").alias("wall"), F.col("txt").alias("instant")),
        schema(("o_orderkey", LONG), ("wall", WALL), ("instant", INSTANT)),
    ).select("o_orderkey", *micros("wall", "instant")),
    f"SELECT o_orderkey, {_WALL} AS wall, {_WALL} + {_SHIFT} AS instant FROM orders",
)
QUERIES["b6_bytes"] = (
    lambda spark, sf_dir: conform(
        read(spark, sf_dir, "benchmark").select("item_id", F.encode("text", "UTF-8").alias("raw"), "text"),
        schema(("item_id", LONG), ("raw", BYTES), ("text", BYTES)),
    ).select("item_id", F.hex("raw").alias("raw"), F.hex("text").alias("text")),
    "SELECT item_id, hex(encode(text)) AS raw, CAST(NULL AS VARCHAR) AS text FROM benchmark",
)
_FLAG_TEXT = """CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN 'true' WHEN 3 THEN 'TRUE' WHEN 4 THEN 'Y'
    WHEN 5 THEN 'yes' WHEN 6 THEN 'True' ELSE NULL END"""


def flags(spark, sf_dir):
    source = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(_FLAG_TEXT).alias("txt"), F.col("l_returnflag").alias("ret"),
        F.col("l_discount").alias("dec"), (F.col("l_linenumber") - 1).alias("num"), F.col("l_shipdate").alias("day"),
    )
    return conform(source, schema(("l_orderkey", LONG), ("l_linenumber", LONG), ("txt", BOOL), ("ret", BOOL),
                                  ("dec", BOOL), ("num", BOOL), ("day", BOOL)))


QUERIES["b7_flag"] = (
    flags,
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {_FLAG_TEXT} IN ('1', 'true', 'TRUE', 'Y') AS txt,
        l_returnflag IN ('1', 'true', 'TRUE', 'Y') AS ret, l_discount <> 0 AS dec, l_linenumber <> 1 AS num,
        CAST(NULL AS BOOLEAN) AS day FROM lineitem""",
)

_TYPE_SQL = """
    CASE WHEN dt = 'NUMBER' AND scale = 0 AND precision BETWEEN 1 AND 18 THEN 'bigint'
         WHEN dt = 'NUMBER' AND scale = 0 AND precision > 18 THEN 'string'
         WHEN dt IN ('NUMBER', 'FLOAT', 'BINARY_FLOAT', 'BINARY_DOUBLE') THEN 'double'
         {wire}
         WHEN dt IN ('VARCHAR2', 'CLOB', 'NCHAR', 'ROWID') THEN 'string'
         WHEN dt IN ('DATE', 'TIMESTAMP') THEN 'timestamp_ntz'
         WHEN dt LIKE 'TIMESTAMP%' THEN 'timestamp'
         WHEN dt IN ('RAW', 'BLOB', 'SDO_GEOMETRY') THEN 'binary'
         WHEN dt = 'BOOLEAN' THEN 'boolean' ELSE 'string' END
"""
_WIRE = "WHEN dt = 'IBDOUBLE' THEN 'double' WHEN dt = 'TIMESTAMPDTY' THEN 'timestamp_ntz' WHEN dt IN ('OCIBLOBLOCATOR', 'MDSYS.SDO_GEOMETRY') THEN 'binary'"
_BARE = r"regexp_replace(upper(data_type), '^(TIMESTAMP) *\([0-9]+\)', '\1')"


def source_types(spark, sf_dir):
    inventory = part_inventory(spark, sf_dir).select('column', "data_type", "precision", "scale")
    query = map_source_types(inventory, "query").withColumnRenamed("spark_type", "query_type")
    catalog = map_source_types(query, "catalog").withColumnRenamed("spark_type", "catalog_type")
    return map_source_types(catalog, "catalog", strict_reference=True).withColumnRenamed("spark_type", "strict_type")


QUERIES["b8_source_types"] = (
    source_types,
    f"""WITH i AS ({PART_INVENTORY_SQL}),
        q AS (SELECT *, {_BARE} AS dt FROM i)
        SELECT "column", data_type, precision, scale, {_TYPE_SQL.format(wire=_WIRE)} AS query_type,
               {_TYPE_SQL.format(wire='')} AS catalog_type,
               CASE WHEN upper(data_type) LIKE 'TIMESTAMP(%' THEN 'timestamp' ELSE {_TYPE_SQL.format(wire='')} END AS strict_type
        FROM q""",
)


# --- C rows --------------------------------------------------------------------------


def loaded(name, table, columns, sql, after=None):
    """Load form of selected columns of one table."""

    def query(spark, sf_dir):
        source = read(spark, sf_dir, table).select(*[F.expr(text).alias(alias) for alias, text in columns.items()])
        result = to_load_form(source)
        return result.select(*after(result)) if after else result

    QUERIES[name] = (query, sql)


loaded("c1_integers", "orders",
       {"a": "o_orderkey", "b": "int(o_custkey)", "c": "smallint(o_custkey % 1000)", "d": "tinyint(o_orderkey % 100)"},
       "SELECT o_orderkey AS a, o_custkey AS b, o_custkey % 1000 AS c, o_orderkey % 100 AS d FROM orders")
loaded("c2_unsigned", "orders",
       {"k": "o_orderkey", "u": "cast(18446744073709000000 + o_orderkey AS decimal(20,0))"},
       "SELECT o_orderkey AS k, CAST(CAST(18446744073709000000 AS HUGEINT) + o_orderkey AS VARCHAR) AS u FROM orders")
def floats(spark, sf_dir):
    """Every number of every vector, as single and as double precision."""
    numbers = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "f"))
    return to_load_form(numbers.withColumn("d", F.col("f").cast("double") / 4))


QUERIES["c3_floats"] = (
    floats,
    """SELECT vec_id, CAST(k AS BIGINT) AS i, CAST(embedding[k + 1] AS DOUBLE) AS f, CAST(embedding[k + 1] AS DOUBLE) / 4 AS d
       FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS k FROM embeddings) e""",
)
loaded("c4_flags", "labels", {"doc_id": "doc_id", "good": "quality = 1", "toxic": "if(toxic = 1, true, NULL)"},
       "SELECT doc_id, CAST(quality = 1 AS BIGINT) AS good, CASE WHEN toxic = 1 THEN CAST(1 AS BIGINT) END AS toxic FROM labels")
loaded("c5_text", "conversations", {"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"},
       "SELECT conv_id, turn, role, text FROM conversations")
loaded("c6_bytes", "conversations", {"conv_id": "conv_id", "turn": "turn", "raw": "encode(text, 'UTF-8')"},
       "SELECT conv_id, turn, hex(encode(text)) AS raw FROM conversations",
       lambda df: ["conv_id", "turn", F.hex("raw").alias("raw")])
loaded("c7_decimals", "orders",
       {"k": "o_orderkey", "price": "cast(o_totalprice AS decimal(18,2))", "scaled": "cast(o_orderkey AS decimal(12,3))",
        "small": "cast(cast(o_custkey % 20 - 10 AS decimal(3,0)) * 0.0000001 AS decimal(12,7))"},
       "SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,"
       " CAST(CAST(o_orderkey AS DECIMAL(12,3)) AS VARCHAR) AS scaled,"
       " CAST(CAST(CAST(o_custkey % 20 - 10 AS DECIMAL(3,0)) * 0.0000001 AS DECIMAL(12,7)) AS VARCHAR) AS small FROM orders")
loaded("c8_timestamps", "events", {"event_id": "event_id", "wall": "ts", "instant": "cast(ts AS timestamp)"},
       "SELECT event_id, ts AS wall, epoch_us(ts) AS instant FROM events",
       lambda df: ["event_id", "wall", F.unix_micros("instant").alias("instant")])
loaded("c9_dates", "orders", {"k": "o_orderkey", "day": "cast(o_orderdate AS date)"},
       "SELECT o_orderkey AS k, date_trunc('day', o_orderdate) AS day FROM orders")
loaded("c10_other", "embeddings",
       {"vec_id": "vec_id", "pair": "named_struct('id', vec_id, 'label', label)", "span": "make_dt_interval(0, label)",
        "list": "embedding"},
       "SELECT vec_id, CAST(to_json({'id': vec_id, 'label': label}) AS VARCHAR) AS pair, 'INTERVAL ''' || (label // 24)"
       " || ' ' || lpad(CAST(label % 24 AS VARCHAR), 2, '0') || ':00:00'' DAY TO SECOND' AS span, CAST(k AS INT) AS i,"
       " CAST(embedding[k + 1] AS DOUBLE) AS v"
       " FROM (SELECT vec_id, label, embedding, unnest(range(len(embedding))) AS k FROM embeddings) e",
       # The list's text is read back: its numbers are what has to be right.
       lambda df: ["vec_id", "pair", "span", F.posexplode(F.from_json("list", "array<float>").cast("array<double>")).alias("i", "v")])


def round_trip(spark, sf_dir):
    """What a reader gets back after the load, with the types the stored columns have."""
    source = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") > 100000).alias("flag"),
        F.expr("cast(o_totalprice AS decimal(18,2))").alias("price"), F.expr("cast(o_custkey AS decimal(10,0))").alias("cust"),
        F.expr("cast(o_orderkey AS decimal(25,0))").alias("big"), F.expr("float(o_custkey) / 4").alias("ratio"),
        F.col("o_orderdate").cast("date").alias("day"), F.expr("if(o_orderstatus = 'F', '', o_orderstatus)").alias("status"),
    )
    declared = stored_types(plan_frame(source, {"string_type": "varchar2"})).orderBy("position").collect()
    return read_back(source, {row["name"].lower(): row["read_type"] for row in declared})


QUERIES["c_round_trip"] = (
    round_trip,
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_totalprice > 100000 AS BIGINT) AS flag,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price, o_custkey AS cust, CAST(o_orderkey AS VARCHAR) AS big,
       CAST(o_custkey AS DOUBLE) / 4 AS ratio, date_trunc('day', o_orderdate) AS day,
       nullif(o_orderstatus, 'F') AS status FROM orders""",
)
