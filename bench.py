"""Headline benchmark: one JSON line with seconds per query.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     cores of the local session (default 8)
    BENCH_REPEATS  timed runs per query, the fastest counts (default 3)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F
from pyspark.sql import types as T

from entry_queries.common import new_table, read
from entry_queries.relational import bound_join
from entry_queries.shapes import geometry
from tableferry import (
    conform, decode_geometry, encode_geometry, ingest, load_parquet, measure_scan, orient_rings,
    profile_text, run_many,
)
from tableferry.session import local_session, shared_folder


def timed(action, repeats):
    best, rows = None, None
    for _ in range(repeats):
        started = time.perf_counter()
        rows = action()
        spent = time.perf_counter() - started
        best = spent if best is None else min(best, spent)
    return best, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores, partitions=int(cores))
    base = f"{shared_folder(spark)}/ferry_bench_{os.path.basename(sf_dir.rstrip('/'))}"
    loaded = []

    def load():
        loaded.append(new_table(spark, "load"))
        return ingest(lineitem, loaded[-1]).rows

    lineitem = read(spark, sf_dir, "lineitem")
    spread = lineitem.repartition(int(cores))
    x, y = "double(l_partkey % 36000) / 100 - 180", "double(l_suppkey % 18000) / 100 - 90"
    points = spread.selectExpr("l_orderkey", f"{x} AS x", f"{y} AS y").select(
        "l_orderkey", geometry("2001", "4326", "named_struct('x', x, 'y', y, 'z', CAST(NULL AS DOUBLE))").alias("geom")
    )
    squares = spread.selectExpr("l_orderkey", f"{x} AS x", f"{y} AS y").select(
        "l_orderkey",
        geometry("2003", "4326", info="array(1, 1003, 1)", ordinates=(
            "array(x, y, x, y + 0.0001D, x + 0.0001D, y + 0.0001D, x + 0.0001D, y, x, y)")).alias("geom"),
    )
    # Inputs of the geometry queries are files, so that making them is not measured.
    inputs = {"points": points, "squares": squares,
              "points_wkb": encode_geometry(points, "geom"), "squares_wkb": encode_geometry(squares, "geom")}
    for name, frame in inputs.items():
        frame.write.mode("overwrite").parquet(f"{base}/{name}")
    rendered = spread.select(*[F.col(c).cast("string").alias(c) for c in lineitem.columns])
    rendered.write.mode("overwrite").parquet(f"{base}/rendered")
    stored = lambda name: load_parquet(spark, f"{base}/{name}")

    wanted = T.StructType()
    for field in lineitem.schema:
        wanted.add(field.name, T.LongType() if isinstance(field.dataType, T.IntegerType) else field.dataType)
    rings = read(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "concat(transform(embedding, v -> double(v)), transform(slice(embedding, 1, 2), v -> double(v))) AS ordinates",
        "true AS outer", "2 AS dims",
    ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).repartition(int(cores))
    rings.write.mode("overwrite").parquet(f"{base}/rings")

    def update_many():
        changes = lineitem.select("l_orderkey", "l_linestatus", "l_shipdate")
        return measure_scan(run_many(
            read(spark, sf_dir, "orders"), changes, {"o_orderkey": "l_orderkey"}, "update",
            assign={"o_orderstatus": "l_linestatus"}, order_by="l_shipdate").frame).rows

    work = {
        "bound_join": lambda: len(bound_join(spark, sf_dir).collect()),
        "width_scan_documents": lambda: len(profile_text(read(spark, sf_dir, "documents")).collect()),
        "width_scan_lineitem": lambda: len(profile_text(lineitem).collect()),
        "load_lineitem": load,
        "conform_lineitem": lambda: measure_scan(conform(stored("rendered"), wanted)).rows,
        "update_many_orders": update_many,
        "encode_points": lambda: measure_scan(encode_geometry(stored("points"), "geom")).rows,
        "decode_points": lambda: measure_scan(decode_geometry(stored("points_wkb"), "geom", srid=4326)).rows,
        "encode_polygons": lambda: measure_scan(encode_geometry(stored("squares"), "geom")).rows,
        "decode_polygons": lambda: measure_scan(decode_geometry(stored("squares_wkb"), "geom", srid=4326)).rows,
        "orient_rings": lambda: measure_scan(orient_rings(stored("rings"))).rows,
    }
    seconds, rates = {}, {}
    for name, action in work.items():
        best, rows = timed(action, repeats)
        seconds[name] = round(best, 3)
        if rows > 1000:
            rates[name] = round(rows / best)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rows_per_second": rates, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cores),
    }))
    for table in loaded:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.stop()


if __name__ == "__main__":
    main()
