"""Reading: Parquet files, previews, counts, and geometry objects as tagged WKB."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import InvalidArgument, InvalidState
from ..functions.coerce import to_text
from ..functions.geometry import is_geometry_object
from ..operators.geometry import encode_geometry, tag_crs
from ..plans.columns import quote

PREVIEW_ROWS = 20


def load_parquet(
    spark: SparkSession, path: str, columns: list[str] | None = None,
    where: str | Column | None = None, batch_rows: int | None = None,
) -> DataFrame:
    """A Parquet scan; columns and filter reach the files.

    ``batch_rows`` is how many rows the vectorised reader decodes at a time.
    """
    if batch_rows is not None:
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(int(batch_rows)))
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows as text, with the word NULL for missing values."""
    first = df.limit(n)
    return first.select(
        *[
            F.coalesce(F.expr(to_text(quote(f.name), f.dataType)), F.lit("NULL")).alias(f.name)
            for f in df.schema
        ]
    )


@dataclass(frozen=True)
class ScanReport:
    rows: int
    seconds: float

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def measure_scan(df: DataFrame) -> ScanReport:
    """Reads every column of every row once, keeps nothing, and counts on the way."""
    counted = Observation()
    started = time.perf_counter()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return ScanReport(counted.get["rows"], time.perf_counter() - started)


def scan_geometry(df: DataFrame, on_mixed: str = "untagged") -> DataFrame:
    """Geometry objects as WKB columns, tagged with their reference system.

    One pass over the reference numbers of all geometry columns finds out whether a column has
    one system. A column that mixes systems gets no tag, or is refused with ``on_mixed="fail"``.
    """
    if on_mixed not in ("untagged", "fail"):
        raise InvalidArgument(f"on_mixed must be untagged or fail, got {on_mixed!r}")
    names = [f.name for f in df.schema if is_geometry_object(f.dataType)]
    if not names:
        return df
    srids = [F.nullif(F.col(f"{quote(name)}.srid"), F.lit(0)) for name in names]
    ends = df.agg(*[end(srid).alias(f"{which}{i}") for i, srid in enumerate(srids) for which, end in (("low", F.min), ("high", F.max))]).first()
    result = df
    for i, name in enumerate(names):
        low, high = ends[f"low{i}"], ends[f"high{i}"]
        if low != high and on_mixed == "fail":
            raise InvalidState(f"column {name} mixes reference systems, from {low} to {high}")
        result = tag_crs(encode_geometry(result, name), name, low if low == high else None)
    return result
