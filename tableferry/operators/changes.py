"""Updates that build on the row's own value, for a whole table of parameters.

Every parameter row is a map x -> times * x + plus, or a fresh value. Maps of one key that follow each
other are one map, so the parameters are folded to one row per key before they meet the target. The fold
keeps the order of the statements: parameters are sorted over range partitions by key and order,
runs of a key in a partition are folded first, then the partitions' results in order. A key that
holds a third of all parameters spans as many partitions as its rows need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..plans.columns import quote


@dataclass(frozen=True)
class Affine:
    """The row's value times parameter ``times`` (none: 1) plus parameter ``plus`` (none: 0).

    Where the boolean parameter ``fresh`` is true, the value is ``plus`` alone, whatever the row had. A null
    factor or summand makes the value null, until a fresh one.
    """

    plus: str | None = None
    times: str | None = None
    fresh: str | None = None


def work_type(kind: T.DataType) -> str:
    """The type maps are folded in: whole numbers exactly, decimals with the column's scale."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "decimal(38,0)"
    if isinstance(kind, T.DecimalType):
        return f"decimal(38,{kind.scale})"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "double"
    raise InvalidArgument(f"only numbers build up, not {kind.simpleString()}")


def _then(first: Column, second: Column, kind: str) -> Column:
    """One map for two that follow each other."""
    times = F.when(second["fresh"], F.lit(0).cast(kind)).otherwise((second["times"] * first["times"]).cast(kind))
    plus = F.when(second["fresh"], second["plus"]).otherwise((second["times"] * first["plus"]).cast(kind) + second["plus"])
    return F.struct((first["fresh"] | second["fresh"]).alias("fresh"), times.alias("times"), plus.cast(kind).alias("plus"))


def folded_changes(params: DataFrame, keys: list[str], assign: dict[str, str | Affine], order_by: str, target: T.StructType) -> DataFrame:
    """(__key*, __fold*, __times): one row per key with a map per assigned column, in the order of ``assign``.

    Null orders come first; parameters of equal order follow each other by their values, nulls first. A plain
    parameter column among the assignments is a fresh value; a key with a null matches nothing.
    """
    kinds = [work_type(target[t].dataType) if isinstance(a, Affine) else target[t].dataType.simpleString() for t, a in assign.items()]

    def one(a: str | Affine, kind: str) -> Column:
        if not isinstance(a, Affine):
            return F.struct(F.lit(True).alias("fresh"), F.lit(None).cast(kind).alias("times"), F.col(quote(a)).cast(kind).alias("plus"))
        number = lambda name, default: F.lit(default).cast(kind) if name is None else F.col(quote(name)).cast(kind)
        fresh = F.lit(False) if a.fresh is None else F.coalesce(F.col(quote(a.fresh)).cast("boolean"), F.lit(False))
        return F.struct(fresh.alias("fresh"), F.when(fresh, F.lit(0).cast(kind)).otherwise(number(a.times, 1)).alias("times"), number(a.plus, 0).alias("plus"))

    names, folds = [f"__key{i}" for i in range(len(keys))], [f"f{i}" for i in range(len(kinds))]
    maps = F.struct(*[one(a, kind).alias(f) for a, kind, f in zip(assign.values(), kinds, folds, strict=True)])
    rows = params.select(*[F.col(quote(k)).alias(n) for k, n in zip(keys, names, strict=True)], F.col(quote(order_by)).alias("__order"), maps.alias("__maps"))
    rows = rows.where(" AND ".join(f"{n} IS NOT NULL" for n in names))
    # Equal rows stay apart by their number, so that no run of equals is bound to one partition.
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    order = [*names, F.asc_nulls_first("__order"), F.asc_nulls_first("__maps"), "__row"]
    parted = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())

    def fold(items: Column) -> Column:
        start = F.struct(*[F.struct(F.lit(False).alias("fresh"), F.lit(1 if isinstance(a, Affine) else None).cast(kind).alias("times"),
                                    F.lit(0 if isinstance(a, Affine) else None).cast(kind).alias("plus")).alias(f)
                           for a, kind, f in zip(assign.values(), kinds, folds, strict=True)])
        shape = T.StructType([T.StructField(f, T.StructType([T.StructField("fresh", T.BooleanType()), T.StructField("times", T._parse_datatype_string(kind)),
                              T.StructField("plus", T._parse_datatype_string(kind))])) for kind, f in zip(kinds, folds, strict=True)])
        step = lambda a, kind, f, m, x: _then(m[f], x["maps"][f], kind) if isinstance(a, Affine) else x["maps"][f]
        return F.aggregate(items, start.cast(shape), lambda m, x: F.struct(*[
            step(a, kind, f, m, x).alias(f) for a, kind, f in zip(assign.values(), kinds, folds, strict=True)]).cast(shape))

    runs = parted.groupBy(*names, "__part").agg(
        F.sort_array(F.collect_list(F.struct(F.col("__order").isNotNull().alias("known"), F.col("__order").alias("order"), F.col("__maps").alias("maps")))).alias("__run"),
        F.count("*").alias("__n"))
    runs = runs.select(*names, "__part", "__n", fold(F.col("__run")).alias("__maps"))
    whole = runs.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct(F.col("__part").alias("part"), F.col("__maps").alias("maps")))).alias("__run"), F.sum("__n").alias("__times"))
    return whole.select(*names, "__times", fold(F.col("__run")).alias("__all")).select(
        *names, "__times", *[F.col(f"__all.{f}").alias(f"__fold{i}") for i, f in enumerate(folds)])


def applied(value: Column, fold: str, kind: T.DataType) -> Column:
    """The folded map on the row's value; a result that the column cannot hold is an error under ANSI rules."""
    m = F.col(fold)
    if not isinstance(kind, T.NumericType):
        return m["plus"].cast(kind)
    work = work_type(kind)
    return F.when(m["fresh"], m["plus"]).otherwise((m["times"] * value.cast(work)).cast(work) + m["plus"]).cast(kind)
