"""Small constant tables built on the JVM side.

``spark.createDataFrame(list)`` ships Python rows through Python workers
every time a plan reads it.  For the few fixed rows a job carries (a zone
layer, a correction list) a literal array of structs expanded with
``inline`` is a pure JVM plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit(value, dtype: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        return F.array(*[_lit(v, dtype.elementType) for v in value]).cast(dtype)
    if isinstance(dtype, T.StructType):
        vals = value if isinstance(value, (list, tuple)) else [value[f.name] for f in dtype.fields]
        return F.struct(*[_lit(v, f.dataType).alias(f.name) for v, f in zip(vals, dtype.fields)])
    return F.lit(value).cast(dtype)


def literal_table(spark: SparkSession, schema: T.StructType | str, rows: list) -> DataFrame:
    """A DataFrame of ``rows`` (tuples in schema order) with a fixed schema."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    arr = F.array(*[_lit(tuple(r), schema) for r in rows])
    return spark.range(1).select(F.inline(arr)).toDF(*schema.fieldNames())
