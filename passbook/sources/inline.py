"""Small literal tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Rows as a local relation; text is cast to the schema's types.

    Handed over as Arrow, so reading it needs no Python worker.
    """
    columns = dict(zip(schema.fieldNames(), zip(*rows, strict=True), strict=True))
    table = pa.table({name: pa.array(list(values)) for name, values in columns.items()})
    casts = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    return spark.createDataFrame(table).select(*casts)
