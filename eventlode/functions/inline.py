"""Small fixed tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def inline_rows(spark: SparkSession, rows: list[tuple], layout: str | T.StructType) -> DataFrame:
    """A few rows as a frame whose size the optimizer knows, so that joins with it are broadcast.

    Rows handed over as an Arrow table become a local relation. The same rows as Python objects would
    have no size estimate, and joining them would shuffle both sides.
    """
    layout = T.StructType.fromDDL(layout) if isinstance(layout, str) else layout
    table = pa.Table.from_pylist([dict(zip(layout.names, row)) for row in rows], schema=to_arrow_schema(layout))
    return spark.createDataFrame(table, layout)
