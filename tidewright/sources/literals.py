"""Small constant tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows as a local relation: the optimizer sees them, knows their size and broadcasts them."""
    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))
    columns = [pa.array([r[i] for r in rows], field.type) for i, field in enumerate(arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow_schema))
