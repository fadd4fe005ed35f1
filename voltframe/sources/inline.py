"""Small literal relations.

Built from an Arrow table, so the planner knows their size and can broadcast them safely.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def rows(spark: SparkSession, schema: str | T.StructType, values: Iterable[Sequence]) -> DataFrame:
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(shape)
    columns = list(zip(*values)) or [[] for _ in shape]
    table = pa.table([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=shape)
