"""The row-generating hooks in SQL (U1, U3): a user's Python function as a table
function over a table argument.

    register_deserializer(spark, "log_lines", fn, "event_id bigint, size int")
    SELECT * FROM log_lines(TABLE(SELECT * FROM groups), 'logstore', 'shard')

    register_serializer(spark, "to_records", fn)
    SELECT * FROM to_records(TABLE(rows))

``fn`` takes a row as a dict and yields any number of dicts.  The names after
the table are columns of it that every output row keeps: the output schema is
found when the statement is analysed.  Rows stay in the tasks that hold them
unless the call says ``TABLE(...) PARTITION BY``.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..session import workers_find_library
from .hooks import RECORD_SCHEMA

Hook = Callable[[dict], Iterable[dict]]


def _hook(fn: Hook, schema: T.StructType) -> type:
    names = schema.fieldNames()

    class Rows:
        def __init__(self, analyzed: AnalyzeResult | None = None):
            self.kept = [f.name for f in analyzed.schema.fields[:-len(names)]] if analyzed else []

        @staticmethod
        def analyze(table: AnalyzeArgument, *keep: AnalyzeArgument) -> AnalyzeResult:
            if not table.isTable:
                raise ValueError("the first argument must be a table: TABLE(...)")
            have = {f.name: f for f in table.dataType.fields}
            for k in keep:
                if not k.isConstantExpression or k.value not in have:
                    raise ValueError(f"no column to keep: {k.value}")
                if k.value in names:
                    raise ValueError(f"a kept column has the name of an output column: {k.value}")
            return AnalyzeResult(T.StructType([*[have[k.value] for k in keep], *schema.fields]))

        def eval(self, row: Row, *keep: str):
            kept = tuple(row[k] for k in self.kept)
            for out in fn(row.asDict(recursive=True)):
                yield (*kept, *(out.get(n) for n in names))

    return Rows


def _schema(spark: SparkSession, schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema


def register_deserializer(spark: SparkSession, name: str, fn: Hook, schema: T.StructType | str) -> None:
    """``fn`` yields rows of ``schema`` for each row of the table."""
    workers_find_library(spark)
    spark.udtf.register(name, udtf(_hook(fn, _schema(spark, schema))))


def register_serializer(spark: SparkSession, name: str, fn: Hook) -> None:
    """``fn`` yields records (``hooks.RECORD_SCHEMA``; ``contents`` as a
    list of ``(key, value)``) for each row of the table."""
    workers_find_library(spark)
    spark.udtf.register(name, udtf(_hook(fn, RECORD_SCHEMA)))
