"""What the Arrow stages of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 256
"""Rows handed to a Python worker at once. Texts may be long, so the count that Spark takes by default is too large."""


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Lower the session's rows per Arrow batch to ``rows``; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def map_rows(
    df: DataFrame, fn: Callable[[Iterable[dict]], Iterator[tuple]], schema: str, rows: int = 4096, arrow: bool = False
) -> DataFrame:
    """Run ``fn`` once per partition over its rows' columns, one list per column and batch, and stream out its tuples.

    ``fn`` gets an iterator of ``{column: list}``, or of the Arrow batches themselves with ``arrow``, and yields tuples in the
    order of ``schema``; at most ``rows`` of them are held before they leave as a batch.
    """
    spark = df.sparkSession
    small_batches(spark)
    fields = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists():
            for batch in batches:
                yield {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}

        held: list[tuple] = []
        for row in fn(batches if arrow else lists()):
            held.append(row)
            if len(held) >= rows:
                yield _batch(held, out)
                held = []
        if held:
            yield _batch(held, out)

    return df.mapInArrow(run, fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_or_empty(name: str = "text") -> F.Column:
    return F.coalesce(F.col(name), F.lit(""))
