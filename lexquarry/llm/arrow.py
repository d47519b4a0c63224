"""Arrow-batch helpers: one Python call per batch, never one per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, list] | None], schema: str) -> DataFrame:
    """Apply ``work`` to each Arrow batch of ``df``; it returns columns of ``schema``, or None for no rows."""
    names_types = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(names_types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
