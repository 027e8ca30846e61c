"""Helpers for operators that work on whole texts in Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of an Arrow batch that Python turns into objects at a time.
SLICE_ROWS = 256


def add_columns(
    rows: DataFrame, make: Callable[[], Callable[..., tuple]], ddl: str, reads: Sequence[str] = ("text",), keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` as it is and new columns ``ddl``, a tuple that a function gives per row.

    ``make`` is called once per task and returns the function of the columns ``reads``. Kept
    columns stay in Arrow, so their nulls and values are not touched.
    """
    narrow = rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, *reads])])
    new = StructType.fromDDL(ddl)
    schema = StructType([*[narrow.schema[c] for c in keep], *new.fields])
    target = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                made = [one(*values) for values in zip(*[b.column(c).to_pylist() for c in reads], strict=True)]
                columns = list(zip(*made, strict=True)) if made else [[] for _ in new.fields]
                kept = [b.column(c).cast(target.field(c).type) for c in keep]
                extra = [pa.array(v, target.field(f.name).type) for v, f in zip(columns, new.fields, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *extra], schema=target)

    return narrow.mapInArrow(each, schema)
