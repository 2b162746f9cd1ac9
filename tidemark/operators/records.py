"""A caller's own Python function over the records of a column.

The function gets one record and returns its fields, or None to drop it. Records go
through in Arrow batches, in whatever tasks they lie in; nothing is collected. A
record that makes the function raise, or whose fields do not have the promised types,
ends nothing: it stays a row, without fields, with the record itself and a code.

Results: NULL records are given to the function like others. Repeated rows stay
repeated, and an empty table gives an empty table. Running out of memory is no fault of
a record and is raised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

ERROR, RECORD = "_error", "_record"
# The code of a record whose fields do not fit; any other code is the name of what was raised.
BAD_FIELDS = "BadFields"


def mapped_records(
    df: DataFrame, column: str, function: Callable[[object], dict | None], fields: StructType | str, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep``, the fields the function returns, and ``_error`` and ``_record`` of rejected records."""
    promised = StructType.fromDDL(fields) if isinstance(fields, str) else fields
    keep = keep or []
    taken = {*keep, ERROR, RECORD}
    if taken & set(promised.names) or len(taken) < len(keep) + 2:
        raise ValueError(f"fields must not be named like {sorted(taken)}")
    whole = df.select(*keep, F.col(column).alias(RECORD))
    out = StructType([*(whole.schema[c] for c in keep), *promised.fields, StructField(ERROR, StringType()), StructField(RECORD, whole.schema[RECORD].dataType)])
    arrow = to_arrow_schema(out)
    shape = pa.struct([arrow.field(n) for n in promised.names])

    def one(record) -> tuple[bool, dict | None, str | None]:
        """Whether a row comes of a record, its fields, and the code if it is rejected."""
        try:
            found = function(record)
            if found is None:
                return False, None, None
            pa.array([found], shape)
            return True, found, None
        except MemoryError:
            raise
        except (pa.ArrowInvalid, pa.ArrowTypeError):
            return True, None, BAD_FIELDS
        except Exception as e:
            return True, None, type(e).__name__

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            records = part.column(RECORD)
            rows = [one(r.as_py()) for r in records]
            at = pa.array([i for i, (comes, _, _) in enumerate(rows) if comes], pa.int64())
            rows = [r for r in rows if r[0]]
            values = pa.array([found for _, found, _ in rows], shape)
            codes = pa.array([code for _, _, code in rows], pa.string())
            left = pa.array([record if code else None for record, (_, _, code) in zip(records.take(at).to_pylist(), rows)], arrow.field(RECORD).type)
            columns = [*(part.column(c).take(at).cast(arrow.field(c).type) for c in keep), *values.flatten(), codes, left]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return whole.mapInArrow(batches, out)


def accepted(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col(ERROR).isNull()).drop(ERROR, RECORD)


def rejected(mapped: DataFrame) -> DataFrame:
    """``keep`` columns are there too; fields are not."""
    return mapped.filter(F.col(ERROR).isNotNull())
