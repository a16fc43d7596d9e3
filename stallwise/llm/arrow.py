"""Row-wise Python over Arrow batches, in slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_ROWS = 256
SLICE_BYTES = 4 << 20
#: Rows that Spark hands to a worker at once, where the session leaves it at Spark's default of ten thousand: the JVM
#: and the worker both hold a batch whole.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_AT_ONCE = 1000


_held: list[Callable[[], None]] = []


def hold(clear: Callable[[], None]) -> None:
    """Say from ``make`` that this worker keeps a model or cache between tasks; ``clear`` drops it when a task of another kind comes."""
    if clear not in _held:
        _held.append(clear)


def hand_back() -> None:
    """Give memory that is free back to the system: workers are reused, keep it from the operators before, and wait with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice holds more than ``SLICE_ROWS`` rows or, beyond one row, ``SLICE_BYTES``."""
    step = max(1, min(SLICE_ROWS, int(SLICE_BYTES * batch.num_rows / max(1, batch.nbytes))))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def with_python(
    d: DataFrame, inputs: list[str], added: str, make: Callable[[], Callable], drop: list[str] | None = None
) -> DataFrame:
    """Add the columns of the schema string ``added``, computed row by row in Python.

    ``make`` is called once in each task and gives a function from the lists of the input columns to
    an iterable of one tuple per row. Columns in ``drop`` do not go back to the JVM. A new column
    whose name ``d`` already has raises. A session that leaves BATCH_ROWS at Spark's default gets ROWS_AT_ONCE.
    """
    if d.sparkSession.conf.get(BATCH_ROWS) == "10000":
        d.sparkSession.conf.set(BATCH_ROWS, ROWS_AT_ONCE)
    kept = [f for f in d.schema.fields if f.name not in (drop or [])]
    new = T._parse_datatype_string(added).fields
    clash = {f.name for f in kept} & {f.name for f in new}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    schema = T.StructType(kept + new)
    arrow = to_arrow_schema(T.StructType(new))
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = list(_held)
        _held.clear()
        each = make()
        for clear in before:
            if clear not in _held:
                clear()
        hand_back()
        for batch in batches:
            for part in slices(batch):
                rows = list(each(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in inputs)))
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
                arrays = [part.column(part.schema.get_field_index(c)) for c in names]
                arrays += [pa.array(list(v), type=f.type) for v, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names + arrow.names)
                del rows, columns, arrays, part
        batch = each = None
        hand_back()

    return d.mapInArrow(run, schema)


def free_name(d: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``d`` has no column of, whatever the letter case."""
    taken = {c.lower() for c in d.columns}
    while name.lower() in taken:
        name += "_"
    return name
