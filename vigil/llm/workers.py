"""What runs around the Python tasks: shipping the package, Arrow batches, memos."""

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_shipped: set[str] = set()

#: Entries a worker keeps of one memo; beyond it words are computed each time.
MEMO_ENTRIES = 1_000_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="vigil-code-"), "vigil_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


class Memo(dict):
    """Remember compute(key) for at most MEMO_ENTRIES keys."""

    def __init__(self, compute: Callable, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.entries = compute, entries

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.entries:
            self[key] = value
        return value


def map_batches(df: DataFrame, task: Callable[[], Callable[[pa.RecordBatch], dict]],
                schema: str) -> DataFrame:
    """Apply task() per partition, then its result to each Arrow batch.

    The result is a dict of columns named as in schema, or None for no rows.
    """
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = task()
        for batch in batches:
            columns = work(batch)
            if columns is not None:
                yield record_batch(columns, arrow)
        # Workers wait for other work; what Arrow keeps for itself is an executor's memory.
        batch = columns = None
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, struct)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        column = columns[field.name]
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if isinstance(column, pa.Array):
            arrays.append(column if column.type == field.type else column.cast(field.type))
        else:
            arrays.append(pa.array(column, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8; null is the empty text."""
    return texts_of(batch.column(column))


def texts_of(array: pa.Array) -> list[bytes]:
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return [b or b"" for b in array.cast(kind).to_pylist()]
