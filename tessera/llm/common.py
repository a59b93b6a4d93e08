"""Helpers shared by the operators of this subpackage.

Row-wise operators are ``mapInArrow`` jobs that take a frame, keep its columns
and add ONE struct column. An input column that has the name of the added one
is replaced, as ``withColumn`` does; no other name is touched, so extra columns
with any names pass through.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir

#: Text bytes that a row-wise operator holds as Python objects at a time.
SLICE_BYTES = 4 << 20
#: The six bytes that end a word; ``bytes.split()`` and ``bytes.strip()`` use the same.
WORD_SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    Executors may be lost afterwards, the rows stay. The schema is given to the
    reader, so that an empty frame keeps its columns.
    """
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of ``col`` (one row at least)."""
    values = batch.column(col)
    if len(values) == 0:
        return
    if values.nbytes <= limit:
        yield batch
        return
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def utf8(values: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return values.cast(pa.binary()).to_pylist()


def add_struct(df: DataFrame, text_col: str, out: str, fields: T.StructType,
               make: Callable[[list], dict[str, list]], keep: list[str] | None = None,
               as_bytes: bool = True, stateful: bool = False, limit: int = SLICE_BYTES) -> DataFrame:
    """``df`` and a struct column ``out``, made from ``text_col`` by ``make`` in Arrow batches.

    ``make`` gets the texts of a slice (UTF-8 bytes, or str, null as None) and
    returns a list for each field. ``keep`` may drop columns. ``stateful``: it
    uses ``worker_state``; ``limit``: bytes of text held at a time.
    """
    names = [c for c in (df.columns if keep is None else keep) if c != out]
    need = list(dict.fromkeys([*names, text_col]))
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField(out, fields)])
    kinds = [(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not stateful:
            release()
        for whole in batches:
            for b in slices(whole, text_col, limit):
                made = make(utf8(b.column(text_col)) if as_bytes else b.column(text_col).to_pylist())
                struct = pa.StructArray.from_arrays([pa.array(made[n], t) for n, t in kinds],
                                                    fields=[pa.field(n, t) for n, t in kinds])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), struct], names=[*names, out])

    return df.select(*[f"`{c}`" for c in need]).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


_state: dict = {}


def worker_state(key: tuple, make: Callable):
    """What a Python worker keeps from task to task (a codec, a memory of words), made anew where it is missing.

    A worker holds one such thing; the next operator's takes its place, so that
    a chain of operators needs no more memory than its largest one.
    """
    if key not in _state:
        release()
        _state[key] = make()
    return _state[key]


def release() -> None:
    """Give the held state's memory back to the system."""
    if _state:
        _state.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library keeps it for later use
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
