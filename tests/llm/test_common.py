import pyarrow as pa
import pytest

from tessera.llm.common import add_struct, free_name, materialize, slices
from pyspark.sql import types as T


@pytest.mark.parametrize("limit", [1, 10, 1000])
def test_slices_keep_every_row(limit):
    b = pa.RecordBatch.from_arrays([pa.array([None, "", "x" * 50, "ab", None, "y" * 9])], names=["t"])
    parts = list(slices(b, "t", limit))
    assert [v for p in parts for v in p.column("t").to_pylist()] == b.column("t").to_pylist()
    assert not list(slices(b.slice(0, 0), "t"))


def test_add_struct_replaces_only_its_own_name(spark, docs):
    fields = T.StructType([T.StructField("n", T.LongType())])
    got = add_struct(docs, "text", "scan", fields, lambda ts: {"n": [len(t or b"") for t in ts]})
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == docs.count()
    assert free_name(docs, "SCAN") == "SCAN_"


def test_materialize_keeps_an_empty_schema(none):
    got = materialize(none, "none")
    assert got.columns == none.columns and got.count() == 0
