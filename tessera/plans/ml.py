"""The tabular preparation as a ``pyspark.ml`` estimator.

``TabularPrep`` fits what ``prep.fit_transform`` fits (fills, scaler,
categories, selection); ``TabularPrepModel`` is the lazy transform of new
rows. Both stand in a ``Pipeline`` and are saved and loaded with it. A saved
model holds copies of its category tables and donors, named relative to its
folder, so that it outlives the shared checkpoint folder and may be moved.
"""

from __future__ import annotations

import json
from dataclasses import asdict, fields

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
                             MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import prep


class _PrepParams(Params):
    config = Param(Params._dummy(), "config", "PrepConfig as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "name of the features", TypeConverters.toString)
    asVector = Param(Params._dummy(), "asVector", "features as a vector that further stages read, not as an array", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(config="{}", outputCol="features", asVector=True)

    def prep_config(self) -> prep.PrepConfig:
        known = {f.name for f in fields(prep.PrepConfig)}
        given = json.loads(self.getOrDefault(self.config))
        if set(given) - known:
            raise ValueError(f"unknown settings: {sorted(set(given) - known)}")
        return prep.PrepConfig(**{k: tuple(v) if k == "keys" else v for k, v in given.items()})


class TabularPrep(Estimator, _PrepParams, DefaultParamsWritable, DefaultParamsReadable):
    """Estimator of the tabular preparation. Balancing (``imb``) changes rows and belongs to ``prep.fit_transform``; it is refused here."""

    def __init__(self, config: prep.PrepConfig | None = None, outputCol: str = "features", asVector: bool = True):
        super().__init__()
        self._set(outputCol=outputCol, asVector=asVector)
        if config is not None:
            self._set(config=json.dumps(asdict(config)))

    def _fit(self, dataset: DataFrame) -> "TabularPrepModel":
        cfg = self.prep_config()
        if cfg.imb not in (None, "none"):
            raise ValueError("a pipeline stage keeps the rows: balance them by prep.fit_transform")
        _, state, _ = prep.fit_transform(dataset, cfg)
        return self._copyValues(TabularPrepModel(state))


class TabularPrepModel(Model, _PrepParams, MLWritable, MLReadable):
    """All columns of a frame and the features of its rows, by the fitted state. Columns the state knows and the
    frame lacks are filled as nulls are, others ride along."""

    def __init__(self, state: prep.PrepState | None = None):
        super().__init__()
        self.state = state

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, row = self.getOrDefault(self.outputCol), "_row"
        if out in dataset.columns:
            raise ValueError(f"the output column {out} exists already")
        while row in dataset.columns:
            row += "_"
        made = prep.transform(dataset.withColumn(row, F.struct("*")), self.state, "_features", keep=[row])
        x = F.col("_features")
        if self.getOrDefault(self.asVector):
            x = _as_vector(x) if "size" in getattr(made.schema["_features"].dataType, "names", ()) else array_to_vector(x)
        return made.select(f"{row}.*", x.alias(out))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


@F.udf(VectorUDT())
def _as_vector(v):
    return None if v is None else Vectors.sparse(v.size, v.indices, v["values"])


def export_state(spark: SparkSession, state: prep.PrepState, path: str) -> None:
    """The state as JSON beside copies of the tables that it names."""
    out = prep.PrepState.from_json(state.to_json())
    for i, (_, table) in enumerate(sorted(out.tables.items())):
        spark.read.parquet(table["path"]).write.mode("overwrite").parquet(f"{path}/categories-{i}")
        table["path"] = f"categories-{i}"
    if out.knn_donors:
        spark.read.parquet(out.knn_donors).write.mode("overwrite").parquet(f"{path}/donors")
        out.knn_donors = "donors"
    prep.save_state(spark, out, f"{path}/state")  # last: a folder with a state is whole


def import_state(spark: SparkSession, path: str) -> prep.PrepState:
    state = prep.load_state(spark, f"{path}/state")
    for table in state.tables.values():
        table["path"] = f"{path}/{table['path']}"
    if state.knn_donors:
        state.knn_donors = f"{path}/{state.knn_donors}"
    return state


class _ModelWriter(MLWriter):
    def __init__(self, instance: TabularPrepModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        export_state(self.sparkSession, self.instance.state, f"{path}/fitted")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TabularPrepModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession, f"{self.cls.__module__}.{self.cls.__name__}")
        model = self.cls(import_state(self.sparkSession, f"{path}/fitted"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
