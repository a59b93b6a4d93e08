import shutil
import tempfile

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.plans import prep
from tessera.plans.ml import TabularPrep, TabularPrepModel


def frame(spark, n=60):
    rows = [(i, None if i % 7 == 0 else float(i % 11), float(i * i % 13), f"c{i % 5}" if i % 9 else None, i % 3 if i % 10 else None) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, kind string, sii int")


CFG = {"target": "sii", "keys": ("id",)}


def arrays(df, by="id"):
    return {r[by]: [round(x, 9) for x in r.f] for r in df.select(by, vector_to_array("features").alias("f")).collect()}


@pytest.mark.parametrize("extra", [{"imp": "median"}, {"imp": "mean", "fts": "f_classif", "k_best": 3}, {"imp": "mean", "fts": "pca"},
                                   {"imp": "knn"}, {"imp": "mean", "max_categories": 2}])
def test_saved_and_loaded_as_a_stage(spark, extra):
    df = frame(spark)
    new = df.where("id % 2 = 0").drop("sii", "b").withColumn("_row", F.lit("mine")).withColumn("other", F.col("id") * 2)
    cfg = prep.PrepConfig(**CFG, **extra)
    model = Pipeline(stages=[TabularPrep(cfg)]).fit(df)
    first = model.transform(new)
    assert first.columns == [*new.columns, "features"] and first.where("other = 2 * id AND _row = 'mine'").count() == new.count()
    d = tempfile.mkdtemp()
    model.write().overwrite().save(d + "/model")
    model.write().overwrite().save(d + "/model")
    shutil.move(d + "/model", d + "/moved")
    again = PipelineModel.load(d + "/moved")
    assert isinstance(again.stages[0], TabularPrepModel) and again.stages[0].uid == model.stages[0].uid
    assert arrays(again.transform(new)) == arrays(first)
    plain = prep.transform(new, model.stages[0].state)
    if extra.get("max_categories"):
        plain = prep.densify(plain)
    assert {r.id: [round(x, 9) for x in r.features] for r in plain.collect()} == arrays(first)


def test_with_a_learner_behind_it(spark):
    df = frame(spark).where("sii IS NOT NULL")
    both = Pipeline(stages=[TabularPrep(prep.PrepConfig(**CFG), "x"), LogisticRegression(featuresCol="x", labelCol="sii", maxIter=5)])
    model = both.fit(df)
    assert model.transform(df.drop("sii")).where("prediction IN (0, 1, 2)").count() == df.count()


def test_the_estimator_itself_is_saved(spark):
    d = tempfile.mkdtemp() + "/stage"
    TabularPrep(prep.PrepConfig(**CFG, imp="mean"), "x", asVector=False).save(d)
    stage = TabularPrep.load(d)
    assert stage.prep_config() == prep.PrepConfig(**CFG, imp="mean")
    got = stage.fit(frame(spark)).transform(frame(spark))
    assert got.schema["x"].dataType.simpleString() == "array<double>" and got.count() == 60


def test_what_is_refused(spark):
    with pytest.raises(ValueError, match="balance"):
        TabularPrep(prep.PrepConfig(**CFG, imb="smote")).fit(frame(spark))
    model = TabularPrep(prep.PrepConfig(**CFG)).fit(frame(spark))
    with pytest.raises(ValueError, match="exists"):
        model.transform(frame(spark).withColumn("features", F.lit(1)))
    with pytest.raises(ValueError, match="unknown"):
        TabularPrep()._set(config='{"impute": 1}').prep_config()
