"""Fits of a small table are one task each while tuning, and all rows take part."""

import pytest
from pyspark.sql import functions as F

from provisio.operators import models as mo


class Seen(Exception):
    pass


def test_a_small_table_is_tuned_in_one_task_a_fit(spark, monkeypatch):
    ml = spark.range(0, 400, 1, 8).select(F.col("id").alias("product_id"), (F.col("id") % 7).cast("double").alias("qty_mean"),
                                          (F.col("id") % 11).cast("double").alias("eoq"), F.rand(1).alias("priority_score"))
    given = {}

    class Validator:
        def __init__(self, **params):
            given.update(params)

        def fit(self, train):
            given["train"] = train
            raise Seen

    monkeypatch.setattr(mo, "CrossValidator", Validator)
    with pytest.raises(Seen):
        mo.tuned_models(ml, "demand_forecast")
    assert given["train"].rdd.getNumPartitions() == 1
    assert len(given["estimatorParamMaps"]) == 24 and given["numFolds"] == 5
    assert given["train"].count() == ml.where(~mo.split_flag()).count() > 0


def test_parts_follow_the_rows():
    assert [mo._tuning_parts(n) for n in (0, 1, mo.TUNING_ROWS, mo.TUNING_ROWS + 1, 24 * mo.TUNING_ROWS)] == [1, 1, 1, 2, 24]
