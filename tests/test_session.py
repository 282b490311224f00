"""Stored tables belong to a run."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks import tables as T
from platterflow import constants as K
from platterflow.operators import cleaning, orders
from platterflow.plans import cancellation
from platterflow.session import Run, keep, pin, shared_folder

FOLDER = "/root/testdata/sf0.01"


def test_scores_after_writing_and_an_empty_folder_after_closing(spark, tmp_path):
    lines = T.order_lines(spark, FOLDER, T.BOOKING).filter("booking_date < '2001-08-01'")
    with Run(spark) as run:
        result = cancellation.run(lines, maximum=2000, trees=K.CANCELLATION_TREES | {"trees": 3, "depth": 3})
        cancellation.write(result, str(tmp_path))
        assert result.scored.count() > 0
        fresh = orders.booking_features(cleaning.booking_lines(lines)).limit(50)
        assert result.model.score(fresh).filter(F.col("prediction").isNotNull()).count() == 50
        assert os.listdir(run.folder)
    assert not os.path.exists(run.folder)


def test_a_run_deletes_its_own_tables_only(spark):
    with Run(spark) as outer:
        kept = keep(spark.range(5))
        with Run(spark):
            pinned = pin(spark.range(7))
            assert pinned.count() == 7
        assert kept.count() == 5 and os.listdir(outer.folder)


def test_a_folder_has_to_be_named():
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(unset)
