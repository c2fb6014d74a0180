"""Task retries reproduce the same rows (jobs survive lost tasks / executors)."""

from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators import clean, model
from blotter.sources import adapter


@F.udf(T.StringType())
def _fail_first_attempt(v):
    # test-only: kill the first attempt of every task that runs this projection
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task loss")
    return v


def test_dedup_survives_task_retries(spark, sf_small):
    assert spark.sparkContext.master.endswith(",4]")
    bronze = adapter.bronze_from_star(spark, sf_small)
    clean_run = model.gold(clean.silver(bronze))
    flaky = bronze.withColumn("dr_no", _fail_first_attempt("dr_no"))
    retried = model.gold(clean.silver(flaky))
    assert retried.exceptAll(clean_run).count() == 0
    assert clean_run.exceptAll(retried).count() == 0
