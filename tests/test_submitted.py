"""Independent fits that share the cores."""

from pyspark.sql import functions as F

from tabulon import session


def test_jobs_run_together_and_keep_their_order(spark):
    """two jobs that wait for each other end, which they never did one after the other."""
    import threading
    both = threading.Barrier(2, timeout=60)

    def job(n):
        both.wait()
        return n, spark.range(n).count()

    assert session.submitted(spark, [lambda n=n: job(n) for n in (5, 3, 9, 7)], 2) == [(5, 5), (3, 3), (9, 9), (7, 7)]


def test_only_tables_in_few_tasks_are_fitted_together(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    small = spark.range(0, 1000, 1, 4 * cores)
    assert session.at_once(small) == 1
    # one task holds the rows, however many there are
    assert session.at_once(spark.range(0, 1000, 1, 1)) == cores
    assert session.at_once(small.repartition(4 * cores, F.lit(1))) == cores
    assert session.at_once(small.where("id < 0")) >= 1
    monkeypatch.setattr(session, "ROWS_AT_ONCE", 2500)
    assert session.at_once(spark.range(0, 1000, 1, 1)) == min(2, cores)
    assert session.at_once(spark.range(0, 10000, 1, 1)) == 1
