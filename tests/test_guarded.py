import time

import pytest

from tallybook.plans.guarded import Ended, run_guarded
from tallybook.plans.landing import each_table, land_table, status
from tallybook.sources.tables import TableRef, read_table, table_exists

SLOW = "java_method('java.lang.Thread', 'sleep', 100L) is null"


def slow(spark):
    """Two minutes of work on two cores, a row every tenth of a second."""
    return spark.range(0, 2400, 1, 2).filter(SLOW)


def test_a_slow_table_is_ended_and_says_so(spark, tmp_path, rows):
    quick = TableRef("c", "s", "quick", str(tmp_path / "quick"))
    spark.range(5).write.parquet(quick.path)
    goals = [TableRef.under(str(tmp_path / "hub"), "c", "s", name) for name in ("slow", "quick")]

    def write_slowly():
        slow(spark).write.parquet(f"{goals[0].path}/batch-00000001")
        return status(goals[0], "created")

    started = time.monotonic()
    work = [(goals[0], write_slowly), (goals[1], lambda: land_table(spark, quick, goals[1]))]
    done = each_table(spark, work, False, 4, time_limit=20)
    assert time.monotonic() - started < 60
    got = {r["table"]: r for r in done.collect()}
    assert got["c.s.slow"]["action"] == "failed" and "time limit of 20 seconds" in got["c.s.slow"]["error"]
    assert got["c.s.quick"]["action"] == "created" and read_table(spark, goals[1]).count() == 5
    assert not table_exists(spark, goals[0])


def test_work_between_jobs_is_ended_at_its_next_job(spark):
    def many_jobs():
        while True:
            slow(spark).limit(1).count()

    (got,) = run_guarded(spark, [("many", many_jobs)], 1, time_limit=2)
    assert isinstance(got, Ended)


def test_the_first_failure_ends_the_others(spark):
    begun = []

    def fails():
        time.sleep(2)
        raise KeyError("no such table")

    started = time.monotonic()
    work = [("a", lambda: slow(spark).count()), ("b", fails), ("c", lambda: begun.append(1))]
    with pytest.raises(KeyError, match="no such table") as caught:
        run_guarded(spark, work, 2, fail_fast=True)
    assert time.monotonic() - started < 60 and not begun
    assert sorted(n.split(":")[0] for n in caught.value.__notes__) == ["a", "c"]
    assert spark.range(3).count() == 3  # later jobs run


def test_without_fail_fast_the_others_go_on(spark):
    def fails():
        raise ValueError("x")

    got = run_guarded(spark, [("a", fails), ("b", lambda: spark.range(3).count())], 2)
    assert isinstance(got[0], ValueError) and got[1] == 3
    assert run_guarded(spark, [], 2) == []
