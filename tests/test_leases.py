"""Of runs started together one writes; a lost lease cannot publish."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest

from tablesync import Project, SyncJob, TableSpec, run
from tablesync.connections import Files
from tablesync.errors import ConcurrentWriteError
from tablesync.plans.runlog import RunLog
from tablesync.sources.frames import FrameSource

NOW = datetime(2024, 5, 1)


def test_one_holder_at_a_time(spark, tmp_path):
    log, other = RunLog(spark, str(tmp_path)), RunLog(spark, str(tmp_path))
    first = log.lease("p", "t", NOW)
    assert first.token == 1 and other.lease("p", "t", NOW) is None and other.lease("p", "u", NOW).token == 1
    first.check()
    first.release()
    second = other.lease("p", "t", NOW)
    assert second.token == 2 and log.last_lease("p", "t") == 2
    with pytest.raises(ConcurrentWriteError):
        first.check()
    late = log.lease("p", "t", NOW + timedelta(days=2))  # the holder is gone: its time is over
    assert late.token == 3
    with pytest.raises(ConcurrentWriteError):
        second.check()
    with ThreadPoolExecutor(8) as pool:
        taken = [x for x in pool.map(lambda _: log.lease("p", "new", NOW), range(16)) if x]
    assert len(taken) == 1
    for _ in range(6):
        late.release()
        late = log.lease("p", "t", NOW)
    assert late.token == 9


def project(spark, tmp_path, **options):
    spec = TableSpec("t", "t", write_strategy="append", **options)
    return Project(str(tmp_path / "log"), {"in": FrameSource({"t": spark.range(10)}), "out": Files(str(tmp_path / "out"))}, [SyncJob("p", "in", "out", [spec])])


def test_of_runs_started_together_one_writes(spark, tmp_path):
    """Eight at once: a later one may follow an ended one, but none writes beside another."""
    plan = project(spark, tmp_path)
    with ThreadPoolExecutor(8) as pool:
        states = [r.status for found in pool.map(lambda _: run(plan, spark), range(8)) for r in found]
    done = states.count("completed")
    assert done >= 1 and set(states) <= {"completed", "skipped"}
    assert Files(str(tmp_path / "out")).frame(spark, "t").count() == 10 * done


@pytest.mark.parametrize("unit", ["slots", "files"])
def test_a_run_that_lost_its_lease_cannot_publish(spark, tmp_path, unit):
    """While it transforms, its time is over and another run takes the table."""

    def slow(df):
        log = RunLog(spark, str(tmp_path / "log"))
        assert log.lease("p", "t", datetime(2100, 1, 1)).token == 2
        return df

    plan = project(spark, tmp_path, transform=slow, upsert_unit=unit)
    with pytest.raises(Exception, match="took over"):
        run(plan, spark)
    assert not Files(str(tmp_path / "out")).target(spark, plan.jobs[0].tables[0]).exists()
