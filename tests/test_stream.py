import os

import pytest
from pyspark.sql import functions as F

from tablesync import FileTarget, ingest_available

SCHEMA = "id int, t int, v string"


@pytest.fixture
def feed(spark, tmp_path):
    """Drops one file with rows into the folder the stream reads."""
    count = iter(range(100))

    def drop(*data):
        path = tmp_path / "in" / f"{next(count):03d}"
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.parquet(str(path))
        os.utime(path)

    return drop


@pytest.fixture
def ingest(spark, tmp_path):
    target = FileTarget(spark, str(tmp_path / "out"))

    def call(cp="cp", **options):
        schema = spark.createDataFrame([], SCHEMA).schema
        options = {"options": {"recursiveFileLookup": "true", "maxFilesPerTrigger": "1"}, **options}
        ingest_available(spark, str(tmp_path / "in"), schema, target, str(tmp_path / cp), **options)
        return target

    return call


def test_each_file_is_loaded_once(feed, ingest, rows):
    feed((1, 1, "a"))
    feed((2, 1, "b"))
    assert rows(ingest().read(), "id") == [(1,), (2,)]
    assert rows(ingest().read(), "id") == [(1,), (2,)]
    feed((3, 1, "c"))
    assert rows(ingest().read(), "id") == [(1,), (2,), (3,)]


def test_latest_row_wins_whatever_file_it_comes_in(feed, ingest, rows):
    feed((1, 5, "new"), (2, 1, "x"), (1, 3, "mid"))
    feed((1, 2, "late"), (2, 7, "y"))
    target = ingest(key=["id"], order="t")
    assert rows(target.read()) == [(1, 5, "new"), (2, 7, "y")]
    feed((1, 6, "newest"), (3, 0, "z"))
    assert rows(ingest(key=["id"], order="t").read()) == [(1, 6, "newest"), (2, 7, "y"), (3, 0, "z")]


def test_batch_repeated_after_a_failure_is_skipped(feed, ingest, rows, monkeypatch):
    """The target is written but the stream dies before it notes the batch."""
    append = FileTarget.append

    def append_then_die(self, *args, **kwargs):
        append(self, *args, **kwargs)
        raise RuntimeError("lost")

    feed((1, 1, "a"))
    monkeypatch.setattr(FileTarget, "append", append_then_die)
    with pytest.raises(Exception, match="lost"):
        ingest()
    monkeypatch.setattr(FileTarget, "append", append)
    assert rows(ingest().read(), "id") == [(1,)]


def test_a_new_checkpoint_reads_everything_again(feed, ingest, rows):
    feed((1, 1, "a"))
    ingest(key=["id"], order="t")
    feed((1, 2, "b"), (2, 1, "c"))
    assert rows(ingest("other", key=["id"], order="t").read()) == [(1, 2, "b"), (2, 1, "c")]


def test_transform_runs_on_each_batch(feed, ingest, rows):
    feed((1, 1, "a"), (2, 1, "b"))
    target = ingest(transform=lambda df: df.where("id > 1").withColumn("v", F.upper("v")))
    assert rows(target.read()) == [(2, 1, "B")]
