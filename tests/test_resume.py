"""Chunks that are committed one by one, stops half-way, and rows that come later."""

import pytest
from pyspark.sql import functions as F

from twinscope.operators.resume import ChunkedWork


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(k, f"text {k}") for k in range(50)] + [(None, "x"), (3, "again")], "key long, text string")


def shout(chunk):
    return chunk.select("key", F.upper("text").alias("text"))


def test_a_stop_after_some_chunks_and_a_half_written_one(spark, table, tmp_path):
    work = ChunkedWork(spark, str(tmp_path / "w"), table, "key", chunks=6)
    with pytest.raises(ValueError, match="no chunk"):
        work.results()
    assert work.run(shout, at_most=2) == 2
    first = dict(work.committed())

    seen = []

    def fails_late(chunk):
        seen.append(1)
        if len(seen) == 2:
            return shout(chunk).where(F.raise_error(F.lit("a lost machine")).isNull())
        return shout(chunk)

    with pytest.raises(Exception, match="a lost machine"):
        work.run(fails_late)
    assert len(work.committed()) == 3
    # Written to the end, yet not committed: not read, and done again under another name.
    (tmp_path / "w" / "data" / "3.7").mkdir()
    (tmp_path / "w" / "data" / "3.7" / "part-0.parquet").write_text("half")
    (tmp_path / "w" / "commits" / "3.7.tmp").write_text("")

    again = ChunkedWork(spark, str(tmp_path / "w"), table, "key", chunks=6)
    calls = []

    def counted(chunk):
        calls.append(1)
        return shout(chunk)

    assert again.run(counted) == 3 and len(calls) == 3
    assert {k: v for k, v in again.committed().items() if k in first} == first
    assert again.committed()["3"].endswith("/3.8")
    assert rows(again.results()) == rows(shout(table))
    assert again.run(counted) == 0


def test_later_rows_are_appended_once(spark, table, tmp_path):
    work = ChunkedWork(spark, str(tmp_path / "w"), table, "key", chunks=2)
    work.run(shout)
    more = table.unionByName(spark.createDataFrame([(100, "new"), (101, "newer")], table.schema)).where("key is not null")
    assert rows(work.pending(more).select("key")) == [(100,), (101,)]
    for _ in range(2):
        work.append(shout, more, "monday")
    assert rows(work.results()) == rows(shout(table.unionByName(more.where("key >= 100"))))


def test_an_empty_table(spark, table, tmp_path):
    work = ChunkedWork(spark, str(tmp_path / "w"), table.limit(0), "key", chunks=3)
    assert work.run(shout) == 3 and work.results().count() == 0
