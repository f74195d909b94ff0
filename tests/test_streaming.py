import shutil

import pytest

from tallybook.sources.tables import TableRef, read_table
from tallybook.plans.landing import append_new
from tallybook.streaming.distinct import keep_distinct
from tallybook.streaming.landing import land_stream, stream_table


def test_stream_lands_what_a_batch_lands(spark, tmp_path, rows):
    source, checkpoint = str(tmp_path / "source"), str(tmp_path / "checkpoint")
    streamed = TableRef.under(str(tmp_path / "root"), "c", "s", "streamed")
    landed = TableRef.under(str(tmp_path / "root"), "c", "s", "landed")
    for ids in (range(0, 5), range(3, 8)):
        batch = spark.createDataFrame([(i, f"n{i}") for i in ids], "i int, s string")
        batch.write.mode("append").parquet(source)
        stream = stream_table(spark, source, batch.schema, maxFilesPerTrigger="1")
        query = land_stream(stream, streamed, checkpoint)
        assert query.awaitTermination(120)
        append_new(spark.read.parquet(source), landed, dedupe=True)
    assert rows(read_table(spark, streamed)) == rows(read_table(spark, landed))
    assert read_table(spark, streamed).count() == 8


def test_kept_distinct_rows_read_new_files_only(spark, tmp_path, rows):
    source, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    kept = TableRef.under(str(tmp_path / "root"), "c", "s", "kept")
    schema = "a int, b string, other double"
    runs = [
        [(1, "x", 0.1), (1, "x", 0.2), (None, None, 0.3), (2, None, 0.4)],
        [(1, "x", 0.5), (3, "y", 0.6), (None, None, 0.7), (3, "y", 0.8)],
        [(3, "y", 0.9)],
    ]
    sizes = []
    for i, data in enumerate(runs):
        folder = f"{source}/day={i}"
        spark.createDataFrame(data, schema).write.parquet(folder)
        stream = stream_table(spark, source, spark.createDataFrame([], schema).schema)
        assert keep_distinct(stream, ["a", "b"], kept, checkpoint).awaitTermination(120)
        sizes.append(read_table(spark, kept).count())
        for part in (tmp_path / "log" / f"day={i}").glob("*part-*"):  # reading it again would be an error
            part.write_bytes(b"no parquet")
    assert sizes == [3, 4, 4]
    assert rows(read_table(spark, kept)) == sorted([(1, "x"), (2, None), (3, "y"), (None, None)], key=repr)
    shutil.rmtree(source)
    assert read_table(spark, kept).count() == 4


def test_distinct_rows_are_kept_in_a_ledger(spark, tmp_path):
    plain = TableRef("c", "s", "kept", str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="ledger"):
        keep_distinct(spark.range(1), ["id"], plain, str(tmp_path / "checkpoint"))
