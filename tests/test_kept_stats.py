import os
import time

import pytest

from tallybook.plans import kept_stats
from tallybook.plans.kept_stats import kept_table_stats
from tallybook.plans.landing import append_new
from tallybook.plans.stats import table_stats
from tallybook.sources.registry import registry_of
from tallybook.sources.tables import TableRef


@pytest.fixture
def tables(spark, tmp_path):
    def ref(name, format="parquet"):
        return TableRef("c", "s", name, str(tmp_path / f"a b+{name}"), format)

    refs = [ref("p"), ref("o", "orc"), ref("v", "csv"), ref("ledger", "ledger"), ref("later")]
    spark.range(100).repartition(3).write.parquet(refs[0].path)
    spark.range(7).write.orc(refs[1].path)
    spark.range(4).write.csv(refs[2].path)
    append_new(spark.range(5), refs[3])
    return refs


@pytest.fixture
def run(spark, tables, tmp_path, rows):
    kept = TableRef("c", "hub", "kept", str(tmp_path / "kept"))

    def go():
        stats, opened = kept_table_stats(spark, registry_of(spark, tables), kept)
        assert rows(stats) == rows(table_stats(spark, registry_of(spark, tables)))
        return {r["table_name"]: r["row_count"] for r in stats.collect()}, opened

    return go


def parts_of(ref):
    return sorted(f"{ref.path}/{f}" for f in os.listdir(ref.path) if f.startswith("part-"))


def test_only_changed_files_are_counted(spark, tables, run):
    counts, opened = run()
    assert counts == {"p": 100, "o": 7, "v": 4, "ledger": 5} and opened >= 6
    assert run() == (counts, 0)

    spark.range(50).coalesce(1).write.mode("append").parquet(tables[0].path)  # one file more
    append_new(spark.range(8), tables[3])
    spark.range(2).coalesce(1).write.parquet(tables[4].path)  # a table more
    counts, opened = run()
    assert counts == {"p": 150, "o": 7, "v": 4, "ledger": 8, "later": 2}
    assert 3 <= opened <= 10

    for part in parts_of(tables[2]):  # deleted
        os.remove(part)
    for part in parts_of(tables[1])[1:]:
        os.remove(part)
    spark.range(9).coalesce(1).write.mode("overwrite").orc(tables[1].path)  # replaced
    counts, opened = run()
    assert counts["o"] == 9 and "v" not in counts and opened == 1


def test_a_known_file_is_not_opened(spark, tables, tmp_path):
    kept = TableRef("c", "hub", "kept", str(tmp_path / "kept"))
    registry = registry_of(spark, tables[:1])
    assert kept_table_stats(spark, registry, kept)[0].first()["row_count"] == 100
    for part in parts_of(tables[0]):  # what would be an error if it were read
        before = os.stat(part)
        with open(part, "r+b") as file:
            file.write(b"\0" * before.st_size)
        crc = f"{tables[0].path}/.{os.path.basename(part)}.crc"
        if os.path.exists(crc):
            os.remove(crc)
        os.utime(part, ns=(before.st_atime_ns, before.st_mtime_ns))
    stats, opened = kept_table_stats(spark, registry, kept)
    assert (stats.first()["row_count"], opened) == (100, 0)


def test_a_file_of_the_same_length_and_another_time_is_counted(spark, tables, run):
    run()
    time.sleep(0.01)
    os.utime(parts_of(tables[0])[0])
    assert run()[1] == 1


def test_beyond_the_bound_of_names_folders_are_counted(spark, tables, run, monkeypatch):
    monkeypatch.setattr(kept_stats, "FILES_BY_NAME", 0)
    counts, opened = run()
    assert counts == {"p": 100, "o": 7, "v": 4, "ledger": 5} and opened >= 6
    spark.range(50).coalesce(1).write.mode("append").parquet(tables[0].path)
    counts, opened = run()
    assert counts["p"] == 150 and opened == 1


def test_no_tables(spark, tmp_path):
    kept = TableRef("c", "hub", "kept", str(tmp_path / "kept"))
    stats, opened = kept_table_stats(spark, registry_of(spark, []), kept)
    assert (stats.count(), opened) == (0, 0)
