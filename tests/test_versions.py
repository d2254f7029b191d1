"""Versioned tables: what a broken, repeated, concurrent or partial load leaves behind."""

import datetime as dt

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.sources.versions import ConcurrentLoad, StoredTable, load_once, pointers_status
from ledgerline.spec import RunContext, TableSpec

SPEC = TableSpec("t", {"date_key": "bigint", "k": "string", "v": "double"}, ("date_key", "k"), ("year",), ("k",))
DDL = "date_key bigint, k string, v double"
AUDIT = TableSpec("dim_audit", fixed.DIM_AUDIT, ("audit_key", "script_name"))


def run(key):
    return RunContext(key, dt.datetime(2024, 1, 2), "f.csv", f"run-{key}")


def rows(spark, *values):
    return spark.createDataFrame(list(values), DDL)


@pytest.fixture
def stored(spark, tmp_path):
    made = StoredTable(spark, SPEC, str(tmp_path / "t"))
    made.overwrite(rows(spark, (20230101, "a", 1.0), (20240101, "a", 2.0), (None, "lost", 3.0)))
    return made


FIRST = {(20230101, "a", 1.0, 2023), (20240101, "a", 2.0, 2024), (None, "lost", 3.0, None)}


def broken(spark):
    df = rows(spark, (20240101, "a", 9.0), (20250101, "b", 9.0)).repartition(2, "k")
    return df.withColumn("v", F.when(F.col("k") == "b", F.raise_error(F.lit("broken off"))).otherwise(F.col("v")))


@pytest.mark.parametrize("how", ["overwrite", "merge"])
def test_a_load_that_breaks_leaves_the_table(spark, stored, how):
    with pytest.raises(Exception, match="broken off"):
        getattr(stored, how)(broken(spark))
    assert as_set(stored.read()) == FIRST and stored.versions() == [1]


def test_a_load_killed_before_its_pointer(spark, stored, monkeypatch):
    def killed(self, pointer):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(StoredTable, "_publish", killed)
        stored.overwrite(rows(spark, (20990101, "z", 0.0)))
    assert as_set(stored.read()) == FIRST
    stored.overwrite(rows(spark, (20200101, "n", 5.0)))
    assert as_set(stored.read()) == {(20200101, "n", 5.0, 2020)}
    assert as_set(stored.read(1)) == FIRST  # readers of the old version are not disturbed


def test_rows_without_a_date_survive_a_merge(spark, stored):
    kept = {f for f in stored.read().inputFiles() if "2024" not in f.rsplit("/", 2)[1]}
    for _ in range(2):
        assert stored.merge(rows(spark, (20240101, "a", 7.0), (20240102, "b", 8.0))) == 2
        assert as_set(stored.read()) == {(20230101, "a", 1.0, 2023), (20240101, "a", 7.0, 2024), (20240102, "b", 8.0, 2024), (None, "lost", 3.0, None)}
    assert kept == {f for f in stored.read().inputFiles() if "2024" not in f.rsplit("/", 2)[1]} and len(kept) == 2
    assert stored.status()[0] == 4


@pytest.mark.parametrize("bad", [(None, "x", 1.0), (20240101, None, 1.0)])
def test_staging_without_partition_or_key_is_refused(spark, stored, bad):
    with pytest.raises(ValueError, match="lack a value"):
        stored.merge(rows(spark, (20240101, "a", 7.0), bad))
    with pytest.raises(ValueError, match="duplicate"):
        stored.merge(rows(spark, (20240101, "a", 7.0), (20240101, "a", 8.0)))
    assert as_set(stored.read()) == FIRST


def test_of_two_loads_from_one_version_one_fails(spark, stored, monkeypatch):
    other = StoredTable(spark, SPEC, stored.path)
    began = stored.pointer()
    other.merge(rows(spark, (20240101, "a", 7.0)))
    monkeypatch.setattr(stored, "pointer", lambda version=None: began)
    with pytest.raises(ConcurrentLoad):
        stored.overwrite(rows(spark, (20200101, "n", 5.0)))
    assert (20240101, "a", 7.0, 2024) in as_set(other.read())


def test_vacuum_keeps_what_is_live(spark, stored):
    stored.merge(rows(spark, (20240101, "a", 7.0)))
    stored.merge(rows(spark, (20240101, "a", 8.0)))
    live = as_set(stored.read())
    assert stored.vacuum(5) == [] and len(stored.vacuum()) == 1  # the first load still holds 2023 and the undated row
    assert as_set(stored.read()) == live and stored.versions() == [3]
    with pytest.raises(ValueError, match="no version"):
        stored.read(1)


def test_append_conforms_and_repeats(spark, tmp_path):
    stored = StoredTable(spark, SPEC, str(tmp_path / "a"))
    texts = spark.createDataFrame([("1.5", "a", "20240101", "extra"), ("x", "b", "20230101", "extra")], "v string, k string, date_key string, other string")
    for key in (1, 2, 1):
        assert stored.append(texts, run(key)) == 2
    want = {(20240101, "a", 1.5, 2024), (20230101, "b", None, 2023)}
    assert as_set(stored.read()) == {(*r, key) for r in want for key in (1, 2)}
    assert {p.folder for p in stored.pointer().parts} == {f"run_key={k}/year={y}" for k in (1, 2) for y in (2023, 2024)}
    stored.append(texts.limit(0), run(2))  # the run now has no rows
    assert as_set(stored.read()) == {(*r, 1) for r in want} and stored.committed(run(2)) == 0
    with pytest.raises(ValueError, match="merge into"):
        stored.merge(rows(spark, (20240101, "a", 1.0)))


def test_empty_and_odd_tables(spark, tmp_path):
    none = StoredTable(spark, SPEC, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="holds no table"):
        none.read()
    assert none.status() == (0, 0) and none.committed(run(1)) is None
    none.overwrite(rows(spark, (1, "a", 1.0)).limit(0))
    assert none.read().count() == 0 and none.read().columns == ["date_key", "k", "v", "year"]
    assert none.merge(rows(spark, (20240101, "a", 1.0))) == 1 and none.read().count() == 1
    flat = TableSpec("f", {"id": "bigint", "v": "string"}, ("id",))
    whole = StoredTable(spark, flat, str(tmp_path / "flat"))
    whole.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"))
    whole.merge(spark.createDataFrame([(2, "c"), (3, "d")], "id bigint, v string"))
    assert as_set(whole.read()) == {(1, "a"), (2, "c"), (3, "d")}
    named = StoredTable(spark, TableSpec("n", {"id": "bigint", "part": "string"}, ("id",), ("part",)), str(tmp_path / "named"))
    named.overwrite(spark.createDataFrame([(1, "a b/c%=1"), (2, "é"), (3, None)], "id bigint, part string"))
    named.merge(spark.createDataFrame([(1, "a b/c%=1"), (4, "é")], "id bigint, part string"))
    assert as_set(named.read()) == {(1, "a b/c%=1"), (2, "é"), (4, "é"), (3, None)} and named.status()[0] == 4
    status = pointers_status({"named": named, "flat": whole}).collect()
    assert [(r["table"], r["row_count"]) for r in status] == [("named", 4), ("flat", 3)] and all(r["size_bytes"] > 0 for r in status)


def test_a_load_takes_effect_once(spark, tmp_path, monkeypatch):
    target, audit = StoredTable(spark, SPEC, str(tmp_path / "d")), StoredTable(spark, AUDIT, str(tmp_path / "audit"))
    data = rows(spark, (20240101, "a", 1.0), (20230101, "b", 2.0))
    log = lambda: as_set(audit.read(), "audit_key", "status", "rows_processed")
    with pytest.raises(Exception, match="broken off"):
        load_once(broken(spark), run(1), target, audit, "load")
    assert log() == {(1, "FAILED", None)} and target.pointer() is None
    # killed after the data went live, before the audit row was closed
    real, calls = audit.merge, []

    def once(row, **more):
        calls.append(row)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(row, **more)

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(audit, "merge", once)
        load_once(data, run(1), target, audit, "load")
    assert log() == {(1, "RUNNING", None)}
    for _ in range(2):
        assert load_once(data, run(1), target, audit, "load") == 2
    assert log() == {(1, "SUCCESS", 2)} and target.read().count() == 2 and len(target.versions()) == 1
    assert load_once(data, run(2), target, audit, "load") == 2
    assert log() == {(1, "SUCCESS", 2), (2, "SUCCESS", 2)} and target.read().count() == 4


def test_one_run_is_written_by_several_tasks(spark, tmp_path):
    spec = TableSpec("t", {"k": "bigint"})
    made = StoredTable(spark, spec, str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made.append(spark.range(0, 4000, 1, 4).select((F.col("id") % 2).alias("k")), run(1))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    written = made.read().groupBy(F.input_file_name()).count().collect()
    assert len(written) > 1 and max(r["count"] for r in written) < 4000 and sum(r["count"] for r in written) == 4000
