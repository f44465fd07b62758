from __future__ import annotations

import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratastar import operators as op
from stratastar import session
from stratastar.sources import bronze, ingest, ordered
from stratastar.sources.layout import Layout
from stratastar.sources.state import BUCKET, BucketMismatch, LatestState
from stratastar.streaming import append_available


def test_contract(spark):
    batch = spark.createDataFrame([(1, 2.5)], "b int, a double")
    assert bronze.as_source(batch, ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(bronze.ContractError, match=r"missing=\['c'\] extra=\['b'\]"):
        bronze.conform(batch, ["a", "c"], "t")


def test_append_adds_batches_and_replaces_reruns(spark, tmp_path):
    batch = spark.createDataFrame([("x", date(2025, 1, 1)), ("y", date(2025, 1, 2))], "v string, day date")
    path = str(tmp_path / "t")
    bronze.append_versions(batch, path, day="day", batch_id="a")
    bronze.append_versions(batch.where("v = 'y'"), path, day="day", batch_id="b")
    bronze.append_versions(batch, path, mode="dry_run")
    assert sorted(r.v for r in bronze.read_versions(spark, path).collect()) == ["x", "y", "y"]
    bronze.append_versions(batch.where("v = 'x'"), path, day="day", batch_id="a")
    assert sorted((r.v, r.batch_id) for r in bronze.read_versions(spark, path).collect()) == [("x", "a"), ("y", "b")]
    read = bronze.read_versions(spark, path, "v string, w int, day date, batch_id string")
    assert set(read.columns) == {"v", "w", "day", "batch_id"} and {r.w for r in read.collect()} == {None}
    bronze.append_versions(batch, str(tmp_path / "u"), day="day")
    bronze.append_versions(batch, str(tmp_path / "u"), day="day")
    assert bronze.read_versions(spark, str(tmp_path / "u")).count() == 4


def test_append_merges_schemas(spark, tmp_path):
    path = str(tmp_path / "t")
    bronze.append_versions(spark.createDataFrame([("x",)], "a string"), path)
    bronze.append_versions(spark.createDataFrame([("y", "z")], "a string, b string"), path)
    assert {(r.a, r.b) for r in bronze.read_versions(spark, path).collect()} == {("x", None), ("y", "z")}


def test_ingest_folder(spark, tmp_path):
    folder, target = tmp_path / "landing", str(tmp_path / "tables")
    folder.mkdir()
    (folder / "src_a.csv").write_text("id,name\n1,x\n2,y\n")
    (folder / "src_b.v2.csv").write_text("code\n007\n")
    assert ingest.ingest_folder(spark, str(folder), target) == ["src_a", "src_b.v2"]
    assert spark.read.parquet(f"{target}/src_b.v2").first()["code"] == "007"
    (folder / "src_a.csv").write_text("id\n9\n")
    ingest.ingest_folder(spark, str(folder), target)
    again = spark.read.parquet(f"{target}/src_a")
    assert again.columns == ["id"] and [r.id for r in again.collect()] == ["9"]


def test_ingest_groups_by_header_and_refuses_duplicates(spark, tmp_path):
    folder, target = tmp_path / "landing", str(tmp_path / "tables")
    folder.mkdir()
    for n in range(12):
        (folder / f"t {n}.csv").write_text("id,name\n" + "".join(f"{n}{i},x\n" for i in range(n)))
    (folder / "none.csv").write_text("")
    assert len(ingest.by_header(spark, [str(p) for p in folder.glob("t*.csv")])) == 1
    assert ingest.ingest_folder(spark, str(folder), target) == sorted(f"t {n}" for n in range(12))
    assert [spark.read.parquet(f"{target}/t {n}").count() for n in range(12)] == list(range(12))
    (folder / "t 3.txt").write_text("id\n1\n")
    with pytest.raises(ingest.DuplicateTable, match="t 3"):
        ingest.ingest_folder(spark, str(folder), target, "*")


def test_refresh_that_fails_keeps_the_old_table(spark, tmp_path):
    layout = Layout(str(tmp_path))
    layout.save("gold", "x", spark.range(3))
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        layout.save("gold", "x", spark.range(3).selectExpr("raise_error('no') AS id"))
    assert layout.read(spark, "gold", "x").count() == 3


def test_layout(spark, tmp_path):
    layout = Layout(str(tmp_path), "prod", {"dev": "lake_dev", "prod": "lake_prod"})
    assert layout.path("gold", "x").endswith("/lake_prod/gold/x")
    assert Layout("/r", "other").path("bronze", "t") == "/r/dev/bronze/t"
    assert layout.save("gold", "x", spark.range(3)).count() == 3
    layout.save("gold", "x", spark.range(2))
    assert layout.read(spark, "gold", "x").count() == 2
    with pytest.raises(ValueError):
        layout.path("iron", "x")


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 1),), (date(2025, 1, 2),)], "day date")
    for _ in range(2):
        bronze.append_run_log(bronze.run_log_rows({"t": (df, "day")}, F.lit("2025-01-03").cast("timestamp_ntz")), path)
    assert sorted((r.date_cible.day, r.nb_versions) for r in bronze.read_run_log(spark, path).collect()) == [(1, 2), (1, 2), (2, 1), (2, 1)]


def test_summary_and_dry_run(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in bronze.write_summary({"t": (df, "k")}).collect()] == [("t", 3, 2)]
    assert [tuple(r) for r in bronze.batch_counts({"t": df}).collect()] == [("t", 3)]


def test_streaming_landing_loads_each_file_once(spark, tmp_path):
    folder, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    folder.mkdir()
    (folder / "a.csv").write_text("id,name\n1,x\n")
    append_available(spark, str(folder), ["id", "name"], target, checkpoint)
    (folder / "b.csv").write_text("id,name\n2,y\n")
    append_available(spark, str(folder), ["id", "name"], target, checkpoint)
    append_available(spark, str(folder), ["id", "name"], target, checkpoint)
    assert sorted((r.id, r.source_file) for r in spark.read.parquet(target).collect()) == [("1", "a.csv"), ("2", "b.csv")]


STATE = "id string, at int, seq int, v string, gone boolean"


def versions(n, seed):
    rng = random.Random(seed)
    return [
        (None if rng.random() < 0.02 else "hot" if rng.random() < 0.3 else f"k{rng.randrange(60)}", rng.choice([None, *range(20)]), i % 40, rng.choice("abc"), rng.choice([None, False, False, True]))
        for i in range(n)
    ]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 1, 2, 2)])
def test_batches_in_any_order_equal_a_rebuild(spark, tmp_path, order):
    rows = versions(1500, 1)
    df = spark.createDataFrame(rows, STATE)
    state = LatestState(spark, str(tmp_path / "s"), df.schema, ["id"], ["at"], buckets=8, deleted="gone")
    assert state.current().collect() == [] and state.merge(df.where("false")) == []
    for part in order:
        state.merge(spark.createDataFrame(rows[part::3], STATE).repartition(3))
    rebuilt = op.latest_version(df, ["id"], ["at"], deleted="gone", deleted_policy="after")
    assert sorted(map(tuple, state.current().collect()), key=repr) == sorted(map(tuple, rebuilt.collect()), key=repr)
    # Tombstones stay in the state, one row per key.
    assert state.versions().count() == df.where("id is not null").select("id").distinct().count() > state.current().count()


def test_a_late_version_does_not_bring_a_deleted_key_back(spark, tmp_path):
    state = LatestState(spark, str(tmp_path / "s"), spark.createDataFrame([], STATE).schema, ["id"], ["at"], buckets=4, deleted="gone")
    state.merge(spark.createDataFrame([("a", 5, 1, "x", True), ("b", 5, 1, "x", False)], STATE))
    state.merge(spark.createDataFrame([("a", 3, 1, "x", False), ("b", 3, 1, "old", False)], STATE))
    assert [tuple(r) for r in state.current().collect()] == [("b", 5, 1, "x", False)]


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    rows = versions(800, 2)
    state = LatestState(spark, str(tmp_path / "s"), spark.createDataFrame([], STATE).schema, ["id"], ["at"], buckets=8)
    state.merge(spark.createDataFrame(rows, STATE))
    folders = {int(p.name.split("=")[1]): p for p in Path(state._root).glob(f"{BUCKET}=*")}
    assert len(folders) == 8
    batch = spark.createDataFrame([("k7", 99, 1, "new", False)], STATE)
    own = batch.select(state.bucket_of([F.col("id")])).first()[0]
    # A file that no reader could open: the merge succeeds only if it stays closed.
    before = {}
    for number, folder in folders.items():
        if number != own:
            for file in folder.glob("*.parquet"):
                before[file] = file.read_bytes()
                file.write_bytes(b"not a table")
    assert state.merge(batch) == [own]
    for file, content in before.items():
        assert file.read_bytes() == b"not a table"
        file.write_bytes(content)
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    newest = {r.id: r.v for r in state.current().collect()}
    assert newest["k7"] == "new" and len(newest) == len({r[0] for r in rows if r[0]})


def test_another_number_of_buckets_is_an_error(spark, tmp_path):
    df = spark.createDataFrame(versions(10, 3), STATE)
    LatestState(spark, str(tmp_path / "s"), df.schema, ["id"], ["at"], buckets=4).merge(df)
    with pytest.raises(BucketMismatch):
        LatestState(spark, str(tmp_path / "s"), df.schema, ["id"], ["at"], buckets=8).merge(df)


def test_sorted_table_and_its_proof(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 2]), n, "x") for n in range(5000)]
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(7)
    path = str(tmp_path / "t")
    ordered.write_sorted(df, [F.col("a"), F.col("b")], path, files=6)
    found = ordered.boundaries(spark, path, ["a", "b"]).collect()
    assert len(found) > 3 and sum(r.n_rows for r in found) == 5000 and all(r.follows and r.n_out_of_order == 0 for r in found)
    assert max(r.n_rows for r in found) < 2500  # equal leading values are cut as well
    places = {r[ordered.POSITION]: (r.a, r.b) for r in ordered.positions(spark, path).collect()}
    expected = sorted(((a, b) for a, b, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [places[n + 1] for n in range(5000)] == expected


def test_proof_finds_what_is_out_of_order(spark, tmp_path):
    inside, between = str(tmp_path / "i"), str(tmp_path / "b")
    spark.createDataFrame([(1,), (3,), (2,)], "a int").coalesce(1).write.parquet(inside)
    assert [r.n_out_of_order for r in ordered.boundaries(spark, inside, ["a"]).collect()] == [1]
    spark.createDataFrame([(5,), (6,), (1,), (2,)], "a int").repartitionByRange(2, F.desc("a")).sortWithinPartitions("a").write.parquet(between)
    rows = ordered.boundaries(spark, between, ["a"]).orderBy("file").collect()
    assert [(r.n_out_of_order, r.follows) for r in rows] == [(0, True), (0, False)]


def test_switch_keeps_the_old_table_if_the_new_one_is_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(Exception):  # noqa: B017
        session.switch(spark, str(tmp_path / "absent"), path)
    assert spark.read.parquet(path).count() == 3
    spark.range(2).write.parquet(str(tmp_path / "new"))
    session.switch(spark, str(tmp_path / "new"), path)
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]
