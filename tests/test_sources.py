import random
from functools import partial

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import FOLDER, raw_rows, rows_of
from txnrisk.schemas import RAW_COLUMNS
from txnrisk.session import side_by_side
from txnrisk.sources import csv_files, jdbc, tables
from txnrisk.sources.events import read_raw
from txnrisk.sources.tables import LayerStore

HEADER = ",".join(RAW_COLUMNS)
LINE = "{id},U1,M1,D1,9.50,2024-01-01T10:00:00+00:00, upi ,MOBILE,10.0.0.1,1.5,2.5,US,US,False"


def write(folder, name, *ids, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *[LINE.format(id=i) for i in ids]]) + "\n")


@pytest.fixture
def daily(tmp_path):
    write(tmp_path / "in", "transactions_2024-01-01.csv", "T1", "T2")
    write(tmp_path / "in" / "deep", "transactions_2024-01-02.csv", "T3")
    (tmp_path / "in" / "notes.txt").write_text("not data")
    return tmp_path


def test_recursive_and_flat_scan(spark, daily):
    found = csv_files.scan_csv(spark, str(daily / "in"))
    assert rows_of(found, "TransactionID", F.col("business_date").cast("string")) == [
        ("T1", "2024-01-01"), ("T2", "2024-01-01"), ("T3", "2024-01-02")]
    assert csv_files.scan_csv(spark, str(daily / "in"), recursive=False).count() == 2


def test_one_business_date(spark, daily):
    assert rows_of(csv_files.scan_business_date(spark, str(daily / "in"), "2024-01-02"), "TransactionID") == [("T3",)]


def test_header_is_validated(spark, tmp_path):
    write(tmp_path, "transactions_2024-01-01.csv", "T1", header=HEADER.replace("UserID", "Customer"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        csv_files.scan_csv(spark, str(tmp_path)).collect()


def test_written_files_read_back(spark, tmp_path):
    raw = read_raw(spark, FOLDER)
    csv_files.write_daily_csv(raw, str(tmp_path / "out"))
    back = csv_files.scan_csv(spark, str(tmp_path / "out"))
    assert back.count() == raw.count()
    assert back.filter(F.to_date(F.col("TransactionDate").cast("timestamp")) != F.col("business_date")).count() == 0
    assert rows_of(back.select("PaymentMethod").distinct()) == rows_of(raw.select("PaymentMethod").distinct())


def load(spark, root, **options):
    return csv_files.load_pending(spark, str(root / "in"), str(root / "landing"), str(root / "ledger"), **options)


def landed(spark, root):
    return rows_of(csv_files.read_landing(spark, str(root / "landing"), str(root / "ledger")), "TransactionID")


def test_each_file_loads_once(spark, daily):
    assert load(spark, daily) == [] and load(spark, daily) == []
    assert landed(spark, daily) == [("T1",), ("T2",), ("T3",)]
    write(daily / "in", "transactions_2024-01-03.csv", "T4")
    load(spark, daily)
    assert landed(spark, daily) == [("T1",), ("T2",), ("T3",), ("T4",)]
    ledger = csv_files.read_ledger(spark, str(daily / "ledger"))
    assert rows_of(ledger, "rows_loaded") == [(1,), (1,), (2,)]
    assert ledger.filter("loaded_at is null or load_id is null").count() == 0


def test_empty_file_is_recorded(spark, daily):
    write(daily / "in", "transactions_2024-01-04.csv")
    load(spark, daily)
    assert rows_of(csv_files.read_ledger(spark, str(daily / "ledger")), "rows_loaded") == [(0,), (1,), (2,)]


def test_bad_file_raises_or_is_skipped(spark, daily):
    write(daily / "in", "transactions_2024-01-05.csv", "T9", header="just,two")
    with pytest.raises((PySparkException, Py4JJavaError)):
        load(spark, daily)
    assert csv_files.read_ledger(spark, str(daily / "ledger")).count() == 0
    failed = load(spark, daily, on_error="skip")
    assert [f.rsplit("/", 1)[1] for f in failed] == ["transactions_2024-01-05.csv"]
    assert landed(spark, daily) == [("T1",), ("T2",), ("T3",)]
    # It stays pending and loads once it is mended.
    write(daily / "in", "transactions_2024-01-05.csv", "T9")
    assert load(spark, daily) == []
    assert ("T9",) in landed(spark, daily)
    with pytest.raises(ValueError):
        load(spark, daily, on_error="ignore")


def test_seeded_files_are_not_loaded(spark, daily):
    seeded = csv_files.seed_ledger(spark, str(daily / "in"), str(daily / "ledger"))
    assert rows_of(seeded, "rows_loaded", "note") == [(None, csv_files.SEED_NOTE)] * 2
    write(daily / "in", "transactions_2024-01-06.csv", "T6")
    load(spark, daily)
    assert landed(spark, daily) == [("T6",)]


def test_load_without_ledger_entry_is_invisible(spark, daily):
    load(spark, daily)
    orphan = csv_files.scan_csv(spark, str(daily / "in"))
    orphan.write.parquet(str(daily / "landing" / "load_id=crashed"))
    assert landed(spark, daily) == [("T1",), ("T2",), ("T3",)]


def test_jdbc_options():
    options = jdbc.pull_options("jdbc:x", "landing", "loaded_at", "2024-01-01", "id", "0", "100", 8)
    assert options["dbtable"] == "(select * from landing where loaded_at > '2024-01-01') pulled"
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert jdbc.pull_options("jdbc:x", "landing", "loaded_at", None, "id", "0", "1", 1)["dbtable"] == "landing"


def test_jdbc_needs_a_driver(spark):
    with pytest.raises(Exception, match="driver|Driver"):
        jdbc.pull(spark, url="jdbc:postgresql://nowhere/db", table="t", ts_column="ts", since=None,
                  partition_column="id", lower="0", upper="1", partitions=1)


def test_catalog_table(spark):
    raw_rows(spark, [dict()]).write.mode("overwrite").saveAsTable("raw_transaction")
    assert tables.scan_table(spark, "spark_catalog.default.raw_transaction").count() == 1


def test_layer_names():
    assert tables.layer_path("/r", "t", " gold ") == "/r/gold/t"
    assert tables.layer_path("/r", "t", None, "analytics") == "/r/analytics/t"


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    store = tables.LayerStore(spark, str(tmp_path))
    assert store.read("gold", "t") is None
    store.publish(spark.range(3), "gold", "t")
    first = store.read("gold", "t")
    store.publish(first.filter("id > 0"), "gold", "t")
    assert rows_of(store.read("gold", "t")) == [(1,), (2,)]
    assert first.count() == 3


def test_a_table_kept_by_key(spark, tmp_path, monkeypatch):
    """Deltas replace, remove and add keys, null among them, and are merged into a new base in time."""
    monkeypatch.setattr(tables, "LEAST_DELTAS", 2)
    rng = random.Random(4)
    store, held = tables.LayerStore(spark, str(tmp_path), buckets=4), {}

    def frame(rows):
        return spark.createDataFrame(rows, "k string, n int, v string")

    def rows_for(keys):
        return [(k, i, f"{k}{i}{rng.random()}") for k in keys for i in range(rng.randrange(3))]

    names = [None, *"abcdefghijklmnopqrst"]
    for step in range(7):
        keys = names if step == 0 else rng.sample(names, rng.choice([2, 7]))
        rows = rows_for(keys)
        held |= {k: [r for r in rows if r[0] == k] for k in keys}
        merged = store.replace(spark.createDataFrame([(k,) for k in keys], "k string"), frame(rows), "state", "t", ["k"])
        expected = sorted((r for rows in held.values() for r in rows), key=repr)
        assert rows_of(merged, "k", "n", "v") == expected
        some = rng.sample(names, 4)
        picked = store.read("state", "t", spark.createDataFrame([(k,) for k in some], "k string"))
        assert rows_of(picked, "k", "n", "v") == sorted((r for k in some for r in held[k]), key=repr)
    entries = store.spark.read.parquet(f"{store.root}/_published").collect()
    assert sum(not e.delta for e in entries) > 1 and sum(e.delta for e in entries) == 6


def test_a_version_is_noted_without_rows_from_python(spark, tmp_path, monkeypatch):
    store = tables.LayerStore(spark, str(tmp_path), buckets=2)
    made = spark.range(3).selectExpr("id AS k")
    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "createDataFrame", lambda *_, **__: pytest.fail("starts Python workers for one row"))
        store.publish(made, "state", "t", keys=["k"])
        store.publish(made, "gold", "u")
    noted = {e.table: e for e in spark.read.parquet(f"{store.root}/_published").collect()}
    assert (noted["state.t"].keys, noted["state.t"].buckets, noted["state.t"].rows, noted["state.t"].delta) == ("k", 2, 3, False)
    assert (noted["gold.u"].keys, noted["gold.u"].buckets, noted["gold.u"].rows, noted["gold.u"].number) == (None, None, None, 1)
    assert all(e.published_at is not None for e in noted.values())


def test_a_delta_that_was_never_published_is_not_read(spark, tmp_path, monkeypatch):
    store = tables.LayerStore(spark, str(tmp_path), buckets=2)
    store.publish(spark.range(100).selectExpr("id AS k", "0 AS v"), "state", "t", keys=["k"])
    one = spark.range(1).selectExpr("id AS k", "1 AS v")
    with monkeypatch.context() as patched:
        patched.setattr(store, "_note", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.replace(one, one, "state", "t", ["k"])
    assert store.read("state", "t").agg({"v": "sum"}).first()[0] == 0
    two = spark.range(1, 2).selectExpr("id AS k", "2 AS v")
    assert rows_of(store.replace(two, two, "state", "t", ["k"]).where("v > 0")) == [(1, 2)]


def test_reading_some_keys_opens_their_buckets_only(spark, tmp_path):
    store = tables.LayerStore(spark, str(tmp_path), buckets=16)
    store.publish(spark.range(1000).selectExpr("id AS k"), "state", "t", keys=["k"])
    two = spark.range(2).selectExpr("id AS k")
    wanted = {r[0] for r in two.selectExpr("pmod(xxhash64(k), 16)").collect()}
    for file in tmp_path.glob("state/t/*/_bucket=*/*.parquet"):
        if int(file.parent.name.split("=")[1]) not in wanted:
            file.write_bytes(b"not to be opened")
    assert rows_of(store.read("state", "t", two)) == [(0,), (1,)]


def test_merged_table_is_read_without_its_deltas(spark, tmp_path):
    store = tables.LayerStore(spark, str(tmp_path), buckets=2)
    assert store.merged("a", "t") is None
    held = store.publish(spark.createDataFrame([(i, 0) for i in range(20)], "k int, v int"), "a", "t", keys=["k"])
    assert rows_of(store.merged("a", "t")) == rows_of(held)
    changed = spark.createDataFrame([(1, 5), (30, 6)], "k int, v int")
    store.replace(spark.createDataFrame([(1,), (2,), (30,)], "k int"), changed, "a", "t", ["k"])
    merged = store.merged("a", "t")
    assert rows_of(merged) == rows_of(store.read("a", "t")) == sorted(
        [(i, 0) for i in range(20) if i not in (1, 2)] + [(1, 5), (30, 6)], key=repr)
    assert not any("-deltas" in file for file in merged.inputFiles())


def test_tables_may_be_replaced_side_by_side(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path / "store"))
    names = ["a", "b", "c", "d"]

    def change(name, number):
        rows = spark.range(number).selectExpr("id", f"'{name}' AS v")
        return store.replace(rows, rows, "state", name, ["id"])

    for number in (5, 7):
        assert [held.count() for held in side_by_side(spark, [partial(change, name, number) for name in names])] == [number] * 4
    fresh = LayerStore(spark, store.root)
    assert [sorted(tuple(r) for r in fresh.read("state", name).collect()) for name in names] == [
        [(i, name) for i in range(7)] for name in names]
    assert [[row.rows for row in fresh._entries("state", name)] for name in names] == [[5, 7]] * 4


def test_a_failed_step_is_raised_when_all_have_ended(spark):
    ended = []
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1 / 0, lambda: ended.append(spark.range(3).count())])
    assert ended == [3]
