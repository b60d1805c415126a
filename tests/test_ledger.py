import random

import pytest
from pyspark.sql import functions as F

from lakeloom.session import delete_path, materialise
from lakeloom.sources import ledger as L
from lakeloom.sources import readers as R
from lakeloom.sources import writers as W
from lakeloom.streaming import ingest as I


def frame(spark, ids, kind=None):
    return spark.createDataFrame([(i, kind) for i in ids], "id string, media_type string")


def test_small_batches_against_a_set(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "FAN", 3)
    monkeypatch.setattr(L, "UNFILTERED", 25)
    rng = random.Random(4)
    book, known = L.KeyLedger(spark, str(tmp_path / "l"), ["id"]), set()
    for n in range(11):
        ids = [str(rng.randrange(60)) for _ in range(12)]
        left = {r.id for r in book.exclude(frame(spark, [*ids, None])).collect()}
        assert left == (set(ids) - known) | {None}
        book.append(frame(spark, ids), f"t{n}", n + 1)
        known |= set(ids)
    assert {r.id for r in book.all().collect()} == known
    runs = book.state().runs
    # Merged by threes, the newest apart: runs stay few, and files of retired ones are gone.
    assert len(runs) <= 6 and max(r.level for r in runs) == 2 and book.state().noted == [[1, 11]]
    assert len(list((tmp_path / "l" / "runs").iterdir())) <= 3 * len(runs)


def test_the_same_token_replaces_its_run(spark, tmp_path):
    book = L.KeyLedger(spark, str(tmp_path / "l"), ["id"])
    book.append(frame(spark, ["1", "2"]), "a")
    book.append(frame(spark, ["3"]), "b")
    book.append(frame(spark, ["4"]), "b")
    assert {r.id for r in book.all().collect()} == {"1", "2", "4"}
    assert {r.id for r in book.all(without="b").collect()} == {"1", "2"}
    assert {r.id for r in book.exclude(frame(spark, ["1", "4"]), without="b").collect()} == {"4"}


def test_only_buckets_that_may_hold_a_key_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "BUCKET_KEYS", 500)
    monkeypatch.setattr(L, "UNFILTERED", 0)
    book = L.KeyLedger(spark, str(tmp_path / "l"), ["id"])
    book.append(spark.range(8000).select(F.col("id").cast("string").alias("id")), "big")
    run = book.state().runs[0]
    assert run.bits == 5 and run.rows == 8000
    none = book.hashed(frame(spark, [f"new{i}" for i in range(100)])).select("h", "id")
    two = book.hashed(frame(spark, ["17", "4711"])).select("h", "id")
    assert sum(len(b) for _, b in book.open_buckets(none, [run])) <= 4
    assert 1 <= sum(len(b) for _, b in book.open_buckets(two, [run])) <= 2
    plan = book._keys(run, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert {r.id for r in book.known(frame(spark, ["17", "4711", "x", "8000"])).collect()} == {"17", "4711"}


def test_numbers_and_kinds(spark, tmp_path):
    book = L.KeyLedger(spark, str(tmp_path / "l"), ["id"], ["media_type"], numbers=True)
    book.append(frame(spark, ["1", "2"], "movie"), "a")
    book.append(frame(spark, ["9"]), "b")
    asked = spark.createDataFrame([("01", "movie"), ("1", "tv"), ("2", "tv"), ("9", "tv"), ("3", "tv"), ("x", "tv")], "id string, media_type string")
    assert {r.id for r in book.exclude(asked).collect()} == {"3", "x"}
    assert {(r.id, r.media_type) for r in book.exclude(asked, ["media_type", "id"]).collect()} == {("1", "tv"), ("2", "tv"), ("3", "tv"), ("x", "tv")}


def test_text_written_without_keys_is_noted_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    for i in "123":
        W.append_batch(df(i), path)
    book = W.key_ledger(spark, path, ["id"], "id")
    assert {r.id for r in book.exclude(df("2", "4")).collect()} == {"4"} and len(book.state().runs) == 2
    W.append_batch(df("5"), path, "five", key="id")
    assert len(W.key_ledger(spark, path, ["id"], "id").state().runs) == 3
    assert {r.id for r in W.known_keys(spark, path, ["id"], "id").collect()} == set("1235")


@pytest.mark.parametrize("replayed", [None, 1, 2])
def test_late_rows_are_settled(spark, tmp_path, replayed):
    path = str(tmp_path / "s")
    rows = lambda *r: spark.createDataFrame(r, "id string, ts string")
    batches = [rows(("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 12:00:00"), ("a", "2024-01-01 10:30:00")),
               rows(("c", "2024-01-01 09:00:00"), ("a", "2024-01-01 09:30:00"), ("d", "2024-01-01 12:30:00"), ("e", None)),
               rows(("c", "2024-01-01 08:00:00"), ("f", "2024-01-01 08:00:00"), ("b", "2024-01-01 12:40:00"))]
    for n, batch in enumerate(batches):
        for _ in range(2 if n == replayed else 1):
            I.append_settled(batch, path, "id", "ts", "1 HOUR", f"t{n}")
    assert sorted(r.id for r in R.read_text_table(spark, path, ["id", "ts"]).collect()) == list("abcdef")
    counts = I.late_counts(spark, path)
    # a and c in the second batch, c and f in the third; c and f were new.
    assert (counts.late, counts.settled) == (4, 2) and counts.high.startswith("2024-01-01 12:40")
    assert R.read_text_table(spark, f"{path}_late", ["id", "ts"]).count() == 4


def test_late_rows_of_a_stream(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for n, lines in enumerate([["a,2024-01-01 10:00:00", "b,2024-01-03 00:00:00"], ["c,2024-01-01 11:00:00", "a,2024-01-01 10:00:00"]]):
        (landing / f"{n}.csv").write_text("\n".join(lines) + "\n")
        stream = spark.readStream.schema("id string, ts string").csv(str(landing))
        I.settle_stream(stream, str(tmp_path / "out"), "id", "ts", "1 DAY", str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.id for r in R.read_text_table(spark, str(tmp_path / "out"), ["id", "ts"]).collect()) == ["a", "b", "c"]
    assert I.late_counts(spark, str(tmp_path / "out")).late == 2


def test_a_large_batch_asks_no_filter(spark, tmp_path, monkeypatch):
    """Of many keys for a bucket some are left open by mistake, so its filter would only be sent around for nothing."""
    monkeypatch.setattr(L, "UNFILTERED", 10)
    monkeypatch.setattr(L, "ASKED_PER_BUCKET", 50, raising=False)
    ledger = L.KeyLedger(spark, f"{tmp_path}/keys", ["k"])
    ledger.append(spark.range(500).select(F.col("id").cast("string").alias("k")))
    run, = ledger.state().runs
    assert run.filter_bits
    few = spark.range(490, 530).select(F.col("id").cast("string").alias("k"))
    assert sorted(r.k for r in ledger.exclude(few).collect()) == [str(i) for i in range(500, 530)]
    delete_path(spark, f"{tmp_path}/keys/runs/{run.name}/filters")
    many = spark.range(300, 700).select(F.col("id").cast("string").alias("k"))
    assert sorted(r.k for r in ledger.exclude(many).collect()) == [str(i) for i in range(500, 700)]


def test_a_large_settled_batch_looks_up_no_entries(spark, tmp_path, monkeypatch):
    """Its rows are dealt by key already, so whole runs are compared with them; the keys are not stored and joined before."""
    monkeypatch.setattr(L, "UNFILTERED", 10)
    monkeypatch.setattr(L, "ASKED_PER_BUCKET", 50)
    stored = []
    monkeypatch.setattr(L, "materialise", lambda df, purpose: stored.append(purpose) or materialise(df, purpose))
    path = str(tmp_path / "s")
    rows = lambda a, b, more="": spark.range(a, b).selectExpr("cast(id as string) as id", f"'2024-01-0{1 + (a > 0)} 10:00:00{more}' as ts")
    I.append_settled(rows(0, 500), path, "id", "ts", "1 HOUR", "t0")
    I.append_settled(rows(300, 700).union(rows(300, 700, ".5")), path, "id", "ts", "1 HOUR", "t1")
    assert "asked-keys" not in stored
    # A few keys are still looked up through the filters.
    few = rows(690, 710).unionByName(spark.createDataFrame([(None, "2024-01-03 10:00:00")], "id string, ts string"))
    I.append_settled(few, path, "id", "ts", "1 HOUR", "t2")
    I.append_settled(few, path, "id", "ts", "1 HOUR", "t2")
    assert stored.count("asked-keys") == 2
    back = R.read_text_table(spark, path, ["id", "ts"], keep_order=True)
    found = sorted((r.run, r.id or "") for r in back.selectExpr("id", "int(regexp_extract(_order.folder, 'batch-0*([0-9]+)-', 1)) as run").collect())
    assert found == sorted([*((1, str(i)) for i in range(500)), *((2, str(i)) for i in range(500, 700)),
                            *((3, str(i)) for i in range(700, 710)), (3, "")])


def test_crowded_and_filtered_runs_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "UNFILTERED", 50)
    book = L.KeyLedger(spark, str(tmp_path / "l"), ["id"], ["media_type"], numbers=True)
    book.append(frame(spark, [str(i) for i in range(300)], "movie"), "a")
    book.append(frame(spark, ["400", "401"]), "b")
    assert [bool(r.filter_bits) for r in book.state().runs] == [True, False]
    asked = spark.createDataFrame([("07", "movie"), ("7", "tv"), ("400", "tv"), ("x", "tv"), (None, "tv")], "id string, media_type string")
    for given in (None, asked):
        assert sorted((r.id or "", r.media_type) for r in book.exclude(asked, asked=given).collect()) == [("", "tv"), ("x", "tv")]
        left = book.exclude(asked, ["media_type", "id"], asked=given).collect()
        assert sorted((r.id or "", r.media_type) for r in left) == [("", "tv"), ("7", "tv"), ("x", "tv")]
        assert sorted(r.id for r in book.exclude(asked.dropna(), without="b", asked=given).collect()) == ["400", "x"]
