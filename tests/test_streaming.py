from pyspark.sql import functions as F

from ledgerforge.streaming.buckets import BucketedLedger
from ledgerforge.streaming.state import streaks
from ledgerforge.streaming.windows import sessions, tumbling


def test_windows_agree_with_batches(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for name, make, mode in (("tumbling", lambda df: tumbling(df).select("start", "event_type", "n"), "complete"), ("sessions", lambda df: sessions(df, "6 hours"), "complete")):
        q = make(stream).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, make(events).collect()))


COLUMNS = "key string, name string, first_seen string, last_seen string, miss_streak int"


def size(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_ledgers_grow_by_their_batches(spark, tmp_path):
    """A batch costs what it has, whatever the ledger holds, and any order of batches gives the same rows."""
    rows = lambda ids, day, name: spark.createDataFrame([(f"k{i}", name, day, day, 0) for i in ids], COLUMNS)
    batches = [rows(range(3000), "3", "c"), rows([5, 7], "1", "a"), rows([5], "9", "i"), rows([7, 9, 3001], "3", "z"), rows([], "1", "none")]
    want = None
    for name, order in (("one", (0, 1, 2, 3, 4)), ("two", (3, 4, 2, 0, 1)), ("three", (2, 0, 1, 0, 4, 3, 2))):
        ledger = BucketedLedger(spark, f"file://{tmp_path}/{name}", COLUMNS, buckets=8)
        for n, k in enumerate(order):
            ledger.apply(batches[k], k)
            if n == 2:
                ledger.compact()
        got = {r.key: tuple(r)[1:] for r in ledger.read().collect()}
        want = want or got
        assert got == want and got["k5"] == ("i", "1", "9", 0) and got["k7"] == ("z", "1", "3", 0) and got["k3001"] == ("z", "3", "3", 0) and len(got) == 3001
        ledger.compact()
        assert {r.key: tuple(r)[1:] for r in ledger.read().collect()} == want
        before, count = size(tmp_path / name), len(list((tmp_path / name).rglob("*.parquet")))
        ledger.apply(rows([5], "99", "new"), 50)
        assert size(tmp_path / name) - before < 0.1 * before and len(list((tmp_path / name).rglob("*.parquet"))) == count + 1
        found = ledger.lookup(spark.createDataFrame([("k5",), ("k6",), ("gone",)], "key string"))
        assert sorted(tuple(r) for r in found.collect()) == [("k5", "new", "1", "99", 0), ("k6", "c", "3", "3", 0)]
        assert len({f.rpartition("/b=")[2].split("/")[0] for f in found.inputFiles()}) <= 2
        ledger.compact()
        ledger.apply(rows([5], "0", "again"), 50)  # folded already
        assert ledger.lookup(spark.createDataFrame([("k5",)], "key string")).first().first_seen == "1"


def test_a_stream_feeds_a_ledger(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([("a", f"n{k}", str(k), str(k), 0), (f"b{k}", "x", str(k), str(k), 0)], COLUMNS).coalesce(1).write.parquet(str(tmp_path / "in" / f"s{k}"))
    ledger = BucketedLedger(spark, f"file://{tmp_path}/ledger", COLUMNS, buckets=4)
    stream = spark.readStream.schema(COLUMNS).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(ledger.apply).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(map(tuple, ledger.read().collect())) == [("a", "n2", "0", "2", 0), ("b0", "x", "0", "0", 0), ("b1", "x", "1", "1", 0), ("b2", "x", "2", "2", 0)]


def test_streaks_on_a_stream(spark, tmp_path):
    rows = [("a", 1, True), ("a", 2, False), ("a", 3, False), ("b", 1, False), ("b", 2, True), ("b", 3, False)]
    for k in (1, 2, 3):
        spark.createDataFrame([r for r in rows if r[1] == k], "key string, sweep long, seen boolean").coalesce(1).write.parquet(str(tmp_path / "in" / f"s{k}"))
    got = {}

    def keep(batch, _):
        got.update({r.key: r.streak for r in batch.collect()})

    stream = spark.readStream.schema("key string, sweep long, seen boolean").option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    streaks(stream).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(120)
    assert got == {"a": 2, "b": 1}
