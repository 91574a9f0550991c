"""Streams and sinks: any order of arrival, several batches, failed writes."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import recording
from ledgerloom.streaming import chains, runs

READING = "series string, quarter string, year int, value double, available timestamp"


def readings(spark, rows):
    return spark.createDataFrame(rows, "series string, quarter string, year int, value double, day int").select("series", "quarter", "year", "value", F.timestamp_seconds(F.col("day").cast("long") * 86400).alias("available"))


def streamed(spark, rows, cuts, wait="30 days"):
    """All revisions of a stream over rows, in batches cut by day."""
    known = readings(spark, [*rows, ("-", "-", 0, 0.0, 30_000)])
    at = runs.folder(spark, "r")
    runs.in_batches(known, F.col("available"), [F.timestamp_seconds(F.lit(c * 86400).cast("long")) for c in [*cuts, 29_000]], at)
    with chains.with_provider(spark):
        stream = runs.source(spark, at, known.schema).withWatermark("available", "1 day")
        out = runs.to_end(chains.chained(stream, ["series"], "quarter", "year", "value", "available", wait), runs.folder(spark, "v"), runs.folder(spark, "s"))
    return out.where("series <> '-'")


def test_chains_in_any_order_equal_one_ordered_run(spark):
    rnd = random.Random(4)
    rows = [(s, q, y, float(rnd.randrange(3)), rnd.randrange(1000)) for s in "ab" for q in ("Q1", "Q2") for y in range(2010, 2018) if rnd.random() < 0.8]
    rows += [(*r[:3], r[3] + 1, r[4] + rnd.randrange(300)) for r in rows[::4]] + rows[:2]  # restated years, and rows sent twice
    keys = ["series", "quarter", "year", "value", "reference", "verdict"]
    want = sorted(map(tuple, chains.chained_batch(readings(spark, rows), ["series"], "quarter", "year", "value", "available").select(*keys).collect()), key=repr)
    got = sorted(map(tuple, chains.newest(streamed(spark, rows, [200, 400, 650, 900]), ["series"], "quarter").select(*keys).collect()), key=repr)
    assert got == want and {r[5] for r in got} == {"read", "repeats", "no reference"}


def test_a_late_quarter_revises_its_successor_only(spark):
    rows = [("a", "Q1", 2011, 5.0, 10), ("a", "Q1", 2012, 5.0, 20), ("a", "Q1", 2010, 4.0, 200), ("a", "Q1", 2013, 7.0, 210)]
    rows += [("b", "Q1", 2011, 1.0, 150), ("b", "Q1", 2013, 1.0, 160)]  # time goes on between
    out = sorted(tuple(r) for r in streamed(spark, rows, [15, 100, 155, 180]).where("series = 'a'").select("year", "revision", "reference", "verdict").collect())
    assert out == [(2010, 1, None, "no reference"), (2011, 1, None, "no reference"), (2011, 2, 4.0, "read"), (2012, 1, 5.0, "repeats"), (2013, 1, 5.0, "read")]


def test_chains_of_a_bucket_are_one_row_of_state_and_one_timer(spark):
    rows = [(f"s{i}", "Q1", y, float(i % 3), 10 + 100 * (y - 2010) + i % 50) for i in range(1500) for y in (2010, 2011, 2013)]
    known = readings(spark, [*rows, ("-", "-", 0, 0.0, 30_000)])
    at, files = runs.folder(spark, "r"), 3
    runs.in_batches(known, F.col("available"), [F.timestamp_seconds(F.lit(c * 86400).cast("long")) for c in (120, 320, 29_000)], at, files)
    with chains.with_provider(spark):
        stream = runs.source(spark, at, known.schema, files).withWatermark("available", "1 day")
        verdicts = chains.chained(stream, ["series"], "quarter", "year", "value", "available", "30 days", buckets=20)
        query = verdicts.writeStream.format("parquet").option("path", to := runs.folder(spark, "v")).option("checkpointLocation", runs.folder(spark, "s")).trigger(availableNow=True).start()
        query.awaitTermination()
    states = [p.stateOperators[0] for p in query.recentProgress]
    assert max(s.numRowsTotal for s in states) <= 21
    assert max(int(s.customMetrics["numRegisteredTimers"]) for s in states) <= 21
    keys = ["series", "quarter", "year", "value", "reference", "verdict"]
    got = chains.newest(spark.read.schema(verdicts.schema).parquet(to).where("series <> '-'"), ["series"], "quarter").select(*keys)
    want = chains.chained_batch(readings(spark, rows), ["series"], "quarter", "year", "value", "available").select(*keys)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_each_reading_waits_its_own_time(spark):
    rows = [("a", "Q1", 2010, 1.0, 10), ("a", "Q1", 2015, 5.0, 35), ("b", "Q1", 2000, 1.0, 46), ("b", "Q1", 2001, 1.0, 48), ("a", "Q1", 2014, 5.0, 55), ("b", "Q1", 2002, 1.0, 100)]
    out = sorted(tuple(r) for r in streamed(spark, rows, [20, 40, 47, 50, 60]).where("series = 'a'").select("year", "revision", "reference", "verdict").collect())
    assert out == [(2010, 1, None, "no reference"), (2014, 1, None, "no reference"), (2015, 1, 5.0, "repeats")]


def test_stretches_are_batches_of_the_same_number_of_files(spark):
    rows = spark.range(1000).select("id", F.timestamp_seconds("id").alias("t")).where("id not between 300 and 599")
    at = runs.folder(spark, "r")
    runs.in_batches(rows, F.col("t"), [F.timestamp_seconds(F.lit(c)) for c in (300, 600)], at, 4)
    found = []
    query = runs.source(spark, at, rows.schema, 4).writeStream.foreachBatch(lambda b, i: found.append(sorted(r.id for r in b.collect()))).option("checkpointLocation", runs.folder(spark, "s")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert found == [list(range(300)), [], list(range(600, 1000))]


def test_keys_of_chains_come_back_as_they_were(spark):
    rows = [(2**60 + 1, None, 2010, 1.0, 10), (2**60 + 2, "Q\"1\n", 2010, 2.0, 11), (None, "Q1", 2010, 3.0, 12), (None, None, 2010, 4.0, 13)]
    known = spark.createDataFrame([*rows, (-1, "-", 0, 0.0, 30_000)], "series long, quarter string, year int, value double, day int")
    known = known.select("series", "quarter", "year", "value", F.timestamp_seconds(F.col("day").cast("long") * 86400).alias("available"))
    at = runs.folder(spark, "r")
    runs.in_batches(known, F.col("available"), [F.lit("2050-01-01").cast("timestamp")], at)
    with chains.with_provider(spark):
        stream = runs.source(spark, at, known.schema).withWatermark("available", "1 day")
        out = runs.to_end(chains.chained(stream, ["series"], "quarter", "year", "value", "available", "30 days"), runs.folder(spark, "v"), runs.folder(spark, "s"))
    got = sorted(tuple(r) for r in out.where("year > 0").select("value", "series", "quarter").collect())
    assert got == [(r[3], r[0], r[1]) for r in rows]


def test_streams_start_with_partitions_of_state_for_their_cores(spark):
    name, provider = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
    had = spark.conf.get(name), spark.conf.get(provider)
    try:
        for session, within in (("200", "16"), ("4", "4")):
            spark.conf.set(name, session)
            with chains.with_provider(spark, for_each_core=2):
                assert (spark.conf.get(name), spark.conf.get(provider)) == (within, chains.ROCKSDB)
            assert (spark.conf.get(name), spark.conf.get(provider)) == (session, had[1])
    finally:
        spark.conf.set(name, had[0])


LINES = "filing long, group_key string, line string, value double, status string"


def lines(spark, rows):
    return spark.createDataFrame(rows, LINES)


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    at, keys = str(tmp_path / "t"), ["filing", "group_key", "line"]
    old = [(i, "g", x, float(i), "verified") for i in range(50) for x in "ab"]
    recording.create(lines(spark, old), at, "filing", 8)
    fails = F.when(F.col("filing") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
    again = lines(spark, [(i, "g", "a", 100.0, "verified") for i in range(20)]).withColumn("value", fails.cast("double"))
    finished = spark.range(20).select(F.col("id").alias("filing"))
    nothing = spark.createDataFrame([], "filing long, group_key string")
    with pytest.raises(Exception, match="lost"):
        recording.record(at, again, finished, keys, "filing", nothing, 8)
    assert sorted(map(tuple, recording.read(spark, at).collect())) == sorted(old)
    recording.record(at, lines(spark, [(3, "g", "a", 9.0, "verified")]), finished.where("filing in (3, 4)"), keys, "filing", nothing, 8)
    want = [(i, g, x, 9.0 if (i, x) == (3, "a") else v, "rejected" if (i, x) in ((3, "b"), (4, "a"), (4, "b")) else s) for i, g, x, v, s in old]
    assert sorted(map(tuple, recording.read(spark, at).collect())) == sorted(want)


def test_recording_writes_only_the_partitions_of_its_filings(spark, tmp_path):
    at = tmp_path / "t"
    recording.create(lines(spark, [(i, "g", "a", 1.0, "verified") for i in range(100)]), str(at), "filing", 10)
    before = {p.parent.name: p.name for p in at.glob("bucket=*/*.parquet")}
    recording.record(str(at), lines(spark, [(3, "g", "a", 2.0, "verified")]), spark.createDataFrame([(3,)], "filing long"), ["filing", "group_key", "line"], "filing", spark.createDataFrame([], "filing long, group_key string"), 10)
    after = {p.parent.name: p.name for p in at.glob("bucket=*/*.parquet")}
    assert sum(before[b] != after[b] for b in before) == 1 and set(before) == set(after)


def test_held_writes_are_dropped_or_written_once(spark, tmp_path):
    at = str(tmp_path / "t")
    recording.create(lines(spark, [(i, "g", "a", 1.0, "verified") for i in range(10)]).withColumn("version", F.lit(1)), at, "filing", 4)
    held = recording.Held(spark, at, ["filing", "group_key", "line"], ["value", "status"], "filing", 4)
    held.write(held.now().where("filing < 5").withColumn("status", F.lit("needs_review")))
    assert held.now().where("status = 'needs_review'").count() == 5 and held.stored().where("status = 'needs_review'").count() == 0
    held.discard()
    held.release("version", 2)
    assert held.stored().where("version = 2").count() == 0
    held.write(held.now().where("filing < 5").withColumn("status", F.lit("needs_review")))
    held.write(held.now().where("filing < 3").withColumn("status", F.lit("verified")))
    held.release("version", 2)
    assert sorted((r.filing, r.status) for r in held.stored().where("version = 2").collect()) == [(3, "needs_review"), (4, "needs_review")]
    assert held.stored().count() == 10
