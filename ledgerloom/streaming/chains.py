"""Chains of readings as keyed state: each quarter is read against the same quarter a year earlier, oldest to newest, whatever order they arrive in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: The only provider that keeps timers and state of several columns.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A stream's chains are dealt to so many keys of state; a batch reads and writes the state of a key once.
BUCKETS = 256
_OUT = "chain string, year int, value double, reference double, verdict string, revision int"
#: What is kept of a year of a chain: its value, its last revision (0: not judged yet) and until when (ms) it waits, if it does (0: not).
_KEPT = pa.schema([("chain", pa.dictionary(pa.int32(), pa.string())), ("year", pa.int32()), ("value", pa.float64()), ("revision", pa.int32()), ("due", pa.int64())])
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "mode": "FAILFAST"}


def _same(a: float, b: float) -> bool:
    return a == b or (a != a and b != b)


def _verdict(value: float, reference: float | None) -> str:
    return "no reference" if reference is None or reference != reference else "repeats" if value == reference else "read"


def _packed(chains: dict[str, dict[int, list]]) -> bytes:
    names = pa.array([i for i, years in enumerate(chains.values()) for _ in years], pa.int32())
    rows = [(year, *reading) for years in chains.values() for year, reading in years.items()]
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_KEPT)[1:])]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _KEPT) as to:
        to.write_batch(pa.record_batch([pa.DictionaryArray.from_arrays(names, pa.array(list(chains), pa.string())), *columns], schema=_KEPT))
    return sink.getvalue().to_pybytes()


def _unpacked(state: bytes) -> dict[str, dict[int, list]]:
    kept = pa.ipc.open_stream(pa.py_buffer(bytes(state))).read_next_batch()
    named, *columns = kept.columns
    years: list[dict[int, list]] = [{} for _ in named.dictionary]
    for i, year, *reading in zip(named.indices.to_numpy().tolist(), *(c.to_numpy().tolist() for c in columns)):
        years[i][year] = reading
    return dict(zip(named.dictionary.to_pylist(), years))


class Chains(StatefulProcessor):
    """The chains of one bucket; a chain is one quarter of the year of one series. State: the years read so far with their values, revisions and waits.

    A reading whose year-ago reading is there is judged at once. One whose reference is missing waits for it until its time
    is over, which a timer says; then it is judged without. A late reading judges itself and revises its successor, so the
    newest revision of each year is what one run over all readings in order would say. A second reading of a year replaces the first.

    All chains of a bucket come and go as one value of state, with one timer for the next that is over: calls for state and
    timers are a few for each bucket and batch, however many chains and years there are.
    """

    def __init__(self, wait_ms: int) -> None:
        self.wait_ms = wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.read = handle.getValueState("read", "chains binary, alarm bigint")

    def _held(self) -> tuple[dict[str, dict[int, list]], int | None]:
        state = self.read.get()
        return ({}, None) if state is None else (_unpacked(state[0]), state[1])

    def _hold(self, chains: dict[str, dict[int, list]], alarm: int | None) -> None:
        due = min((r[2] for years in chains.values() for r in years.values() if r[2]), default=None)
        if due is not None and (alarm is None or due < alarm):
            self.handle.registerTimer(due)
            alarm = due
        self.read.update((_packed(chains), alarm))

    @staticmethod
    def _judged(chain: str, years: dict[int, list], year: int) -> tuple:
        reading, before = years[year], years.get(year - 1)
        reading[1:] = reading[1] + 1, 0
        reference = None if before is None else before[0]
        return chain, year, reading[0], reference, _verdict(reading[0], reference), reading[1]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values(["at", "year", "value"])
        (chains, alarm), now = self._held(), timerValues.getCurrentWatermarkInMs()
        touched: dict[str, set[int]] = {}
        last: dict[str, int] = {}
        for chain, year, value, at in zip(*(arrived[c].tolist() for c in ("chain", "year", "value", "at"))):
            last[chain] = at // 1000
            years = chains.setdefault(chain, {})
            had = years.get(year)
            if had is not None and _same(had[0], value):
                continue
            if had is None:
                years[year] = [value, 0, 0]
            else:
                had[0] = value
            touched.setdefault(chain, set()).update((year, year + 1))
        if not touched:
            return
        out = []
        for chain, changed in touched.items():
            years = chains[chain]
            for year in sorted(changed & years.keys()):
                if year - 1 in years or years[year][1]:
                    out.append(self._judged(chain, years, year))
                elif not years[year][2]:
                    years[year][2] = max(last[chain] + self.wait_ms, now + 1)
        self._hold(chains, alarm)
        if out:
            yield self.frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (chains, alarm), expired = self._held(), expiredTimerInfo.getExpiryTimeInMs()
        over = max(expired, timerValues.getCurrentWatermarkInMs())
        out = [self._judged(c, years, y) for c, years in chains.items() for y in sorted(y for y, r in years.items() if 0 < r[2] <= over)]
        self._hold(chains, None if alarm is not None and alarm <= expired else alarm)
        if out:
            yield self.frame(out)

    @staticmethod
    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[x.split()[0] for x in _OUT.split(", ")])

    def close(self) -> None:
        pass


def chained(readings: DataFrame, series: list[str], quarter: str, year: str, value: str, available: str, wait: str = "400 days", buckets: int = BUCKETS) -> DataFrame:
    """(series, quarter, year, value, reference, verdict, revision) of a stream of readings with a watermark on `available`.

    verdict: `read`, `repeats` (the figure of a year earlier again: what a column of the prior period gives) or `no reference`.
    Order is by `available`, when a reading became known; a late quarter is one known after its successor, and is never
    dropped for it. State of a chain: one entry for each year; chains are kept in `buckets` by a hash of their keys, which
    is fixed for a checkpoint. A task holds one bucket at a time. The session needs the RocksDB provider (`ROCKSDB`).
    """
    wait_ms = int(pd.Timedelta(wait).total_seconds() * 1000)
    keys = [*series, quarter]
    chain = F.to_json(F.struct(*keys), _JSON)
    rows = readings.select(chain.alias("chain"), F.col(year).cast("int").alias("year"), F.col(value).cast("double").alias("value"), F.unix_micros(available).alias("at"), F.col(available).alias("available"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("chain"), F.lit(buckets)).cast("int"))
    out = rows.groupBy("bucket").transformWithStateInPandas(Chains(wait_ms), _OUT, "Append", "EventTime")
    named = F.from_json("chain", readings.select(*keys).schema, _JSON)
    return out.withColumn("chain", named).select("chain.*", "year", "value", "reference", "verdict", "revision")


def newest(verdicts: DataFrame, series: list[str], quarter: str) -> DataFrame:
    """The last revision of each year of each chain."""
    keys = [*series, quarter, "year"]
    rest = [c for c in verdicts.columns if c not in (*keys, "revision")]
    return verdicts.groupBy(*keys).agg(F.max_by(F.struct(*rest), "revision").alias("_r"), F.max("revision").alias("revision")).select(*keys, "_r.*", "revision")


def chained_batch(readings: DataFrame, series: list[str], quarter: str, year: str, value: str, available: str) -> DataFrame:
    """What chained comes to over a whole table: one ordered run."""
    keys = [*series, quarter]
    last = readings.groupBy(*keys, F.col(year).cast("int").alias("year")).agg(F.max_by(F.col(value).cast("double"), F.struct(available, value)).alias("value"))
    w = Window.partitionBy(*keys).orderBy("year")
    reference = F.when(F.lag("year").over(w) == F.col("year") - 1, F.lag("value").over(w))
    verdict: Column = F.when(F.col("reference").isNull(), "no reference").when(F.col("value") == F.col("reference"), "repeats").otherwise("read")
    return last.withColumn("reference", reference).withColumn("verdict", verdict)


def with_provider(spark: SparkSession, for_each_core: int | None = None):
    """Context in which streams start with the RocksDB provider; the session's own settings come back after it.

    Each partition of state costs every batch a commit of some files, however few keys it has: with `for_each_core` a new
    stream has no more partitions than so many for each core (16 at least), if the session's number is above that.
    """
    from contextlib import contextmanager

    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if for_each_core:
        partitions = "spark.sql.shuffle.partitions"
        wanted[partitions] = str(min(int(spark.conf.get(partitions)), max(16, for_each_core * spark.sparkContext.defaultParallelism)))

    @contextmanager
    def held():
        had = {name: spark.conf.get(name, None) for name in wanted}
        for name, value in wanted.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in had.items():
                spark.conf.set(name, value) if value else spark.conf.unset(name)

    return held()
