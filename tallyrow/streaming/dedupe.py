"""Keyed dedupe and flagging on streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyrow.functions.text import named
from tallyrow.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def dedupe_stream(stream: DataFrame, key: str, event_time: str, delay: str | None) -> DataFrame:
    """First event per key.

    ``delay`` is the late-data rule. With one, keys older than the watermark are forgotten,
    so the state is bounded by the events within ``delay``; an event that comes later than
    that is left out, and ``run_available`` says how many were. With None every key is
    remembered and no event is left out, in whatever order files arrive; the state then
    grows with the keys, so a large finished table is better deduplicated as a batch.
    """
    if delay is None:
        return stream.dropDuplicates([key])
    timed = stream.withColumn(event_time, named(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


# keys are dealt into this many groups, each one state entry: a call of the processor costs the
# same for one key as for thousands, and a billion remembered keys are a million in a group
KEY_GROUPS = 1024


class _FirstInTime(StatefulProcessor):
    """One group of keys: the first event of a key is passed on and the key remembered until event
    time plus delay lies behind the watermark; later ones are dropped meanwhile. An event behind
    the watermark is passed on as late. One timer, at the earliest end of a key, stands for all."""

    def __init__(self, delay_ms: int, columns: list[str]):
        self.delay_ms = delay_ms
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "keys array<string>, expires array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        told = Row(*self.columns)
        mark = timerValues.getCurrentWatermarkInMs()
        known = self._known()
        due = min(known.values(), default=None)
        first: dict[str, tuple[int, tuple]] = {}
        for row in rows:
            name, ms, event = row[1], row[2], tuple(row)[3:]
            if ms is None or ms < mark:
                yield told(*event, True)
            elif name not in known and (name not in first or ms < first[name][0]):
                first[name] = ms, event
        if first:
            known |= {name: ms + self.delay_ms for name, (ms, _) in first.items()}
            self._remember(known, due)
        for _, event in first.values():
            yield told(*event, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        self._remember({name: end for name, end in self._known().items() if end > mark}, None)
        yield from ()

    def _known(self) -> dict[str, int]:
        return dict(zip(*self.seen.get())) if self.seen.exists() else {}

    def _remember(self, known: dict[str, int], due: int | None) -> None:
        """Keeps these keys; ``due`` is the timer already set, if any."""
        if not known:
            self.seen.clear()
            return
        self.seen.update((list(known), list(known.values())))
        soonest = min(known.values())
        if soonest != due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(soonest)

    def close(self) -> None:
        pass


def _key_text(stream: DataFrame, key: str) -> Column:
    """A key as text, equal where the keys are; a missing key is one of its own."""
    c = named(key)
    if isinstance(stream.schema[key].dataType, (T.DoubleType, T.FloatType)):
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(c.alias("k")), options)


def dedupe_with_late(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """First event per key within ``delay``, and every event that came later than the watermark
    allows, told apart by the added column ``late``; nothing is left out unseen.

    A key is remembered until its event time plus ``delay`` lies behind the watermark, so the state
    holds the keys of that span only. The watermark of a micro-batch is the latest event time of
    the batches before it, less ``delay``. An event without a time is late. Run it with
    ``run_to_table`` or inside ``keyed_state``.
    """
    timed = stream.withColumn(event_time, named(event_time).cast("timestamp")).withWatermark(event_time, delay)
    # the operator would drop late rows by the marked column, so its value is passed on unmarked;
    # the processor's rows keep no names that are not identifiers, so columns go by number
    plain = F.timestamp_micros(F.unix_micros(named(event_time)))
    names = {c: f"c{i}" for i, c in enumerate(stream.columns)}
    text = _key_text(stream, key)
    events = [(plain if c == event_time else named(c)).alias(n) for c, n in names.items()]
    rows = timed.select(
        F.pmod(F.xxhash64(text), F.lit(KEY_GROUPS)).alias("key_group"), text.alias("key_text"), F.unix_millis(plain).alias("ms"), *events,
    )
    out = T.StructType([*rows.schema.fields[3:], T.StructField("late", T.BooleanType())])
    delay_ms = stream.sparkSession.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {delay})").first()[0]
    told = rows.groupBy("key_group").transformWithState(_FirstInTime(delay_ms, out.names), out, "Append", "EventTime")
    return told.select(*[F.col(n).alias(c) for c, n in names.items()], "late")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession):
    """The state store that keyed processors need; the session's own setting comes back after."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Process what is there, append it to Parquet files and stop. Returns the number of
    rows that Spark's own operators left out because they came later than the watermark allows,
    in the micro-batches that the session remembers (100 by default); ``dedupe_with_late`` gives
    all of them back as rows."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    return sum(o["numRowsDroppedByWatermark"] for o in operators)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """As run_available into the shared folder; returns what was written."""
    spark = stream.sparkSession
    target = scratch_path(spark, name)
    with keyed_state(spark):
        run_available(stream, target + "/data", target + "/checkpoint")
    return spark.read.schema(stream.schema).parquet(target + "/data")
