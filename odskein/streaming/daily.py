"""Events that arrive in files, counted per day while they come in.

Two ways, for two needs:

``closing_days`` is a streaming frame with Spark's own state: a watermark on the event's day, ids
remembered until their day closes, one count for each open day and key. It emits a day's counts once,
when the watermark has passed it. Its state is bounded by the days that are open; an event of a day
that has closed is dropped, as any watermark drops it (``numRowsDroppedByWatermark`` counts them).

``follow_days`` keeps a table of days exact, however late a row comes. Each micro-batch takes out
the events that the table has already (only the days the batch touches are looked into), adds the
rest to the table of events and its counts to the table of days. A batch that is run again after a
failure finds its number in the manifest and changes nothing twice. What is remembered grows on
storage, one folder a day, not in the executors; ``forget_before`` lets go of old days, whose events
are set aside from then on and not counted.

Both count an event once for its id and day. An event without an id or a time is in no day. Where
one comes back with other keys, the first that came counts, in one batch the smallest.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odskein.sinks.day_tables import LOAD, days_in, days_of, days_of_load, write_load
from odskein.sinks.manifests import commit, current

BATCH, FORGOTTEN = "_batch", "_forgotten"


@dataclass(frozen=True)
class Events:
    """Which columns of a stream are an event's id and time, and which are the keys to count by."""

    id: str
    time: str
    keys: tuple[str, ...]

    def day(self, rows: DataFrame) -> Column:
        """The UTC day of the event's time, whatever clock the session has."""
        return F.date_from_unix_date(_day_number(rows, self.time))

    def known(self, rows: DataFrame) -> DataFrame:
        """event_id, entry_day and the keys of the events that have an id and a time."""
        wanted = rows.select(F.col(self.id).alias("event_id"), self.day(rows).alias("entry_day"), *self.keys)
        return wanted.where(F.col("event_id").isNotNull() & F.col("entry_day").isNotNull())


def _day_number(rows: DataFrame, time: str) -> Column:
    if isinstance(rows.schema[time].dataType, T.TimestampType):
        return F.floor(F.unix_seconds(time) / 86_400).cast("int")
    return F.unix_date(F.to_date(time))


def count_days(rows: DataFrame, events: Events) -> DataFrame:
    """The same counts from a table: entry_day, the keys and the number of events."""
    return once(rows, events).groupBy("entry_day", *events.keys).agg(F.count(F.lit(1)).alias("n_events"))


def once(rows: DataFrame, events: Events) -> DataFrame:
    """event_id, entry_day and keys, one row for each id and day."""
    found = events.known(rows).groupBy("event_id", "entry_day").agg(F.min(F.struct(*events.keys)).alias("keys"))
    return found.select("event_id", "entry_day", "keys.*")


def closing_days(stream: DataFrame, events: Events, delay: str = "2 days") -> DataFrame:
    """entry_day, keys and n_events of each day, once no event within ``delay`` can belong to it any more.

    Write it in append mode. The watermark is on the start of the day, so the memory of ids and the
    counts let go of a day at the same moment.
    """
    start = F.timestamp_seconds(_day_number(stream, events.time).cast("bigint") * 86_400)
    rows = (
        stream.select(F.col(events.id).alias("event_id"), start.alias("day_start"), *events.keys)
        .where(F.col("event_id").isNotNull() & F.col("day_start").isNotNull())
        .withWatermark("day_start", delay)
        .dropDuplicatesWithinWatermark(["event_id", "day_start"])
    )
    counted = rows.groupBy("day_start", *events.keys).agg(F.count(F.lit(1)).alias("n_events"))
    day = F.date_from_unix_date(F.floor(F.unix_seconds("day_start") / 86_400).cast("int"))
    return counted.select(day.alias("entry_day"), *events.keys, "n_events")


class FollowedDays:
    """The tables that ``follow_days`` keeps below one folder.

    ``days`` holds the counts, ``events`` the ids that were counted, by day, ``late`` those that were
    set aside. One manifest names the folders of both tables, so they always agree.
    """

    def __init__(self, spark: SparkSession, folder: str, events: Events, key_types: str):
        """``key_types`` are the keys' names and types, as in ``"kind string, user_id bigint"``."""
        self.spark, self.folder, self.events = spark, folder, events
        self.count_schema = f"entry_day date, {key_types}, n_events bigint"
        self.row_schema = f"event_id string, entry_day date, {key_types}"
        self.event_schema = "event_id string, entry_day date"

    def counts(self) -> DataFrame:
        """entry_day, keys and n_events as of the last batch."""
        return days_of(self.spark, f"{self.folder}/days", self.count_schema, self._parts("days"))

    def late(self) -> DataFrame:
        """Events that came after their day was let go of; they are not counted."""
        return days_of(self.spark, f"{self.folder}/late", self.event_schema, self._parts("late"))

    def _parts(self, table: str, parts: dict[str, str] | None = None) -> dict[str, str]:
        parts = current(self.spark, self.folder)[1] if parts is None else parts
        return {name.split("/", 1)[1]: loads for name, loads in parts.items() if name.startswith(f"{table}/")}

    def add(self, batch: DataFrame, number: int) -> None:
        """Take in one micro-batch; one that was taken in before is left alone."""
        spark = batch.sparkSession
        after, parts = current(spark, self.folder)
        if int(parts.get(BATCH, "-1")) >= number:
            return
        rows = once(batch.withColumn(self.events.id, F.col(self.events.id).cast("string")), self.events)
        seen = self._seen(spark, parts, days_in(rows, "entry_day"))
        kept = F.col("entry_day") >= F.lit(parts.get(FORGOTTEN, "0001-01-01")).cast("date")
        fresh = rows.join(seen, ["event_id", "entry_day"], "left_anti")
        # the events are written first, and their counts taken from what was written
        load = write_load(fresh.where(kept), f"{self.folder}/events", "entry_day")
        late = write_load(fresh.where(~kept).select("event_id", "entry_day"), f"{self.folder}/late", "entry_day")
        added = spark.read.schema(self.row_schema).parquet(f"{self.folder}/events/{LOAD}={load}")
        days = [str(d) for d in days_of_load(spark, f"{self.folder}/events", load, "entry_day")]
        counts = added.groupBy("entry_day", *self.events.keys).agg(F.count(F.lit(1)).alias("n_events"))
        former = {d: loads for d, loads in self._parts("days", parts).items() if d in days}
        total = days_of(spark, f"{self.folder}/days", self.count_schema, former).unionByName(counts)
        total = total.groupBy("entry_day", *self.events.keys).agg(F.sum("n_events").alias("n_events"))
        counted = write_load(total, f"{self.folder}/days", "entry_day")
        set_aside = [str(d) for d in days_of_load(spark, f"{self.folder}/late", late, "entry_day")]
        changes = {f"days/{d}": counted for d in days}
        for name, more in [*((f"events/{d}", load) for d in days), *((f"late/{d}", late) for d in set_aside)]:
            changes[name] = f"{parts[name]} {more}" if name in parts else more
        commit(spark, self.folder, {**parts, **changes, BATCH: str(number)}, after)

    def _seen(self, spark: SparkSession, parts: dict[str, str], touched: list[date]) -> DataFrame:
        """Ids counted or set aside before on the days that the batch touches."""
        frames = []
        for table in ("events", "late"):
            of = {str(d): loads for d in touched if (loads := self._parts(table, parts).get(str(d)))}
            frames.append(days_of(spark, f"{self.folder}/{table}", self.event_schema, of))
        return frames[0].unionByName(frames[1])

    def forget_before(self, first: date) -> None:
        """Let go of the ids of days before ``first``; their counts stay as they are."""
        after, parts = current(self.spark, self.folder)
        kept = {n: x for n, x in parts.items() if not (n.startswith("events/") and date.fromisoformat(n.split("/")[1]) < first)}
        commit(self.spark, self.folder, {**kept, FORGOTTEN: max(str(first), parts.get(FORGOTTEN, ""))}, after)


def follow_days(stream: DataFrame, table: FollowedDays, checkpoint: str) -> None:
    """Take in all that has arrived since the last call, then stop."""
    query = (
        stream.writeStream.foreachBatch(table.add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
