"""Structured Streaming jobs (STR-1..4).

The domain names three record topics and two rate tables (weekly and
monthly, family ``rates``) but ships no stream code; the semantics below
are ours:

* sources are file streams (a folder of parquet files, one table picked by
  name); a Kafka source plugs in the same way via ``spark.readStream``;
* record timestamps are wall-clock UTC without zone (``TIMESTAMP_NTZ``);
  event time is that wall clock read as UTC, whatever the session time
  zone, and output dates are converted back the same way, so week and
  month boundaries are UTC boundaries in every session;
* late rows are told apart before any state, by a ledger of event times per
  micro-batch, and are kept as rows;
* weekly tables use Monday-aligned tumbling windows (7 days, offset 4 days
  from the epoch, a Thursday); monthly tables group by the month start,
  which needs update mode (windows cannot be calendar months);
* results go through the idempotent ``foreachBatch`` sinks of
  ``portolan.streaming.sinks``; checkpoints live under the shared
  checkpoint folder, so a restarted query resumes without duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from portolan.functions.columns import fixed_mean, partial_sum, rate_scale
from portolan.session import path_status
from portolan.streaming.sinks import BATCH_COL, FOLD_EVERY, AppendSink, BatchTable, Ledger, UpsertSink

WEEK = "7 days"
MONDAY_OFFSET = "4 days"
PROPS_SCHEMA = "k INT"


def file_stream(spark: SparkSession, folder: str, table: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the table ``<table>.parquet`` of ``folder``, one file or a
    directory of files (schema taken from the files once, as file streams
    require).  A missing table raises."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_status(spark, path) == "directory":
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def _session_tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def utc_instant(ntz, tz: str):
    """TIMESTAMP_NTZ wall clock taken as UTC -> TIMESTAMP (an instant)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz).cast("timestamp")


def utc_date(instant, tz: str):
    """TIMESTAMP instant -> its UTC calendar date."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), instant.cast("timestamp_ntz")).cast("date")


def rate_events(events: DataFrame) -> DataFrame:
    """Event records as rate observations: type -> currency, value -> rate,
    record time -> event time (UTC instant); ``ts`` is kept as is."""
    tz = _session_tz(events)
    return events.select(
        F.col("event_type").alias("currency"),
        F.col("value").alias("rate"),
        F.col("ts"),
        utc_instant(F.col("ts"), tz).alias("event_time"))


def _rate_aggs():
    return [F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"),
            fixed_mean("rate").alias("avg_rate"),
            F.count(F.lit(1)).alias("n_rates")]


WEEK_KEYS = ["currency", "week_start", "week_end"]


class WeeklyRates:
    """STR-2: ``foreachBatch`` that keeps min / max / mean per currency and Monday
    week, and the rows that came too late for their week as a table.

    A row is late if its week had ended at the watermark, the greatest event time
    of the batches before less ``delay``.  Rows in time are reduced to one partial
    row per currency and week and batch; partial rows add up, so the table's state
    is the sum of its batches and each row of the source counts either there or
    as a late row.  Nothing is kept in executors between batches.
    """

    def __init__(self, path: str, delay: str = "1 day", fold_every: int = FOLD_EVERY) -> None:
        path = path.rstrip("/")
        # the mode in which sums are made is that of the moment the job is defined
        self.part, self.finish = partial_sum("rate", rate_scale())
        self.table = BatchTable(f"{path}/weeks", self._merge, fold_every)
        self.late = BatchTable(f"{path}/late")
        self.ledger = Ledger(f"{path}/ledger", delay, fold_every)

    @staticmethod
    def _merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*WEEK_KEYS).agg(
            F.min("min_rate").alias("min_rate"), F.max("max_rate").alias("max_rate"),
            F.sum("sum_rate").alias("sum_rate"), F.sum("n_valued").alias("n_valued"),
            F.sum("n_rates").alias("n_rates"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, tz = batch.sparkSession, _session_tz(batch)
        edge = self.ledger.watermark(spark, batch_id)
        w = F.window("event_time", WEEK, WEEK, MONDAY_OFFSET)
        # rows without an event time belong to no week: they are kept as late
        known = batch.filter(F.col("event_time").isNotNull()).withColumn("w", w)
        is_late = F.lit(False) if edge is None else F.col("w.end") <= F.lit(edge)
        late = known.filter(is_late).drop("w").unionByName(batch.filter(F.col("event_time").isNull()))
        parts = (known.filter(~is_late)
                 .groupBy("currency", utc_date(F.col("w.start"), tz).alias("week_start"),
                          utc_date(F.col("w.end"), tz).alias("week_end"))
                 .agg(F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"), self.part.alias("sum_rate"),
                      F.count("rate").alias("n_valued"), F.count(F.lit(1)).alias("n_rates")))
        self.late.write(late, batch_id)
        self.table.commit(parts, batch_id)
        self.ledger.note(batch, batch_id, "event_time")

    def start(self, rates: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        return _run(rates.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint), available_now)

    def weeks(self, spark: SparkSession) -> DataFrame:
        """currency, week_start, week_end, min_rate, max_rate, avg_rate, n_rates."""
        number = T.DoubleType() if rate_scale() is None else T.LongType()
        schema = T.StructType([
            T.StructField("currency", T.StringType()), T.StructField("week_start", T.DateType()),
            T.StructField("week_end", T.DateType()), T.StructField("min_rate", T.DoubleType()),
            T.StructField("max_rate", T.DoubleType()), T.StructField("sum_rate", number),
            T.StructField("n_valued", T.LongType()), T.StructField("n_rates", T.LongType())])
        mean = F.try_divide(self.finish(F.col("sum_rate")), F.col("n_valued").cast("double"))
        return self.table.state(spark, schema).select(
            *WEEK_KEYS, "min_rate", "max_rate", mean.alias("avg_rate"), "n_rates")

    def late_rows(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        return self.late.state(spark, schema)

    def account(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """One row: rows_in (by the ledger), rows_in_table, rows_late."""
        seen = self.ledger.table.read(spark, Ledger.SCHEMA).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_in"))
        held = self.weeks(spark).agg(F.coalesce(F.sum("n_rates"), F.lit(0)).alias("rows_in_table"))
        late = self.late_rows(spark, schema).agg(F.count(F.lit(1)).alias("rows_late"))
        return seen.join(held).join(late)  # a row each


def monthly_rates(rates: DataFrame) -> DataFrame:
    """STR-3: min / max / mean per currency and calendar month (update
    mode; state is currencies x months)."""
    month = F.trunc(F.col("ts").cast("date"), "month").alias("month_start")
    return rates.groupBy("currency", month).agg(*_rate_aggs())


def _run(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def run_upsert(agg: DataFrame, path: str, checkpoint: str, keys: list[str], available_now: bool = True,
               query_name: str | None = None, fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Start an update-mode aggregation into an upsert table."""
    w = (agg.writeStream.outputMode("update").foreachBatch(UpsertSink(path, keys, fold_every))
         .option("checkpointLocation", checkpoint))
    return _run(w.queryName(query_name) if query_name else w, available_now)


#: Where a landed record may go (the folder ``outcome=<name>`` of its batch).
LANDED, BROKEN, MISMATCH, LATE, REPEATED = "landed", "broken_json", "type_mismatch", "late", "repeated"


class EventLanding:
    """STR-1: ``foreachBatch`` that lands event records as typed rows and keeps
    every other record with the reason.

    ``payload`` is the schema of the JSON column.  A record lands if its JSON is
    null or parses (absent and null fields are null); text that is no JSON goes to
    ``broken_json``, JSON whose fields do not fit to ``type_mismatch``.  Event ids
    are unique within ``dedup_within`` of event time: a second record is
    ``repeated``, and a record older than the watermark, whose id can no longer
    be looked up, is ``late``.  A batch is written once, dealt to one folder per
    outcome, so rows in = rows of all outcomes.
    """

    def __init__(self, path: str, payload: str = PROPS_SCHEMA, json_col: str = "props", dedup_within: str = "1 hour",
                 fold_every: int = FOLD_EVERY) -> None:
        path = path.rstrip("/")
        self.payload, self.json_col = payload, json_col
        self.table = BatchTable(f"{path}/events")
        self.ledger = Ledger(f"{path}/ledger", dedup_within, fold_every)

    def parsed(self, batch: DataFrame) -> DataFrame:
        schema = T.StructType.fromDDL(self.payload)
        text, fields = F.col(self.json_col), [f.name for f in schema.fields]
        p = F.from_json(text, f"{self.payload}, __corrupt STRING", {"columnNameOfCorruptRecord": "__corrupt"})
        shape = (F.when(text.isNull() | p.getField("__corrupt").isNull(), LANDED)
                 .when(F.try_parse_json(text).isNull(), BROKEN).otherwise(MISMATCH))
        return batch.select("*", *[p.getField(f).alias(f) for f in fields], shape.alias("outcome"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, tz = batch.sparkSession, _session_tz(batch)
        rows = batch.withColumn("event_time", utc_instant(F.col("ts"), tz))
        edge = self.ledger.watermark(spark, batch_id)
        self.write(rows, batch_id, edge)
        self.ledger.note(rows, batch_id, "event_time")

    def write(self, rows: DataFrame, batch_id: int, edge) -> None:
        spark = rows.sparkSession
        out = self.parsed(rows)
        if edge is not None:
            late = (F.col("outcome") == LANDED) & (F.col("event_time") < F.lit(edge))
            out = out.withColumn("outcome", F.when(late, LATE).otherwise(F.col("outcome")))
        candidate = (F.col("outcome") == LANDED) & F.col("event_id").isNotNull()
        # the ids that landed within the horizon before this batch: one id, one row
        before = self.table.read(spark, self.schema(rows), upto=batch_id - 1).filter(F.col("outcome") == LANDED)
        if edge is not None:
            before = before.filter(F.col("event_time") >= F.lit(edge))
        known = before.select(F.col("event_id").alias("__known")).distinct()
        # the first record of an id, by time and content: first within the tasks
        # that read the records, then among those; all others go by their hash,
        # so that neither a hot id nor a hot broken text fills one task
        content = F.xxhash64(*[F.col(c) for c in rows.columns])
        order = ["event_time", "__content"]
        out = out.withColumns({"__content": content, "__part": F.spark_partition_id()})
        own = Window.partitionBy(F.when(candidate, F.col("event_id")), F.when(~candidate, F.col("__content")), "__part")
        out = out.withColumn("__own", F.row_number().over(own.orderBy(*order)))
        leads = candidate & (F.col("__own") == 1)
        among = Window.partitionBy(F.when(leads, F.col("event_id")),
                                   F.when(~leads, F.xxhash64("__content", "__part", "__own")))
        out = (out.withColumn("__among", F.row_number().over(among.orderBy(*order)))
               .join(known, F.col("event_id") == F.col("__known"), "left"))
        repeated = candidate & ((F.col("__own") > 1) | (F.col("__among") > 1) | F.col("__known").isNotNull())
        out = out.withColumn("outcome", F.when(repeated, REPEATED).otherwise(F.col("outcome")))
        self.table.write(out.drop("__content", "__part", "__own", "__among", "__known"), batch_id,
                         partition_by="outcome")

    def schema(self, rows: DataFrame) -> T.StructType:
        fields = [*rows.schema.fields, *T.StructType.fromDDL(self.payload).fields]
        if "event_time" not in rows.columns:
            fields.insert(len(rows.columns), T.StructField("event_time", T.TimestampType()))
        return T.StructType([*fields, T.StructField("outcome", T.StringType())])

    def start(self, events: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        return _run(events.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint), available_now)

    def outcome(self, spark: SparkSession, events: DataFrame, name: str = LANDED) -> DataFrame:
        """The records of one outcome, without event time."""
        rows = self.table.read(spark, self.schema(events)).filter(F.col("outcome") == name)
        return rows.drop(BATCH_COL, "outcome", "event_time")

    def outcomes(self, spark: SparkSession, events: DataFrame) -> DataFrame:
        """(outcome, n_rows) of all records so far."""
        return (self.table.read(spark, self.schema(events)).groupBy("outcome")
                .agg(F.count(F.lit(1)).alias("n_rows")))


def run_append(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    w = (df.writeStream.outputMode("append").foreachBatch(AppendSink(path))
         .option("checkpointLocation", checkpoint))
    return _run(w, available_now)
