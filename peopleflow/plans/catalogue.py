"""Every operator as a named query over the given tables: name -> f(spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peopleflow.operators import completion, merge, messages, monitor, reports, synth, words
from peopleflow.plans import inputs, people_reports
from peopleflow.plans.inputs import people, table
from peopleflow import versions
from peopleflow.schemas import KEY, PEOPLE_COLUMNS, topic_schema
from peopleflow.session import new_path, stage
from peopleflow.sinks import exports, files, sql_dump
from peopleflow.sources import snapshot
from peopleflow.sources.files import read_csv, read_json
from peopleflow.sources.topics import read_replay, stream_replay, write_replay
from peopleflow.streaming import generate, live, progress, sinks, target
from peopleflow.streaming.merge import merge_session, merged_records, start_merge

Query = Callable[[SparkSession, str], DataFrame]

DOCUMENT_TEXT = ["text", "lang", "source"]
FIRST_N_USERS = 50
FIRST_N_PEOPLE = 100
#: Of a stored log, messages of a file at most, and the micro-batches that its stream reads it in.
REPLAY_ROWS, REPLAY_BATCHES = 100_000, 4
PROGRESS_RUNS = 4
EVENT_POSITION = ["ts", "event_id"]


# Files -----------------------------------------------------------------------------------


def _json_copy(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "people.json")
    files.write_json(people(spark, sf_dir), path)
    return path


def _csv_copy(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "people.csv")
    files.write_csv(people(spark, sf_dir), path)
    return path


def scan_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json(spark, _json_copy(spark, sf_dir))


def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, _csv_copy(spark, sf_dir))


def scan_csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "documents.csv")
    documents = table(spark, sf_dir, "documents")
    files.write_csv(documents, path)
    return read_csv(spark, path, documents.schema, multiline=True)


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    inferred = {
        "json": read_json(spark, _json_copy(spark, sf_dir), schema=None),
        "csv": read_csv(spark, _csv_copy(spark, sf_dir), schema=None),
    }
    json_report, csv_report = [
        reports.schema_report(df).select(F.lit(name).alias("format"), "*")
        for name, df in inferred.items()
    ]
    return json_report.unionByName(csv_report)


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.preview(table(spark, sf_dir, "orders"), ["o_orderkey"])


def export_size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of the exported people by format, without the header that each CSV file has."""
    sizes = exports.export_people(people(spark, sf_dir), new_path(spark, "export"))
    header = len(",".join(PEOPLE_COLUMNS)) + 1
    headers = F.when(F.col("format") == "csv", F.col("files") * header).otherwise(0)
    return sizes.select("format", (F.col("bytes") - headers).alias("bytes"))


def rendered_size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.rendered_bytes(table(spark, sf_dir, "part"))


def scan_json_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "part.json")
    parts = table(spark, sf_dir, "part")
    files.write_json(parts, path)
    return read_json(spark, path, parts.schema)


def consume_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge the topics, export the records, and read the exported JSON back."""
    folder = new_path(spark, "export")
    exports.export_people(merge.merge_messages(inputs.full_log(spark, sf_dir)), folder)
    return read_json(spark, f"{folder}/personas.json")


def sql_literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_dump.literal_rows(people(spark, sf_dir))


def sql_literal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_dump.literal_rows(table(spark, sf_dir, "part"), "p_partkey")


def sql_export_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_dump.sql_statements(people(spark, sf_dir))


# Reports ---------------------------------------------------------------------------------


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_count(table(spark, sf_dir, "lineitem"))


def filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_counts(
        people(spark, sf_dir),
        active=F.col("activo"),
        aged_30_up=F.col("edad") >= 30,
        above_50k=F.col("ingreso_mensual") > 50000,
    )


def filter_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_counts(
        table(spark, sf_dir, "orders"),
        open=F.col("o_orderstatus") == "O",
        large=F.col("o_totalprice") >= 100000,
        pending_large=(F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000),
    )


def filtered_top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.col("o_orderstatus").isin("O", "P") & (F.col("o_totalprice") > 1000)
    shown = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    order = [F.desc("o_totalprice"), "o_orderkey"]
    return reports.filtered_top(table(spark, sf_dir, "orders"), wanted, shown, order, 10)


def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_groups(table(spark, sf_dir, "orders"), "o_custkey")


def group_report_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.group_report(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        F.col("l_quantity") > 25,
        n=F.count("*"),
        avg_l_extendedprice=F.round(F.avg("l_extendedprice"), 2),
    )


def group_cardinalities_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.group_cardinalities(
        table(spark, sf_dir, "orders"),
        customer_status=["o_custkey", "o_orderstatus"],
        status=["o_orderstatus"],
    )


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(table(spark, sf_dir, "documents"), DOCUMENT_TEXT)


def word_count_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(table(spark, sf_dir, "conversations"), ["role", "text"])


def word_count_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(people(spark, sf_dir))


def word_count_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(table(spark, sf_dir, "documents"), DOCUMENT_TEXT)


def distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.distinct_words(table(spark, sf_dir, "documents"), DOCUMENT_TEXT)


def count_by_key_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_groups(people(spark, sf_dir), "estado")


def avg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.average_by(table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", 2)


def avg_by_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.average_by(people(spark, sf_dir), "ocupacion", "ingreso_mensual", 2)


def avg1_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.average_by(people(spark, sf_dir), "nivel_estudios", "edad", 1)


def sql_filter_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_reports.best_paid_graduates(people(spark, sf_dir))


def sql_group_by_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_reports.pay_by_occupation_and_gender(people(spark, sf_dir))


def sql_group_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_reports.tech_cities(people(spark, sf_dir))


SEGMENTS_BY_NATION = """
    SELECT n_name, c_mktsegment, count(*) AS customers, {average} AS avg_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, c_mktsegment
    ORDER BY n_name, c_mktsegment
"""


def sql_group_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = SEGMENTS_BY_NATION.format(average="round(avg(c_acctbal), 2)")
    views = {name: table(spark, sf_dir, name) for name in ("customer", "nation")}
    return reports.run_sql(spark, text, **views)


def heavy_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    averages = reports.averages_by(
        table(spark, sf_dir, "lineitem"), keys, ["l_extendedprice", "l_quantity"]
    )
    return _six_digits(averages)


def heavy_group_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = reports.averages_by(
        people(spark, sf_dir), ["estado", "ocupacion"], ["ingreso_mensual", "edad"]
    )
    return _six_digits(averages)


def _six_digits(averages: DataFrame) -> DataFrame:
    """Cut off what depends on the order in which doubles are added up."""
    rounded = {n: F.round(n, 6) for n in averages.columns if n.startswith("avg_")}
    return averages.withColumns(rounded)


def count_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_by(people(spark, sf_dir), "nivel_estudios", "genero")


def group_cardinalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.group_cardinalities(
        people(spark, sf_dir),
        estado_ocupacion=["estado", "ocupacion"],
        nivel_genero=["nivel_estudios", "genero"],
    )


# Messages --------------------------------------------------------------------------------


def parse_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return messages.parse_messages(events, "k int", "props", keep=["event_id"])


def parse_person_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.full_log(spark, sf_dir).where(F.col("topic") == "personas")
    return messages.parse_messages(log, topic_schema("personas"))


def fanout_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.fanout(people(spark, sf_dir), keep=[KEY])


def _stored(spark: SparkSession, log: DataFrame) -> DataFrame:
    """A log that is read more than once, written first."""
    path = new_path(spark, "log")
    write_replay(log, path, by_topic=True)
    return read_replay(spark, path)


def topics_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.join_topics(inputs.whole_message_log(spark, sf_dir))


def merge_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_messages(inputs.full_log(spark, sf_dir))


def _event_fields() -> dict[str, merge.Field]:
    return {
        kind: merge.Field(F.col("value"), F.col("event_type") == kind)
        for kind in inputs.EVENT_TYPES
    }


def merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return merge.merge_fields(events, "user_id", _event_fields(), EVENT_POSITION)


def first_n_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completion.first_n_complete(
        table(spark, sf_dir, "events"), "user_id", _event_fields(), FIRST_N_USERS, EVENT_POSITION
    )


def completion_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return completion.completions(events, "user_id", _event_fields(), EVENT_POSITION)


def first_n_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _stored(spark, inputs.full_log(spark, sf_dir))
    return completion.first_n_records(log, FIRST_N_PEOPLE)


def log_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.log_ends(inputs.full_log(spark, sf_dir))


def merge_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of the log as it stood when the income messages had not yet come behind its ends."""
    ends = stage(snapshot.log_ends(inputs.whole_message_log(spark, sf_dir)), "ends")
    return merge.merge_messages(snapshot.up_to(inputs.full_log(spark, sf_dir), ends))


def first_n_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first people over three runs: a smaller target, a log too short for the target, and a longer log."""
    checkpoint, path = new_path(spark, "target"), new_path(spark, "log")
    log = _stored(spark, inputs.people_log(spark, sf_dir))
    sent = F.col("offset") <= log.agg(F.max("offset") / 2).scalar()
    write_replay(log.where(sent), path)
    for n in (FIRST_N_PEOPLE // 4, FIRST_N_PEOPLE):
        target.resume_target(read_replay(spark, path), checkpoint, n)
    write_replay(log.where(~sent), path)
    return target.resume_target(read_replay(spark, path), checkpoint, FIRST_N_PEOPLE)


def message_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.full_log(spark, sf_dir).unionByName(inputs.odd_log(spark, sf_dir))
    return monitor.message_validity(log)


def merge_odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only whole messages change a record, whichever way their id is written."""
    log = inputs.people_log(spark, sf_dir).unionByName(inputs.odd_log(spark, sf_dir))
    return merge.merge_messages(log)


def topic_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.topic_counters(table(spark, sf_dir, "events"), "event_type")


def topic_counters_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.topic_counters(inputs.full_log(spark, sf_dir), value="value")


def topic_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.monitor_lines(inputs.full_log(spark, sf_dir), limit=0)


def topic_monitor_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.monitor_lines(inputs.people_log(spark, sf_dir))


def topic_raw_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.raw_lines(inputs.people_log(spark, sf_dir))


# Streams ---------------------------------------------------------------------------------


def _replayed(spark: SparkSession, log: DataFrame) -> DataFrame:
    """Store a log as it is partitioned and stream it back, a share of its bytes per micro-batch.

    A micro-batch ends before the file that would pass its share. So shares are an eighth larger, or
    a last micro-batch would go through the whole state for what the others have left.
    """
    path = new_path(spark, "replay")
    write_replay(log, path, rows_per_file=REPLAY_ROWS)
    stored = versions.stored_bytes(spark, path)
    share = (stored + stored // 8) // REPLAY_BATCHES + 1
    return stream_replay(spark, path, bytes_per_trigger=share)


def _snapshot(spark: SparkSession, result: DataFrame) -> DataFrame:
    path, checkpoint = new_path(spark, "live"), new_path(spark, "checkpoint")
    sinks.start_versions(result, path, checkpoint, "complete").awaitTermination()
    return sinks.last_snapshot(spark, path, result.schema)


def live_count_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_replay(spark, sf_dir, glob="events.parquet")
    counts = live.live_counts(events, "event_type", "value")
    return live.ranked(_snapshot(spark, counts), "event_type")


def live_count_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _replayed(spark, inputs.full_log(spark, sf_dir))
    return live.ranked(_snapshot(spark, live.live_people_by_state(log)), "estado")


def stream_merge_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = new_path(spark, "merged"), new_path(spark, "checkpoint")
    log = _replayed(merge_session(spark), inputs.full_log(spark, sf_dir))
    start_merge(log, path, checkpoint).awaitTermination()
    return merged_records(spark, path)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = new_path(spark, "replay")
    path, checkpoint = new_path(spark, "merged"), new_path(spark, "checkpoint")
    for part in (inputs.whole_message_log, inputs.income_log):
        write_replay(part(spark, sf_dir), replay)
        start_merge(stream_replay(merge_session(spark), replay), path, checkpoint).awaitTermination()
    return merged_records(spark, path)


def stream_input_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = stream_progress(spark, sf_dir)
    return batches.agg(
        F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows")
    )


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a live report reads in each of some runs, between which a part of the log arrives."""
    replay, table_ = new_path(spark, "replay"), new_path(spark, "progress")
    path, checkpoint = new_path(spark, "live"), new_path(spark, "checkpoint")
    log = inputs.people_log(spark, sf_dir).unionByName(inputs.noise_log(spark, sf_dir))
    with progress.progress_table(spark, table_) as noted:
        for run in range(PROGRESS_RUNS):
            write_replay(log.where(F.col("offset") % PROGRESS_RUNS == run), replay)
            counts = live.live_people_by_state(progress.observed(stream_replay(spark, replay)))
            query = sinks.start_versions(counts, path, checkpoint, "complete")
            query.awaitTermination()
            noted.wait(query)
    return progress.progress_report(spark, table_)


# Generation ------------------------------------------------------------------------------


def synth_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people(spark, sf_dir)


def synth_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of the lower half of the customers' ids, and then of the ids after it."""
    ids = table(spark, sf_dir, "customer").selectExpr(f"c_custkey + 1 AS {KEY}")
    sent = ids.agg(F.max(KEY) / 2).scalar()
    first = synth.people_of(ids.where(F.col(KEY) <= sent))
    return first.unionByName(synth.people_of(ids.where(F.col(KEY) > sent)))


def synth_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = new_path(spark, "sent"), new_path(spark, "checkpoint")
    customers = stream_replay(spark, sf_dir, glob="customer.parquet")
    sent = generate.message_stream(customers.select((F.col("c_custkey") + 1).alias(KEY)))
    sinks.start_append(sent, path, checkpoint).awaitTermination()
    return spark.read.schema(sent.schema).parquet(path)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_json_roundtrip,
        scan_csv_roundtrip,
        scan_csv_documents,
        schema_report,
        preview_rows,
        export_size_report,
        rendered_size_report,
        scan_json_parts,
        consume_export,
        sql_literal_rows,
        sql_literal_parts,
        sql_export_batches,
        row_count,
        filter_counts,
        filter_counts_orders,
        filtered_top_orders,
        top_customers,
        group_report_lineitem,
        group_cardinalities_orders,
        word_count,
        word_count_conversations,
        word_count_people,
        word_count_top,
        distinct_words,
        count_by_key_topk,
        avg_by_key,
        avg_by_occupation,
        avg1_by_key,
        sql_filter_topk,
        sql_group_by_gender,
        sql_group_topk,
        sql_group_two_keys,
        heavy_group,
        heavy_group_people,
        count_two_keys,
        group_cardinalities,
        parse_json_messages,
        parse_person_messages,
        fanout_messages,
        topics_join,
        merge_complete,
        merge_events,
        first_n_complete,
        completion_positions,
        first_n_people,
        first_n_resumed,
        log_ends,
        merge_pinned,
        message_validity,
        merge_odd_messages,
        topic_counters,
        topic_counters_log,
        topic_monitor,
        topic_monitor_first,
        topic_raw_first,
        live_count_by_group,
        live_count_messages,
        stream_merge_complete,
        stream_resume,
        stream_progress,
        stream_input_rows,
        synth_people,
        synth_resume,
        synth_stream,
    )
}
