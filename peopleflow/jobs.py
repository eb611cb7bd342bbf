"""Command-line jobs: ``spark-submit ... peopleflow/jobs.py <job> [options]``.

Every job runs on the session that spark-submit configures. Topic jobs take ``--brokers`` for
Kafka, or ``--replay`` for a folder of stored messages.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peopleflow.operators import completion, merge, messages, monitor, reports, synth, words
from peopleflow.plans import people_reports
from peopleflow.schemas import KEY, TOPIC_FIELDS
from peopleflow.session import build_session, cached, drop_staged, stage
from peopleflow.sinks.exports import export_people
from peopleflow.sinks.topics import start_topics, write_topics
from peopleflow.sources.files import read_csv, read_json
from peopleflow.sources.snapshot import log_ends, up_to
from peopleflow.sources.topics import (
    read_replay,
    read_topics,
    read_topics_until,
    stream_replay,
    stream_topics,
)
from peopleflow.streaming import generate, live
from peopleflow.streaming.merge import merge_session, merged_records, start_merge
from peopleflow.streaming.sinks import start_console
from peopleflow.streaming.target import resume_target

TOPICS = list(TOPIC_FIELDS)


@contextmanager
def timed(label: str) -> Iterator[None]:
    """Print the wall-clock seconds of a block."""
    start = time.perf_counter()
    yield
    print(f"{label}: {time.perf_counter() - start:.2f} s")


def show(title: str, df: DataFrame, rows: int = 20) -> None:
    print(f"\n== {title} ==")
    df.show(rows, truncate=False)


def _log(spark: SparkSession, args: argparse.Namespace, topics: list[str] = TOPICS) -> DataFrame:
    if args.replay:
        return read_replay(spark, args.replay)
    return read_topics(spark, args.brokers, topics)


def _pinned_log(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The topics as they stand now, for several passes."""
    log = _log(spark, args)
    ends = stage(log_ends(log), "ends")
    return up_to(log, ends) if args.replay else read_topics_until(spark, args.brokers, ends)


def _log_stream(
    spark: SparkSession, args: argparse.Namespace, topics: list[str], starting: str
) -> DataFrame:
    if args.replay:
        return stream_replay(spark, args.replay)
    return stream_topics(spark, args.brokers, topics, starting)


def word_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Most frequent words, number of different words, number of rows."""
    people = read_json(spark, args.input)
    show("Most frequent words", words.top_words(people, top=args.top), args.top)
    show("Different words", words.distinct_words(people))
    show("Rows", reports.row_count(people))


def file_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Inferred schemas, row counts, a preview and filtered counts of JSON and CSV."""
    for kind, df in {
        "JSON": read_json(spark, args.json, schema=None),
        "CSV": read_csv(spark, args.csv, schema=None),
    }.items():
        show(f"{kind} columns", reports.schema_report(df), len(df.columns))
        show(f"{kind} rows", reports.row_count(df))
        show(f"{kind} preview", reports.preview(df, [KEY]))
    counts = reports.filter_counts(
        read_csv(spark, args.csv),
        active=F.col("activo"),
        aged_30_up=F.col("edad") >= 30,
        above_50k=F.col("ingreso_mensual") > 50000,
    )
    show("Filters", counts)


def report_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Grouped reports and SQL over one cached table."""
    with cached(read_json(spark, args.input)) as people:
        show("People by state", reports.top_groups(people, "estado"))
        pay = reports.average_by(people, "ocupacion", "ingreso_mensual", 2)
        show("Income by occupation", pay)
        show("Age by education", reports.average_by(people, "nivel_estudios", "edad", 1))
        show("Best-paid graduates", people_reports.best_paid_graduates(people))
        pay = people_reports.pay_by_occupation_and_gender(people)
        show("Pay by occupation and gender", pay, 100)
        show("Cities with most technical people", people_reports.tech_cities(people))


def timing_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """The heavy aggregations, timed without the read of the schema."""
    people = read_json(spark, args.input)
    groupings = {
        "estado_ocupacion": ["estado", "ocupacion"],
        "nivel_genero": ["nivel_estudios", "genero"],
    }
    with timed(f"{spark.conf.get('spark.master')}"):
        for result in (
            reports.averages_by(people, groupings["estado_ocupacion"], ["ingreso_mensual", "edad"]),
            reports.count_by(people, *groupings["nivel_genero"]),
            reports.row_count(people),
        ):
            result.write.format("noop").mode("overwrite").save()
    show("Groups", reports.group_cardinalities(people, **groupings))
    show("Rows", reports.row_count(people))


def live_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """People per state on the console, as messages arrive."""
    log = _log_stream(spark, args, ["personas"], "latest")
    report = live.live_people_by_state(log, args.drop_malformed)
    start_console(live.ranked(report, "estado"), args.every or None).awaitTermination()


def generate_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Generated people as JSON, CSV and SQL folders."""
    people = synth.generate_people(spark, args.count, seed=args.seed)
    show("Written", export_people(people, args.out, mode=args.mode))


def produce_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Generated people to the three topics, all at once or one every ``--delay`` seconds.

    With ``--delay`` it goes on until it is stopped, from where ``--checkpoint`` left off.
    """
    if args.delay > 0:
        if not args.checkpoint or args.total is not None:
            raise SystemExit("--delay needs --checkpoint, and --total does not apply to it")
        ids = generate.id_stream(spark, last_id=args.last_id)
        sent = generate.message_stream(ids, seed=args.seed)
        every = f"{round(args.delay * 1000)} milliseconds"
        start_topics(sent, args.brokers, args.checkpoint, every).awaitTermination()
    else:
        total = 100_000 if args.total is None else args.total
        people = synth.generate_people(spark, total, args.last_id, args.seed)
        write_topics(messages.fanout(people), args.brokers)


def consume_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Merge the topics into complete records and export them.

    With ``--checkpoint`` a run goes on where the last one stopped; without, it reads the topics
    from the start. ``--total`` stops at that many complete records, those of earlier runs of the
    checkpoint included. Without ``--total`` all records are merged. What arrives during a run waits for the next.
    """
    if args.checkpoint and args.total is None:
        log = _log_stream(merge_session(spark), args, TOPICS, "earliest")
        changes = f"{args.checkpoint}/changes"
        state = f"{args.checkpoint}/state"
        start_merge(log, changes, state, expire_after=args.expire_after).awaitTermination()
        records = merged_records(spark, changes)
    else:
        log = _pinned_log(spark, args)
        show("Messages", monitor.message_validity(log))
        show("First messages", monitor.raw_lines(log), 30)
        if args.total is None:
            records = merge.merge_messages(log)
        elif args.checkpoint:
            records = resume_target(log, f"{args.checkpoint}/target", args.total)
        else:
            records = completion.first_n_records(log, args.total)
    show("Written", export_people(records, args.out, mode=args.mode))


def monitor_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Readable lines for the first messages on the topics, or for all of them into a folder."""
    lines = monitor.monitor_lines(_log(spark, args), args.limit).select("line")
    if args.out:
        lines.write.text(args.out)
    elif args.limit > 0:
        show("Messages", lines, args.limit)
    else:
        raise SystemExit("--limit 0 needs --out: the lines of a whole log go to files")


def _count(text: str) -> int:
    """A number of rows, one at least."""
    if int(text) < 1:
        raise argparse.ArgumentTypeError("give a number from 1 on, or leave the option out for the default")
    return int(text)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="peopleflow", description=__doc__)
    jobs = top.add_subparsers(required=True, metavar="job")

    def job(name: str, run, *options: tuple[str, dict]) -> None:
        sub = jobs.add_parser(name, help=run.__doc__.splitlines()[0])
        sub.set_defaults(run=run)
        for flag, settings in options:
            sub.add_argument(flag, **settings)

    required = {"required": True}
    brokers, replay = ("--brokers", {}), ("--replay", {})
    out = [("--out", required), ("--mode", {"default": "errorifexists"})]
    seed = ("--seed", {"type": int, "default": 42})
    job("words", word_job, ("--input", required), ("--top", {"type": int, "default": 20}))
    job("files", file_job, ("--json", required), ("--csv", required))
    job("reports", report_job, ("--input", required))
    job("timing", timing_job, ("--input", required))
    job(
        "live",
        live_job,
        brokers,
        replay,
        ("--every", {"default": "15 seconds", "help": "empty: drain the topic and stop"}),
        ("--drop-malformed", {"action": "store_true"}),
    )
    job("generate", generate_job, ("--count", {"type": int, "default": 100_000}), seed, *out)
    job(
        "produce",
        produce_job,
        ("--brokers", required),
        ("--total", {"type": _count, "help": "people to send; 100,000 unless given"}),
        ("--last-id", {"type": int, "default": 0}),
        ("--delay", {"type": float, "default": 0.0}),
        ("--checkpoint", {}),
        seed,
    )
    job(
        "consume",
        consume_job,
        brokers,
        replay,
        ("--total", {"type": _count, "help": "complete records; all unless given"}),
        ("--checkpoint", {}),
        ("--expire-after", {"help": "with --checkpoint: how long incomplete ids are kept, like '2 days'"}),
        *out,
    )
    limit = ("--limit", {"type": int, "default": 50, "help": "0: all"})
    job("monitor", monitor_job, brokers, replay, limit, ("--out", {}))
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("peopleflow")
    try:
        with timed("Total"):
            args.run(spark, args)
    finally:
        drop_staged(spark)


if __name__ == "__main__":
    main()
