"""Run a job from the command line, for example with ``spark-submit``.

    report  TOPIC...   category counts on the console, ten windows of two minutes
    live    TOPIC...   publish result documents at every trigger
    produce SOURCE     publish the records of landed pages (text files, one page per line)
    add     URL        the source behind a URL: its producer and its live counts, until one of them ends or fails
    count   KIND       merge the latest documents of the named sources
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fieldtally.operators import registry, results
from fieldtally.plans import jobs
from fieldtally.plans.reading import FollowedResults
from fieldtally.schemas import SOURCES
from fieldtally.sources.messages import (
    BROKER,
    broker_options,
    file_stream,
    message_stream,
    read_result_log,
)
from fieldtally.streaming.sinks import LARGE_STATE, SMALL_STATE, run_for, run_together


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"fieldtally {args.job}").getOrCreate()
    if args.job == "count":
        count(spark, args).show(truncate=False)
        return
    if args.job == "add":
        started = add(spark, args)
        run_together(spark, [started.producer, started.query], args.seconds)
        return
    query = {"report": report, "live": live, "produce": produce}[args.job](spark, args)
    run_for(query, args.seconds)


def report(spark, args):
    return jobs.start_category_report(
        _messages(spark, args),
        args.checkpoint,
        topics=args.topics,
        every=args.every or jobs.REPORT_TRIGGER,
        settings=_state(args, SMALL_STATE),
    )


def live(spark, args):
    return jobs.start_live_counts(
        _messages(spark, args),
        args.checkpoint,
        fmt=args.format,
        path=args.results,
        options=broker_options(args.servers) if args.format == BROKER else None,
        topics=args.topics,
        every=args.every or jobs.LIVE_TRIGGER,
        settings=_state(args, SMALL_STATE),
        part_bytes=args.part_bytes,
    )


def produce(spark, args):
    return jobs.start_producer(
        _pages(spark, args),
        args.source,
        args.checkpoint,
        every=args.every or jobs.LIVE_TRIGGER,
        **_producer(args),
    )


def add(spark, args) -> jobs.StartedSource:
    """Start the producer and the live counts of the source; what it sends is counted from the first message on."""
    broker = args.format == BROKER
    return jobs.add_source(
        spark,
        args.url,
        registry.known_sources(spark),
        args.checkpoint,
        source={
            "fmt": args.format,
            "servers": args.servers,
            "path": args.messages,
            "starting_offsets": "earliest" if broker else None,
        },
        sink={
            "fmt": args.format,
            "path": args.results,
            "options": broker_options(args.servers) if broker else None,
            "settings": _state(args, SMALL_STATE),
            "part_bytes": args.part_bytes,
        },
        every=args.every or jobs.LIVE_TRIGGER,
        pages=_pages(spark, args),
        producer=_producer(args),
    )


def _pages(spark, args) -> DataFrame:
    whole = {"wholetext": "true"} if args.whole_files else None
    return file_stream(spark, args.pages, "page string", "text", whole)


def _producer(args) -> dict[str, object]:
    target = broker_options(args.servers) if args.format == BROKER else {"path": args.messages}
    return {"fmt": args.format, "options": target, "mode": args.mode}


def count(spark, args) -> DataFrame:
    active = registry.known_sources(spark)
    for name in args.sources:
        active = registry.mark_started(active, name)
    if args.follow:
        followed = FollowedResults(spark, args.sources, args.follow)
        log = followed.advance(args.format, args.servers, args.results)
        return results.count_by(log, args.by, active)
    log = read_result_log(spark, args.sources, args.format, args.servers, args.results)
    order_by = ("timestamp", "partition", "offset") if args.format == BROKER else ("offset",)
    topics = [name + results.RESULT_SUFFIX for name in args.sources]
    readable = results.readable(log, topics, order_by)
    return results.count_by(readable, args.by, active, order_by, parts=args.parts)


def _state(args, settings):
    """The job's state settings, with those of the command line on top."""
    settings = {**settings, **(LARGE_STATE if args.state_store == "rocksdb" else {})}
    if args.state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(args.state_partitions)
    return settings


def _messages(spark, args) -> DataFrame:
    return message_stream(spark, args.topics, args.format, args.servers, args.messages, args.start)


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--format", default=BROKER, help="kafka, or a file format such as parquet")
    shared.add_argument("--servers", nargs="*", default=[], help="broker addresses")
    shared.add_argument("--messages", help="folder of messages, for a file format")
    shared.add_argument("--results", help="folder of results, for a file format")

    running = argparse.ArgumentParser(add_help=False)
    running.add_argument("--checkpoint", required=True, help="folder that all executors share")
    running.add_argument("--every", help="trigger interval")

    state = argparse.ArgumentParser(add_help=False)
    state.add_argument(
        "--state-store", default="memory", choices=("memory", "rocksdb"), help="where running counts are kept"
    )
    state.add_argument("--state-partitions", type=int, help="parts of the state, fixed by the first start")

    documents = argparse.ArgumentParser(add_help=False)
    documents.add_argument("--part-bytes", type=int, help="publish longer result documents in parts of this size")

    landed = argparse.ArgumentParser(add_help=False)
    landed.add_argument("--pages", required=True, help="folder of landed pages")
    landed.add_argument("--whole-files", action="store_true", help="a page is a file, not a line")
    landed.add_argument(
        "--mode", default="FAILFAST", choices=("FAILFAST", "PERMISSIVE"), help="what a page that cannot be read does"
    )
    landed.add_argument("--seconds", type=float)

    top = argparse.ArgumentParser(prog="fieldtally")
    job = top.add_subparsers(dest="job", required=True)
    for name, seconds in (("report", jobs.REPORT_SECONDS), ("live", None)):
        own = [documents] if name == "live" else []
        streaming = job.add_parser(name, parents=[shared, running, state, *own])
        streaming.add_argument("topics", nargs="+", choices=SOURCES)
        streaming.add_argument("--start", help="first offsets to read from the broker, latest if not given")
        streaming.add_argument("--seconds", type=float, default=seconds)
    producing = job.add_parser("produce", parents=[shared, running, landed])
    producing.add_argument("source", choices=SOURCES)
    adding = job.add_parser("add", parents=[shared, running, state, documents, landed])
    adding.add_argument("url")
    counting = job.add_parser("count", parents=[shared])
    counting.add_argument("by", choices=results.COUNT_KINDS)
    reading = counting.add_mutually_exclusive_group()
    reading.add_argument("--follow", help="folder that keeps how far each topic has been read; reads on from there")
    reading.add_argument("--parts", action="store_true", help="documents may be in parts")
    counting.add_argument("--sources", nargs="+", default=list(SOURCES), choices=SOURCES)
    return top


if __name__ == "__main__":
    main()
