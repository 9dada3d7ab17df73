"""Command line: ``python -m riskwindow JOB SOURCE OUTPUT …``.

``rollup`` turns raw events into a feature table stored by date, ``sql``, ``explore``, ``train`` and
``pipeline`` work on a feature table, ``score`` applies a saved model to one, and
``stream-rollup`` and ``stream-score`` do roll-up and scoring for events that keep coming.
``close-windows`` adds to a table stored by date what the stream has left open or dropped as late.
"""

import argparse

from riskwindow.operators import models
from riskwindow.plans.exploration import run_exploration
from riskwindow.plans.incident_pipeline import run_pipeline
from riskwindow.plans.rollup import close_windows
from riskwindow.plans.sql_suite import run_sql_suite
from riskwindow.plans.training import SPLITS, run_training
from riskwindow.session import session
from riskwindow.sources import (
    PANDAS_NULL_MARKERS,
    read_dated_windows,
    read_windows,
    windows_from_events,
    write_parquet,
    write_windows,
)
from riskwindow.streaming import (
    merge_stream,
    score_stream,
    windows_from_event_stream,
    write_batches,
    write_stream,
)

MAPPING = ("component", "event", "warning", "incident")
TABLE_JOBS = ("sql", "explore", "train", "pipeline", "score")
EVENT_JOBS = ("rollup", "close-windows", "stream-rollup", "stream-score")


def _arguments(argv=None):
    parser = argparse.ArgumentParser(prog="riskwindow")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in (*TABLE_JOBS, *EVENT_JOBS):
        job = jobs.add_parser(name)
        source = "feature table: path, or table name with --format table"
        if name in EVENT_JOBS:
            source = "folder of raw events in parquet"
            for part in MAPPING:
                job.add_argument(f"--{part}", required=True, help="as an SQL expression")
            job.add_argument("--time", default="ts")
        job.add_argument("source", help=source)
        job.add_argument("output", help="folder for the results, or for the model of `train`")
        if name == "sql":
            job.add_argument("--database", default="log_analysis")
            job.add_argument("--location", help="folder of the database, if it is created")
        elif name in TABLE_JOBS:
            job.add_argument("--format", choices=("csv", "parquet", "table", "dated"))
            job.add_argument("--from", dest="first", help="first date, for tables stored by date")
            job.add_argument("--to", dest="last", help="last date, for tables stored by date")
        if name == "close-windows":
            job.add_argument("--from", dest="first", help="first date of the events to roll up again")
            job.add_argument("--to", dest="last", help="last date of the events to roll up again")
        if name in ("train", "pipeline"):
            job.add_argument("--model", default="random_forest")
            job.add_argument("--partitions", type=int, help="fit on so many partitions at most")
        if name in ("score", "stream-score"):
            job.add_argument("--model", required=True, help="folder of a saved model")
            job.add_argument("--policy", default="zero", help="ratio policy of its training")
        if name.startswith("stream"):
            job.add_argument("--progress", required=True, help="folder for the stream's progress")
            job.add_argument("--delay", default="2 hours", help="how late an event may come")
            job.add_argument("--once", action="store_true", help="stop after what is there now")
        if name == "stream-rollup":
            job.add_argument("--merge", action="store_true", help="keep the output as a table stored by date")
        if name == "rollup":
            job.add_argument(
                "--whole", action="store_true", help="also delete stored dates that the events lack"
            )
        if name == "train":
            job.add_argument("--split", choices=SPLITS, default="stratified")
        if name == "pipeline":
            job.add_argument("--strict", action="store_true", help="fail when the gate fails")
    return parser.parse_args(argv)


def _read(spark, args):
    if args.format == "dated" or args.first or args.last:
        return read_dated_windows(spark, args.source, args.first, args.last)
    if args.format in ("table", "parquet"):
        return read_windows(spark, args.source, args.format)
    # The exploratory and pipeline runs take pandas' missing markers for missing.
    markers = () if args.job in ("train", "score") else PANDAS_NULL_MARKERS
    options = {} if args.source.rstrip("/").endswith(".parquet") else {"null_markers": markers}
    return read_windows(spark, args.source, args.format, **options)


def _stream(spark, args) -> None:
    mapping = {part: getattr(args, part) for part in MAPPING}
    schema = spark.read.parquet(args.source).schema
    events = spark.readStream.schema(schema).parquet(args.source)
    rows = windows_from_event_stream(events, **mapping, time=args.time, delay=args.delay)
    write = merge_stream if args.job == "stream-rollup" and args.merge else write_stream
    if args.job == "stream-score":
        rows = _plain_columns(score_stream(models.load_model(args.model), rows, args.policy))
        write = write_batches
    write(rows, args.output, args.progress, args.once).awaitTermination()


def _plain_columns(scored):
    """Scored rows without the vectors that the model works on."""
    rows = models.positive_probability(scored)
    return rows.select(*[name for name, kind in rows.dtypes if "vector" not in kind])


def main(argv=None) -> None:
    args = _arguments(argv)
    spark = session()
    if args.job == "rollup":
        mapping = {part: getattr(args, part) for part in MAPPING}
        events = spark.read.parquet(args.source)
        rolled_up = windows_from_events(events, **mapping, time=args.time)
        write_windows(rolled_up, args.output, args.whole)
    elif args.job == "close-windows":
        mapping = {part: getattr(args, part) for part in MAPPING}
        events = spark.read.parquet(args.source)
        found = close_windows(
            events, args.output, **mapping, time=args.time, first=args.first, last=args.last
        )
        found.orderBy("date_part").show(1000, truncate=False)
    elif args.job in EVENT_JOBS:
        _stream(spark, args)
    elif args.job == "sql":
        results = run_sql_suite(
            spark, args.source, args.output, args.database, location=args.location
        )
        for table in results.values():
            table.show(truncate=False)
    elif args.job == "explore":
        run_exploration(_read(spark, args), args.output)["report"].show(1000, truncate=False)
    elif args.job == "score":
        scored = models.score_windows(models.load_model(args.model), _read(spark, args), args.policy)
        write_parquet(_plain_columns(scored), args.output)
        stored = spark.read.parquet(args.output)
        stored.selectExpr("count(*) AS rows", "count_if(prediction IS NULL) AS not_scored").show()
    elif args.job == "train":
        trained = run_training(
            _read(spark, args), args.model, args.output, args.split, partitions=args.partitions
        )
        trained.metrics.show()
        trained.confusion.show()
        trained.importances.show(truncate=False)
        trained.discard()
    else:
        tables = run_pipeline(
            spark,
            _read(spark, args),
            args.output,
            args.model,
            args.strict,
            partitions=args.partitions,
        )
        tables["evaluation_report"].show(truncate=False)
        tables["gate"].show()


if __name__ == "__main__":
    main()
