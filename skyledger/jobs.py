"""Every product, reference table and model as one command.

    python -m skyledger.jobs temp_gap --servers host:9092 --topics EZ \\
        --every "120 seconds" --seconds 7200 --per-trigger 5000000 \\
        --work s3a://shared/temp_gap --jdbc-url jdbc:... --table temp_gap
    python -m skyledger.jobs stations --input s3a://raw/stations.txt --output s3a://shared/stations
    python -m skyledger.jobs regression --input s3a://shared/features --model s3a://shared/model --output ...
    python -m skyledger.jobs score --input s3a://shared/features --model s3a://shared/model --output ...
    python -m skyledger.jobs clusters --input s3a://shared/stations --prefix CA --output ...

Tables are Parquet folders, or SQL tables with ``--jdbc-url`` and ``--input-table``
or ``--table``; user and password come from JDBC_USER and JDBC_PASSWORD.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.clean import clean_messages
from skyledger.plans import learning, products
from skyledger.session import configure, materialize
from skyledger.sources import text
from skyledger.sources.files import write_ranges
from skyledger.sources.jdbc import CONNECTIONS, Split, append_table, overwrite_table, read_table
from skyledger.sources.messages import read_broker, read_topic_files, topic_list
from skyledger.streaming.runs import Cadence, finish_table, run, run_partials_to_table

PRODUCTS = (
    "temp_gap",
    "continent_prcp",
    "elevation_snow",
    "station_var_mean",
    "ml_features",
    "bonus_station_month",
    "ledger",
)
TABLES = ("stations", "inventory", "geography")
MODELS = ("regression", "score", "clusters")


def connection(args: argparse.Namespace) -> dict[str, str]:
    if not args.jdbc_url:
        raise SystemExit("a SQL table needs --jdbc-url")
    options = {"url": args.jdbc_url}
    for name in ("user", "password"):
        if value := os.environ.get(f"JDBC_{name.upper()}"):
            options[name] = value
    return options


def dimension(spark: SparkSession, path: str | None, option: str) -> DataFrame:
    if path is None:
        raise SystemExit(f"this job needs {option}")
    return spark.read.parquet(path)


def product_named(
    spark: SparkSession, args: argparse.Namespace
) -> products.Product | products.Ledger:
    match args.job:
        case "temp_gap":
            return products.temp_gap()
        case "continent_prcp":
            geography = dimension(spark, args.geography, "--geography")
            return products.continent_prcp(geography, **given(args, "continents", "after", "before"))
        case "elevation_snow":
            stations = dimension(spark, args.stations, "--stations")
            bounds = given(args, "low", "high", "below", "months")
            return products.elevation_snow(stations, **bounds)
        case "station_var_mean":
            stations = dimension(spark, args.stations, "--stations")
            return products.station_var_mean(stations, args.variable, **given(args, "months"))
        case "ml_features":
            return products.ml_features(**given(args, "after", "months"))
        case "bonus_station_month":
            return products.bonus_station_month(**given(args, "months"))
    return products.Ledger()


def given(args: argparse.Namespace, *names: str) -> dict:
    """The parameters that the command sets; ``--unbounded`` sets the other bounds to none."""
    values = {n: getattr(args, n) for n in names if getattr(args, n) is not None}
    if args.unbounded:
        bounds = set(names) & {"continents", "after", "before", "low", "high", "below"}
        values = {**dict.fromkeys(bounds), **values}
    return values


def messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    stream = args.mode == "dynamic"
    if args.servers:
        return read_broker(spark, args.servers, args.topics, stream, args.per_trigger)
    return read_topic_files(spark, args.messages, args.topics, stream, args.per_trigger)


def product_result(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """The product; None if the run has only added partial states to a SQL table."""
    product = product_named(spark, args)
    if args.partials and args.merge:
        return finish_table(spark, product, args.partials, connection(args), split(args))
    if args.partials:
        run_partials_to_table(
            product,
            clean_messages(messages(spark, args)),
            args.partials,
            connection(args),
            f"{args.work}/checkpoint",
            args.run_id,
            Cadence(args.every, args.seconds, until_idle=args.until_idle),
            args.connections,
        )
        return None
    return run(
        product,
        clean_messages(messages(spark, args)),
        args.work and f"{args.work}/states",
        args.work and f"{args.work}/checkpoint",
        Cadence(args.every, args.seconds, until_idle=args.until_idle),
        merged=True,
    )


def reference_table(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    match args.job:
        case "stations":
            stations = text.read_stations(spark, args.input)
            if args.prefix:
                return stations.filter(F.col("station_id").startswith(args.prefix))
            return stations
        case "inventory":
            return text.read_inventory(spark, args.input)
    return text.read_geography(spark, args.input, not args.no_header)


def model_result(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.input_table:
        rows = read_table(spark, args.input_table, connection(args), split(args))
    else:
        rows = dimension(spark, args.input, "--input")
    if args.job == "regression":
        path = args.work and f"{args.work}/cases"
        cases = materialize(learning.complete_cases(rows), "cases", path)
        if args.model:
            train, _ = learning.split(cases, *products.LEDGER_KEYS)
            learning.save_model(learning.fit_pipeline(train), args.model)
        return learning.regression_report(*learning.split(cases, *products.LEDGER_KEYS))
    if args.job == "score":
        return learning.score(learning.load_model(args.model), rows)
    if args.prefix:
        rows = rows.filter(F.col("station_id").startswith(args.prefix))
    positions = learning.complete_cases(rows.select("station_id", *learning.POSITION))
    model, clustered = learning.fit_clusters(positions, args.k)
    if args.summary:
        learning.cluster_table(model).write.mode("overwrite").parquet(args.summary)
    return clustered.select("station_id", *learning.POSITION, "cluster")


def publish(df: DataFrame, args: argparse.Namespace) -> None:
    if args.output:
        if args.partition_by:
            write_ranges(df, args.output, args.partition_by, args.ranges)
        else:
            df.write.mode("overwrite").parquet(args.output)
        return
    write = overwrite_table if args.overwrite else append_table
    write(df, args.table or args.job, connection(args), args.connections)


def texts(value: str) -> tuple[str, ...]:
    return tuple(topic_list(value))


def numbers(value: str) -> tuple[int, ...]:
    return tuple(int(n) for n in topic_list(value))


def split(args: argparse.Namespace) -> Split | None:
    if not args.split_column:
        return None
    return Split(args.split_column, args.split_lower, args.split_upper, args.split_parts)


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="skyledger.jobs")
    parser.add_argument("job", choices=(*PRODUCTS, *TABLES, *MODELS))
    source = parser.add_argument_group("source of a product")
    source.add_argument("--servers", help="message broker")
    source.add_argument("--messages", help="folder of topic=<name> text files")
    source.add_argument("--topics", help='such as "EZ, US"')
    source.add_argument("--mode", choices=("static", "dynamic"), default="dynamic")
    source.add_argument("--every", help="trigger interval; without it, what is there now")
    source.add_argument("--seconds", type=int, help="how long the stream runs")
    source.add_argument("--until-idle", action="store_true", help="end as soon as no input is left")
    source.add_argument("--per-trigger", type=int, help="messages or files per micro-batch")
    source.add_argument("--work", help="shared folder for states and checkpoint")
    source.add_argument("--stations")
    source.add_argument("--geography")
    source.add_argument("--variable", default="PRCP")
    bounds = parser.add_argument_group("parameters of a product; the published ones by default")
    bounds.add_argument("--continents", type=texts, help='such as "Europe, Asia"')
    bounds.add_argument("--after", type=int, help="years after this one")
    bounds.add_argument("--before", type=int, help="years before this one")
    bounds.add_argument("--low", type=float, help="lowest elevation")
    bounds.add_argument("--high", type=float, help="elevations below this one")
    bounds.add_argument("--below", type=float, help="means below this one")
    bounds.add_argument("--months", type=numbers, help='such as "1, 2"')
    bounds.add_argument("--unbounded", action="store_true", help="no bounds but those given")
    partial = parser.add_argument_group("partial states of micro-batches in a SQL table")
    partial.add_argument("--partials", help="the table; without --merge, a run adds to it")
    partial.add_argument("--run-id", help="the same for a replay, a new one for another input")
    partial.add_argument("--merge", action="store_true", help="make the product of the table")
    other = parser.add_argument_group("source of a table or model")
    other.add_argument("--input")
    other.add_argument("--input-table")
    other.add_argument("--no-header", action="store_true")
    other.add_argument("--prefix", help="keep the stations whose id starts like this")
    other.add_argument("--k", type=int, default=10, help="number of clusters")
    other.add_argument("--model", help="folder of a regression: kept by regression, used by score")
    other.add_argument("--summary", help="folder for centres, sizes and cost of the clusters")
    sql = parser.add_argument_group("reading and writing a SQL table")
    sql.add_argument("--split-column", help="read ranges of this column in parallel")
    sql.add_argument("--split-lower")
    sql.add_argument("--split-upper")
    sql.add_argument("--split-parts", type=int, default=CONNECTIONS)
    sql.add_argument("--connections", type=int, default=CONNECTIONS, help="of a write")
    sink = parser.add_argument_group("sink")
    sink.add_argument("--output")
    sink.add_argument("--jdbc-url")
    sink.add_argument("--table")
    sink.add_argument("--overwrite", action="store_true", help="replace the SQL table")
    sink.add_argument("--partition-by", help="a folder per value of this column in --output")
    sink.add_argument("--ranges", type=int, default=4, help="tasks that write the folders")
    args = parser.parse_args(argv)
    if args.split_column and not (args.split_lower and args.split_upper):
        parser.error("--split-column needs --split-lower and --split-upper")
    if args.partials and not (args.jdbc_url and (args.merge or (args.run_id and args.work))):
        parser.error("--partials needs --jdbc-url, and --run-id and --work or --merge")
    if args.partials and args.job not in PRODUCTS[:-1]:
        parser.error("--partials needs a product other than the ledger")
    if args.job == "score" and not args.model:
        parser.error("score needs --model")
    if not (args.output or args.jdbc_url):
        parser.error("--output or --jdbc-url is needed")
    if args.partials and args.merge:
        return args
    if args.job in PRODUCTS:
        if not args.topics or bool(args.servers) == bool(args.messages):
            parser.error("a product needs --topics and one of --servers and --messages")
        if args.mode == "dynamic" and not args.work:
            parser.error("a stream needs --work")
    elif not (args.input or (args.input_table and args.job in MODELS)):
        parser.error("--input is needed")
    return args


def execute(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job in PRODUCTS:
        result = product_result(spark, args)
    elif args.job in TABLES:
        result = reference_table(spark, args)
    else:
        result = model_result(spark, args)
    if result is not None:
        publish(result, args)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = configure(SparkSession.builder.appName(f"skyledger-{args.job}")).getOrCreate()
    execute(spark, args)


if __name__ == "__main__":
    main()
