"""Every operator and product as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import known_elevation, ratio
from skyledger.operators.clean import clean_messages
from skyledger.operators.counts import medians_of, merge_counts, value_counts
from skyledger.operators.geography import (
    join_geography,
    one_row_per_code,
    split_codes,
    with_country_code,
)
from skyledger.operators.means import (
    mean_state,
    merge_states,
    merge_weighted,
    merge_wide,
    wide_means,
    wide_state,
    wide_state_columns,
)
from skyledger.operators.ranks import first_rows
from skyledger.plans import learning, products
from skyledger.schemas import CORE_VARIABLES, INVENTORY_FIELDS, STATION_FIELDS, UNKNOWN_ELEVATION
from skyledger.session import materialize, scratch_path
from skyledger.sources import tables, text
from skyledger.sources.files import write_ranges, write_single_csv
from skyledger.sources.messages import read_topic_files
from skyledger.sources.versions import VersionedTable
from skyledger.streaming import runs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The continents and years of the given tables.
CONTINENTS = ("EUROPE", "AMERICA", "ASIA")
AFTER, BEFORE = 1995, 2001
TEMPERATURES = ("TMAX", "TMIN")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def with_year(readings: DataFrame) -> DataFrame:
    return readings.withColumn("year", F.year("obs_date"))


# ---- data products over tables ----

PRODUCTS: dict[str, Callable[[SparkSession, str], products.Product]] = {
    "temp_gap": lambda spark, sf_dir: products.temp_gap(),
    "continent_prcp": lambda spark, sf_dir: products.continent_prcp(
        tables.geography(spark, sf_dir), CONTINENTS, AFTER, BEFORE
    ),
    "elevation_snow": lambda spark, sf_dir: products.elevation_snow(
        tables.stations(spark, sf_dir)
    ),
    "station_var_mean": lambda spark, sf_dir: products.station_var_mean(
        tables.stations(spark, sf_dir), "PRCP"
    ),
    "ml_features": lambda spark, sf_dir: products.ml_features(AFTER),
    "bonus_station_month": lambda spark, sf_dir: products.bonus_station_month(),
}


def _product(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return PRODUCTS[name](spark, sf_dir).compute(tables.readings(spark, sf_dir))

    return run


QUERIES.update({name: _product(name) for name in PRODUCTS})


def _filled(states: DataFrame) -> DataFrame:
    """The state of a variable without readings as (0, 0)."""
    return states.na.fill(0, [c for c in states.columns if c.endswith("_sum")])


@query
def temp_gap_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(PRODUCTS["temp_gap"](spark, sf_dir).partial(tables.readings(spark, sf_dir)))


@query
def elevation_snow_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = products.elevation_snow(tables.stations(spark, sf_dir), None, None, None)
    return _filled(product.merge(product.partial(tables.readings(spark, sf_dir))))


@query
def ml_features_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(PRODUCTS["ml_features"](spark, sf_dir).partial(tables.readings(spark, sf_dir)))


@query
def bonus_daily_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = products.bonus_station_month(daily=True)
    states = _filled(product.partial(tables.readings(spark, sf_dir)))
    return states.withColumn("obs_date", F.col("obs_date").cast("string"))


@query
def monthly_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(products.Ledger().compute(tables.readings(spark, sf_dir)))


def _roll_up(spark: SparkSession, sf_dir: str, ledger: DataFrame) -> DataFrame:
    """All products of one ledger, as rows and a checksum of each."""
    measure = {
        "temp_gap": "gap",
        "continent_prcp": "avg_prcp",
        "elevation_snow": "avg_snow",
        "station_var_mean": "prcp",
        "ml_features": "prcp_avg",
        "bonus_station_month": "snwd_avg",
    }
    parts = [
        PRODUCTS[name](spark, sf_dir)
        .from_ledger(ledger)
        .agg(
            F.lit(name).alias("product"),
            F.count("*").alias("n_rows"),
            F.round(F.sum(column), 4).alias("checksum"),
        )
        for name, column in measure.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _from_ledger(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ledger = materialize(monthly_ledger(spark, sf_dir), "ledger")
        return PRODUCTS[name](spark, sf_dir).from_ledger(ledger)

    return run


# Whole products rolled up from the ledger, every column of them.
QUERIES.update({f"{name}_from_ledger": _from_ledger(name) for name in PRODUCTS})


@query
def products_from_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products from one scan."""
    return _roll_up(spark, sf_dir, materialize(monthly_ledger(spark, sf_dir), "ledger"))


@query
def top_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.top_country(tables.readings(spark, sf_dir), tables.geography(spark, sf_dir))


@query
def temp_gap_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.yearly_extremes(tables.readings(spark, sf_dir))


# ---- sources and sinks ----


def _comparable(readings: DataFrame) -> DataFrame:
    """Engines hand out dates and integers with NULLs as different types."""
    return readings.withColumns(
        {"obs_date": F.col("obs_date").cast("string"), "value": F.col("value").cast("double")}
    )


@query
def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(
        clean_messages(tables.messages_of(tables.table(spark, sf_dir, "lineitem")))
    )


@query
def readings_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land messages by topic, then read back the topics of four countries."""
    messages = tables.messages_of(tables.table(spark, sf_dir, "lineitem"))
    path = scratch_path(spark, "topics")
    landed = messages.withColumn("value", F.col("value").cast("string"))
    landed.write.partitionBy("topic").text(path)
    chosen = clean_messages(read_topic_files(spark, path, "03, 07, 11, 24", report=True))
    return with_country_code(chosen).groupBy(F.col("fips").alias("country")).agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    )


@query
def fixed_width_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stations")
    tables.stations(spark, sf_dir).select(text.fixed_width_line(STATION_FIELDS)).write.text(path)
    return text.read_stations(spark, path)


@query
def fixed_width_altitudes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "altitudes")
    tables.stations(spark, sf_dir).select(text.fixed_width_line(STATION_FIELDS)).write.text(path)
    return text.read_altitudes(spark, path)


@query
def fixed_width_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "inventory")
    tables.inventory(spark, sf_dir).select(text.fixed_width_line(INVENTORY_FIELDS)).write.text(path)
    return text.read_inventory(spark, path)


@query
def stations_like_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations of one country by SQL over a view, for clustering."""
    stations = tables.stations(spark, sf_dir)
    stations = stations.withColumn("elevation", known_elevation(F.col("elevation")))
    stations.createOrReplaceTempView("station_list")
    return spark.sql(
        "SELECT station_id, latitude, longitude, elevation FROM station_list"
        " WHERE station_id LIKE '03%'"
    )


@query
def geo_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geography table through CSV files with and without a header."""
    parts = []
    for header in (True, False):
        path = scratch_path(spark, "geography")
        tables.geography(spark, sf_dir).write.option("header", header).csv(path)
        parts.append(text.read_geography(spark, path, header).withColumn("header", F.lit(header)))
    return parts[0].unionByName(parts[1])


@query
def geo_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that list a country's and its continent's code, taken apart."""
    shared = F.concat(F.lit("R"), F.substring("continent", 1, 1))
    cells = tables.geography(spark, sf_dir).withColumn(
        "fips", F.concat("fips", F.lit(", "), shared, F.lit(","))
    )
    return split_codes(cells).select("fips", "continent", "country")


@query
def geo_unique_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations per country where every code is listed for several continents."""
    geography = tables.geography(spark, sf_dir)
    doubled = geography.unionByName(
        geography.withColumn("continent", F.lit("ELSEWHERE")).withColumn(
            "country", F.concat(F.lit("Z"), "country")
        )
    )
    stations = with_country_code(tables.stations(spark, sf_dir))
    return (
        join_geography(stations.groupBy("fips").count(), one_row_per_code(doubled))
        .select("country", "continent", F.col("count").alias("n_stations"))
    )


@query
def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per continent, range-partitioned into four, read back."""
    path = scratch_path(spark, "continents")
    product = products.continent_prcp(tables.geography(spark, sf_dir), None, AFTER, BEFORE)
    write_ranges(product.compute(tables.readings(spark, sf_dir)), path, "continent", 4)
    return spark.read.parquet(path).select("continent", "year", "avg_prcp")


@query
def single_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_single_csv(QUERIES["temp_gap"](spark, sf_dir), path)
    return spark.read.schema("year INT, gap DOUBLE").option("header", True).csv(path)


# ---- aggregations, limits ----


@query
def continent_year_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly mean precipitation of all continents."""
    product = products.continent_prcp(tables.geography(spark, sf_dir), None, None, None)
    return product.compute(tables.readings(spark, sf_dir)).withColumnRenamed("avg_prcp", "prcp")


@query
def partial_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sum, count) of precipitation per continent and year."""
    rows = with_country_code(with_year(tables.readings(spark, sf_dir)))
    states = mean_state(rows.filter(F.col("variable") == "PRCP"), ["fips", "year"], "value")
    return merge_states(
        join_geography(states, tables.geography(spark, sf_dir)), ["continent", "year"]
    )


def _by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as if each quarter of a year had arrived in one batch."""
    rows = with_year(tables.readings(spark, sf_dir))
    return rows.withColumn("batch", F.quarter("obs_date"))


@query
def merge_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States per batch merged to the means of the whole."""
    states = wide_state(_by_batch(spark, sf_dir), ["batch", "year"], CORE_VARIABLES)
    merged = merge_wide(states, ["year"], CORE_VARIABLES)
    return wide_means(merged, ["year"], {v: f"{v.lower()}_avg" for v in CORE_VARIABLES})


@query
def weighted_mean_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means per batch merged by their weights."""
    rows = _by_batch(spark, sf_dir).filter(F.col("variable") == "PRCP")
    means = mean_state(rows, ["batch", "year"], "value").withColumn(
        "mean", ratio(F.col("total"), F.col("n"))
    )
    merged = merge_weighted(means, ["year"], "mean", "n")
    return merged.select("year", F.round("mean", 6).alias("mean"), "n")


@query
def pivot_sum_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_state(with_year(tables.readings(spark, sf_dir)), ["year"], CORE_VARIABLES)


@query
def pivot_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variables as columns of mean and count, from the same wide state."""
    states = wide_state(with_year(tables.readings(spark, sf_dir)), ["year"], TEMPERATURES)
    return states.select(
        "year",
        *[ratio(F.col(f"{v}_sum"), F.col(f"{v}_count")).alias(f"{v}_avg") for v in TEMPERATURES],
        *[F.col(f"{v}_count") for v in TEMPERATURES],
    )


@query
def distinct_continents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continents that have precipitation readings."""
    rows = tables.readings(spark, sf_dir).filter(F.col("variable") == "PRCP")
    codes = with_country_code(rows).select("fips").distinct()
    return join_geography(codes, tables.geography(spark, sf_dir)).select("continent").distinct()


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.readings(spark, sf_dir).agg(F.count("*").alias("n_rows"))


@query
def ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly mean of the first 5000 precipitation readings by date."""
    rows = tables.readings(spark, sf_dir).filter(
        (F.col("variable") == "PRCP") & F.col("value").isNotNull()
    )
    first = first_rows(rows, 5000, "obs_date", "station_id", "value")
    return with_year(first).groupBy("year").agg(
        F.avg("value").alias("prcp"),
        F.sum("value").alias("total"),
        F.count("*").alias("n"),
        F.max("obs_date").cast("string").alias("last_date"),
    )


# ---- streams ----

# The registered streams read their table in so many micro-batches.
STREAM_BATCHES = 3

#: Rows of a landed file, about.
LANDED_ROWS = 500_000


def _landed_files(lines: DataFrame, least: int, batches: int = STREAM_BATCHES) -> int:
    """Files of each of ``batches``, ``least`` at least, so that none has many more than ``LANDED_ROWS``."""
    return max(least, -(-lines.count() // (batches * LANDED_ROWS)))


def _lines(spark: SparkSession, sf_dir: str, batches: int = STREAM_BATCHES) -> DataFrame:
    """``lineitem`` landed in as many files as its scan has tasks, as a stream of ``batches``.

    There are more where these would have more than ``LANDED_ROWS``. The number of files is rounded up to a multiple of ``batches``, so that each
    micro-batch has equally many.
    """
    folder = scratch_path(spark, "landed")
    lines = tables.table(spark, sf_dir, "lineitem")
    each = _landed_files(lines, max(1, -(-lines.rdd.getNumPartitions() // batches)), batches)
    lines.repartition(batches * each).write.parquet(f"{folder}/lineitem.parquet")
    return tables.table_stream(spark, folder, "lineitem", each)


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.readings_of(_lines(spark, sf_dir))


def _stream_product(name: str) -> Query:
    """A product from partial states of micro-batches."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        product = PRODUCTS[name](spark, sf_dir)
        path, checkpoint = scratch_path(spark, "partials"), scratch_path(spark, "checkpoint")
        return runs.run(product, _stream(spark, sf_dir), path, checkpoint)

    return run


@query
def stream_partials_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features from partial states, with the number of micro-batches that made them."""
    product = PRODUCTS["ml_features"](spark, sf_dir)
    path, checkpoint = scratch_path(spark, "partials"), scratch_path(spark, "checkpoint")
    merged = runs.run(product, _stream(spark, sf_dir), path, checkpoint)
    batches = runs.read_partials(spark, path).filter("batch_id >= 0")
    n = batches.agg(F.count_distinct("batch_id")).first()[0]
    return merged.withColumn("n_batches", F.lit(n).cast("bigint"))


QUERIES.update(
    stream_continent_prcp=_stream_product("continent_prcp"),
    stream_elevation_snow=_stream_product("elevation_snow"),
    stream_bonus_station_month=_stream_product("bonus_station_month"),
)


@query
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products from one stream."""
    path, checkpoint = scratch_path(spark, "partials"), scratch_path(spark, "checkpoint")
    ledger = runs.run(products.Ledger(), _stream(spark, sf_dir), path, checkpoint)
    return _roll_up(spark, sf_dir, materialize(ledger, "ledger"))


@query
def stream_country_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One variable of one country by elevation: the parameters are a closure."""
    country, variable = "03", "TMAX"
    rows = with_country_code(_stream(spark, sf_dir)).filter(F.col("fips") == country)
    product = products.station_var_mean(tables.stations(spark, sf_dir), variable)
    path, checkpoint = scratch_path(spark, "partials"), scratch_path(spark, "checkpoint")
    return runs.run(product, rows, path, checkpoint)


@query
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clean")
    rows = clean_messages(tables.messages_of(_lines(spark, sf_dir)))
    runs.run_append(rows, path, scratch_path(spark, "checkpoint"))
    return _comparable(spark.read.schema(rows.schema).parquet(path))


@query
def stream_temp_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temperature gap from Spark's state store: one state per year."""
    rows = with_year(_stream(spark, sf_dir)).filter(F.col("variable").isin(*TEMPERATURES))
    states = rows.groupBy("year").agg(*wide_state_columns(TEMPERATURES))
    path = scratch_path(spark, "complete")
    runs.run_complete(states, path, scratch_path(spark, "checkpoint"), partitions=2)
    return products.temp_gap().present(runs.read_latest(spark, path, states.schema))


@query
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream joined with the geography table.

    The state store reduces it to a row per country and year first, so the join
    moves no readings, whatever the share of one country.
    """
    rows = with_country_code(with_year(_stream(spark, sf_dir))).filter(F.col("variable") == "PRCP")
    states = rows.groupBy("fips", "year").agg(*wide_state_columns(["PRCP"]))
    joined = join_geography(states, tables.geography(spark, sf_dir))
    path = scratch_path(spark, "complete")
    runs.run_complete(joined, path, scratch_path(spark, "checkpoint"), partitions=4)
    keys = ["continent", "year"]
    merged = merge_wide(runs.read_latest(spark, path, joined.schema), keys, ["PRCP"])
    return wide_means(merged, keys, {"PRCP": "avg_prcp"})


@query
def stream_update_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temperature gap in update mode: a batch hands over the years that it changes."""
    rows = with_year(_stream(spark, sf_dir)).filter(F.col("variable").isin(*TEMPERATURES))
    states = rows.groupBy("year").agg(*wide_state_columns(TEMPERATURES))
    path, checkpoint = scratch_path(spark, "update"), scratch_path(spark, "checkpoint")
    table = runs.run_update(states, ["year"], path, checkpoint, partitions=2)
    n = F.lit(table.snapshot().high + 1).cast("bigint")
    return products.temp_gap().present(table.read()).withColumn("n_batches", n)


@query
def stream_merged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features from partial states that are merged between the micro-batches."""
    product = PRODUCTS["ml_features"](spark, sf_dir)
    path, checkpoint = scratch_path(spark, "merged"), scratch_path(spark, "checkpoint")
    return product.finish(runs.run_merged(product, _stream(spark, sf_dir), path, checkpoint, fan=2).read())


@query
def stream_grouped_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians per country and variable from the value counts of micro-batches."""
    rows = with_country_code(_stream(spark, sf_dir)).filter(F.col("variable").isin(*CORE_VARIABLES))
    keys = ["fips", "variable"]
    path, checkpoint = scratch_path(spark, "counts"), scratch_path(spark, "checkpoint")
    table = runs.run_states(
        rows, lambda batch: value_counts(batch, keys), lambda c: merge_counts(c, keys), path, checkpoint
    )
    return medians_of(table.read(), keys)


@query
def stream_changing_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TMAX by elevation while stations move up by 40 metres before each further batch."""
    given = tables.stations(spark, sf_dir)
    dimension = VersionedTable(spark, scratch_path(spark, "stations"))
    folder, path = scratch_path(spark, "landed"), scratch_path(spark, "as_of")
    checkpoint = scratch_path(spark, "checkpoint")
    lines = tables.table(spark, sf_dir, "lineitem")
    for i in range(STREAM_BATCHES):
        dimension.publish(given.withColumn("elevation", F.when(
            F.col("elevation") == UNKNOWN_ELEVATION, F.col("elevation")
        ).otherwise(F.col("elevation") + 40 * i)))
        due = lines.filter(F.col("l_orderkey") % STREAM_BATCHES == i)
        due.write.mode("append").parquet(f"{folder}/lineitem.parquet")
        found = runs.run_as_of(
            lambda stations: products.station_var_mean(stations, "TMAX"),
            dimension,
            tables.readings_of(tables.table_stream(spark, folder, "lineitem")),
            path,
            checkpoint,
        )
    return found


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of all messages: as counted in the batches, and as written."""
    path = scratch_path(spark, "sorted")
    messages = tables.messages_of(_lines(spark, sf_dir))
    runs.run_sorted(messages, path, scratch_path(spark, "checkpoint"))
    counts = runs.message_counts(spark, path)
    total = counts.agg(*[F.sum(c).alias(f"n_{c}") for c in ("read", *runs.OUTCOMES)])
    rows = spark.read.parquet(f"{path}/messages")
    written = rows.agg(*[
        F.count(F.when(F.col("status") == s, 1)).alias(f"rows_{s}") for s in runs.OUTCOMES
    ])
    return total.crossJoin(written)  # one row each


@query
def stream_bytes_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches bound by bytes: their rows by the progress, and how many are too large."""
    folder = scratch_path(spark, "landed")
    lines = tables.table(spark, sf_dir, "lineitem")
    each = _landed_files(lines, 2)
    lines.repartition(each * STREAM_BATCHES).write.parquet(f"{folder}/lineitem.parquet")
    landed = spark.read.parquet(f"{folder}/lineitem.parquet")
    sizes = landed.select("_metadata.file_path", "_metadata.file_size").distinct()
    bound = each * sizes.agg(F.max("file_size")).first()[0]
    stream = tables.table_stream(spark, folder, "lineitem", bytes_per_trigger=bound)
    stream = stream.select("l_orderkey", "_metadata.file_path", "_metadata.file_size")
    read: list[int] = []

    def write(batch: DataFrame, epoch: int) -> None:
        files = batch.select("file_path", "file_size").distinct()
        read.append(files.agg(F.sum("file_size")).first()[0] or 0)

    progress = runs.run_batches(stream, write, scratch_path(spark, "checkpoint"))
    rows = sum(p.numInputRows for p in progress)
    found = (rows, sum(b > bound for b in read), int(len(read) >= STREAM_BATCHES))
    return spark.createDataFrame([found], "n_rows long, n_over long, is_bound int")


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of a run that is stopped after its first batch, and of one that goes on.

    Both are started by a trigger of time; the second ends when it finds no more input. The
    ledger counts every reading, so each has been processed once.
    """
    rows = _stream(spark, sf_dir)
    path, checkpoint = scratch_path(spark, "merged"), scratch_path(spark, "checkpoint")
    stopped = runs.Cadence(every="0 seconds", batches=1)
    table = runs.run_merged(products.Ledger(), rows, path, checkpoint, stopped)
    if table.snapshot().high != 0:
        raise RuntimeError("the first run has not stopped after its first batch")
    going_on = runs.Cadence(every="0 seconds", until_idle=True)
    return _filled(runs.run_merged(products.Ledger(), rows, path, checkpoint, going_on).read())


@query
def stream_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precipitation in a folder per continent and year; batches write what they change."""
    path, columns = scratch_path(spark, "partitions"), ("continent", "year")
    product = PRODUCTS["continent_prcp"](spark, sf_dir)
    runs.run_partitions(product, _stream(spark, sf_dir), path, scratch_path(spark, "checkpoint"), columns)
    return spark.read.parquet(f"{path}/result").select("continent", "year", "avg_prcp")


@query
def stream_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream ends after a number of rows, in its second batch at 60,000 lines."""
    rows = _stream(spark, sf_dir).limit(25_000)
    path = scratch_path(spark, "limited")
    runs.run_append(rows, path, scratch_path(spark, "checkpoint"))
    return spark.read.schema(rows.schema).parquet(path).agg(F.count("*").alias("n_rows"))


# ---- learning ----

FEATURE_KEYS = ("station_id", "year", "month")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, written once because models read it several times."""
    return materialize(QUERIES["ml_features"](spark, sf_dir), "features")


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query
def complete_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.complete_cases(QUERIES["ml_features"](spark, sf_dir))


@query
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = learning.impute_medians(_features(spark, sf_dir))
    return _rounded(filled, 6, *learning.FEATURES, learning.LABEL)


@query
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = tables.table(spark, sf_dir, "lineitem")
    part = F.when(learning.drawn(0.8, "l_orderkey", "l_linenumber"), "train").otherwise("test")
    return lineitem.groupBy(part.alias("part")).agg(F.count("*").alias("n"))


@query
def random_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a split by chance: rows of both parts together, and keys that are not there once."""
    parts = learning.random_split(tables.table(spark, sf_dir, "orders").select("o_orderkey"), 7)
    counts = parts[0].unionByName(parts[1]).groupBy("o_orderkey").agg(F.count("*").alias("n"))
    off = F.sum(F.when(F.col("n") != 1, 1).otherwise(0))
    return counts.agg(F.sum("n").alias("n_rows"), off.alias("n_off"))


@query
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = learning.complete_cases(_features(spark, sf_dir))
    scaled = learning.standardised_columns(rows, learning.FEATURES).drop(learning.LABEL)
    return _rounded(scaled, 6, *[f"z_{f}" for f in learning.FEATURES])


@query
def linreg_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.table(spark, sf_dir, "lineitem")
    train = learning.drawn(0.8, "l_orderkey", "l_linenumber")
    report = learning.line_report(lines, train, "l_quantity", "l_extendedprice")
    named = report.withColumnRenamed("coef_l_quantity", "slope")
    return _rounded(named, 4, "slope", "intercept", "rmse")


@query
def linreg_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precipitation by snow and temperatures: coefficients and test RMSE."""
    rows = learning.complete_cases(_features(spark, sf_dir))
    report = learning.regression_report(*learning.split(rows, *FEATURE_KEYS))
    return _rounded(report, 6, *report.columns)


def _feature_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows of the feature table in three files, as a stream of as many batches."""
    folder = scratch_path(spark, "landed")
    rows.repartition(STREAM_BATCHES).write.parquet(f"{folder}/features.parquet")
    return tables.table_stream(spark, folder, "features", 1)


@query
def stream_linreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression of ``linreg_multi`` from the moments of micro-batches."""
    rows = _feature_stream(spark, QUERIES["ml_features"](spark, sf_dir))
    train = learning.drawn(0.8, *FEATURE_KEYS)
    path, checkpoint = scratch_path(spark, "moments"), scratch_path(spark, "checkpoint")
    table = runs.run_states(
        rows, lambda batch: learning.moment_state(batch, train), learning.merge_moments, path, checkpoint
    )
    report = learning.regression_from_moments(table.read())
    return _rounded(report, 6, *report.columns)


@query
def stream_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that is fitted, saved, loaded again and scores a stream."""
    train, test = learning.split(_features(spark, sf_dir), *FEATURE_KEYS)
    model, path = scratch_path(spark, "model"), scratch_path(spark, "scored")
    learning.save_model(learning.fit_pipeline(learning.complete_cases(train)), model)
    cases = _feature_stream(spark, learning.complete_cases(test))
    scored = learning.score(learning.load_model(model), cases)
    runs.run_append(scored, path, scratch_path(spark, "checkpoint"))
    rows = spark.read.schema(scored.schema).parquet(path)
    return _rounded(rows.select(*FEATURE_KEYS, "prediction"), 6, "prediction")


@query
def linreg_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = learning.complete_cases(_features(spark, sf_dir))
    train, test = learning.split(rows, *FEATURE_KEYS)
    predicted = learning.predict(learning.fit_regression(train), test)
    return _rounded(predicted.select(*FEATURE_KEYS, "prediction"), 6, "prediction")


@query
def kmeans_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten clusters of the stations by scaled position, from centers far apart."""
    rows = materialize(learning.complete_cases(_known_positions(spark, sf_dir)), "positions")
    _, clustered = learning.settled_clusters(rows)
    return clustered.select("station_id", "cluster")


@query
def kmeans_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What K-means must hold to: every station with the nearest of the model's own centres."""
    rows = learning.complete_cases(_known_positions(spark, sf_dir))
    model, clustered = learning.fit_clusters(rows)
    scaled = clustered.withColumn("z", vector_to_array("zfeatures"))
    names = [f"z_{f}" for f in learning.POSITION]
    scaled = scaled.withColumns({n: F.col("z")[i] for i, n in enumerate(names)})
    nearest = learning.nearest_center(scaled, names, model.clusterCenters())
    table = learning.cluster_table(model)
    sizes = table.agg(F.sum("size")).first()[0]
    return scaled.agg(
        F.count("*").alias("n_stations"),
        F.lit(sizes).cast("bigint").alias("n_in_clusters"),
        F.lit(len(model.clusterCenters())).cast("bigint").alias("n_centers"),
        F.sum(F.when(nearest == F.col("cluster"), 1).otherwise(0)).alias("n_nearest"),
    )


@query
def nearest_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every station with the nearest of four given centers."""
    rows = learning.complete_cases(_known_positions(spark, sf_dir))
    centers = [(0, 0, 100), (45, 90, 600), (-45, -90, 1200), (30, -120, 1800)]
    cluster = learning.nearest_center(rows, learning.POSITION, centers)
    return rows.select("station_id", cluster.alias("cluster"))


def _known_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stations(spark, sf_dir).select(
        "station_id",
        "latitude",
        "longitude",
        known_elevation(F.col("elevation")).alias("elevation"),
    )
