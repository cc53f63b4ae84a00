"""A star schema of sales seen as weather data.

Lines of ``lineitem`` are readings and suppliers are stations. A reading is a
projection of its line: it carries its station id, whose first two characters
are the country code, so no join is needed to make one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.columns import country_code
from skyledger.schemas import UNKNOWN_ELEVATION

COUNTRIES = 25

# The variable a line stands for, by line number.
VARIABLE_OF_LINE = {1: "TMAX", 2: "TMIN", 3: "PRCP", 4: "SNOW", 5: "SNWD", 6: "PRCP", 7: "WSF2"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """The files of a table as a stream; the pattern matches a file or a folder.

    A micro-batch has at most so many files, or so many bytes (but at least one file).
    """
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def country_of(key: Column) -> Column:
    return F.lpad((key % COUNTRIES).cast("string"), 2, "0")


def station_of(key: Column) -> Column:
    """Eleven characters: country code and nine hex digits, the first never 0."""
    return F.concat(country_of(key), F.hex(key + (1 << 32)))


def raw_readings(lineitem: DataFrame) -> DataFrame:
    """Typed readings that still carry their quality flag."""
    variable = F
    for line, name in VARIABLE_OF_LINE.items():
        variable = variable.when(F.col("l_linenumber") == line, name)
    return lineitem.select(
        station_of(F.col("l_suppkey")).alias("station_id"),
        F.col("l_shipdate").cast("date").alias("obs_date"),
        variable.alias("variable"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity").cast("int") * 3).alias("value"),
        F.when(F.col("l_discount") == 0, "X").alias("q_flag"),
    )


def readings_of(lineitem: DataFrame) -> DataFrame:
    return raw_readings(lineitem).filter(F.col("q_flag").isNull()).drop("q_flag")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "lineitem"))


def messages_of(lineitem: DataFrame) -> DataFrame:
    """The same readings as broker messages: bytes by topic.

    Lines without tax come twice, once whole and once cut off, so that every
    tenth message or so is not JSON.
    """
    day = F.year("obs_date") * 10000 + F.month("obs_date") * 100 + F.day("obs_date")
    text = F.to_json(
        F.struct(
            F.col("station_id").alias("StationId"),
            day.alias("Date"),
            F.col("variable").alias("Variable"),
            F.col("value").alias("Value"),
            F.col("q_flag").alias("Q_Flag"),
        )
    )
    texts = F.when(F.col("broken"), F.array("text", F.substring("text", 1, 20))).otherwise(
        F.array("text")
    )
    return (
        raw_readings(lineitem)
        .select(
            country_code(F.col("station_id")).alias("topic"),
            F.col("value").isNull().alias("broken"),
            text.alias("text"),
        )
        .select("topic", F.explode(texts).alias("value"))
        .withColumn("value", F.col("value").cast("binary"))
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine columns of a station list; overdrawn suppliers have no elevation."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        station_of(key).alias("station_id"),
        F.round((key * 7919 % 180000) / 1000 - 90, 3).alias("latitude"),
        F.round((key * 104729 % 360000) / 1000 - 180, 3).alias("longitude"),
        F.when(F.col("s_acctbal") < 0, UNKNOWN_ELEVATION)
        .otherwise(F.floor(F.col("s_acctbal") / 200) * 40)
        .cast("double")
        .alias("elevation"),
        country_of(F.col("s_nationkey")).alias("state"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 5000, "GSN").alias("gsn_flag"),
        F.lit(None).cast("string").alias("hcn_crn_flag"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("wmo_id"),
    )


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        country_of(F.col("n_nationkey")).alias("fips"),
        F.col("r_name").alias("continent"),
        F.col("n_name").alias("country"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last year of every variable of every station."""
    spans = (
        readings(spark, sf_dir)
        .groupBy("station_id", "variable")
        .agg(
            F.year(F.min("obs_date")).cast("bigint").alias("first_year"),
            F.year(F.max("obs_date")).cast("bigint").alias("last_year"),
        )
    )
    places = stations(spark, sf_dir).select("station_id", "latitude", "longitude")
    return spans.join(places, "station_id").select(
        "station_id", "latitude", "longitude", "variable", "first_year", "last_year"
    )
