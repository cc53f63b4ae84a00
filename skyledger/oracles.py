"""The queries of the registry in plain SQL over the same tables."""

from __future__ import annotations

BASE = """
WITH raw AS (
  SELECT lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') || to_hex(l_suppkey + 4294967296) AS station_id,
         CAST(l_shipdate AS DATE) AS obs_date,
         CASE l_linenumber WHEN 1 THEN 'TMAX' WHEN 2 THEN 'TMIN' WHEN 3 THEN 'PRCP' WHEN 4 THEN 'SNOW'
                           WHEN 5 THEN 'SNWD' WHEN 6 THEN 'PRCP' WHEN 7 THEN 'WSF2' END AS variable,
         CASE WHEN l_tax > 0 THEN CAST(l_quantity AS INTEGER) * 3 END AS value,
         CASE WHEN l_discount = 0 THEN 'X' END AS q_flag
  FROM lineitem),
readings AS (
  SELECT station_id, substr(station_id, 1, 2) AS fips, obs_date,
         CAST(year(obs_date) AS INTEGER) AS year, CAST(month(obs_date) AS INTEGER) AS month,
         variable, value
  FROM raw WHERE q_flag IS NULL),
geo AS (
  SELECT lpad(CAST(n_nationkey % 25 AS VARCHAR), 2, '0') AS fips, r_name AS continent, n_name AS country
  FROM nation JOIN region ON n_regionkey = r_regionkey),
stations AS (
  SELECT lpad(CAST(s_suppkey % 25 AS VARCHAR), 2, '0') || to_hex(s_suppkey + 4294967296) AS station_id,
         round((s_suppkey * 7919 % 180000) / 1000 - 90, 3) AS latitude,
         round((s_suppkey * 104729 % 360000) / 1000 - 180, 3) AS longitude,
         CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(floor(s_acctbal / 200) * 40 AS DOUBLE) END AS elevation,
         lpad(CAST(s_nationkey % 25 AS VARCHAR), 2, '0') AS state,
         s_name AS name,
         CASE WHEN s_acctbal > 5000 THEN 'GSN' END AS gsn_flag,
         CAST(NULL AS VARCHAR) AS hcn_crn_flag,
         lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS wmo_id
  FROM supplier),
features AS (
  SELECT station_id, year, month,
         avg(CASE WHEN variable = 'SNOW' THEN value END) AS snow_avg,
         avg(CASE WHEN variable = 'TMAX' THEN value END) AS tmax_avg,
         avg(CASE WHEN variable = 'TMIN' THEN value END) AS tmin_avg,
         avg(CASE WHEN variable = 'PRCP' THEN value END) AS prcp_avg
  FROM readings
  WHERE variable IN ('SNOW', 'TMAX', 'TMIN', 'PRCP') AND month IN (1, 2) AND year > 1995
  GROUP BY 1, 2, 3),
complete AS (
  SELECT * FROM features
  WHERE snow_avg IS NOT NULL AND tmax_avg IS NOT NULL AND tmin_avg IS NOT NULL AND prcp_avg IS NOT NULL)
"""


def _train(*keys: str) -> str:
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5({text}) < 'cccccccd'"


def _mean(variable: str) -> str:
    return f"avg(CASE WHEN variable = '{variable}' THEN value END)"


def _state(variable: str) -> str:
    value = f"CASE WHEN variable = '{variable}' THEN value END"
    return f"CAST(sum({value}) AS BIGINT) AS {variable}_sum, count({value}) AS {variable}_count"


def _filled_state(variable: str) -> str:
    value = f"CASE WHEN variable = '{variable}' THEN value END"
    return (
        f"CAST(coalesce(sum({value}), 0) AS BIGINT) AS {variable}_sum,"
        f" count({value}) AS {variable}_count"
    )


def _page(variable: str) -> str:
    rows = f"count(CASE WHEN variable = '{variable}' THEN 1 END) AS {variable}_rows"
    return f"{_filled_state(variable)}, {rows}"


CORE = ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")
_CORE_LIST = "('PRCP', 'SNOW', 'SNWD', 'TMAX', 'TMIN')"

TEMP_GAP = f"""
  SELECT year, {_mean('TMAX')} - {_mean('TMIN')} AS gap
  FROM readings WHERE variable IN ('TMAX', 'TMIN') GROUP BY year"""

CONTINENT_PRCP = """
  SELECT continent, year, avg(value) AS avg_prcp
  FROM readings JOIN geo USING (fips)
  WHERE variable = 'PRCP' AND continent IN ('EUROPE', 'AMERICA', 'ASIA') AND year > 1995 AND year < 2001
  GROUP BY continent, year"""

ELEVATION_SNOW = """
  SELECT elevation, avg(value) AS avg_snow
  FROM readings JOIN stations USING (station_id)
  WHERE variable = 'SNOW' AND month = 1 AND elevation >= 0 AND elevation < 1850
  GROUP BY elevation HAVING avg(value) < 82"""

STATION_PRCP = """
  SELECT elevation, avg(value) AS prcp, count(value) AS prcp_count
  FROM readings JOIN stations USING (station_id)
  WHERE variable = 'PRCP' AND elevation IS NOT NULL GROUP BY elevation"""

BONUS = f"""
  SELECT station_id, month, {', '.join(f'{_mean(v)} AS {v.lower()}_avg' for v in CORE)}
  FROM readings WHERE variable IN {_CORE_LIST} AND month IN (1, 2) GROUP BY station_id, month"""

FEATURES = "SELECT * FROM features"

CLEAN = """
  SELECT station_id, CAST(obs_date AS VARCHAR) AS obs_date, variable, CAST(value AS DOUBLE) AS value
  FROM readings"""

CONTINENT_YEAR = """
  SELECT continent, year, {columns}
  FROM readings JOIN geo USING (fips) WHERE variable = 'PRCP' {where} GROUP BY continent, year"""

# Least squares in closed form: the normal equations of three centred features
# by Cramer's rule.
REGRESSION = f"""
, parts AS (SELECT *, {_train('station_id', 'year', 'month')} AS train FROM complete),
moments AS (
  SELECT covar_samp(snow_avg, snow_avg) AS aa, covar_samp(snow_avg, tmax_avg) AS ab,
         covar_samp(snow_avg, tmin_avg) AS ac, covar_samp(tmax_avg, tmax_avg) AS bb,
         covar_samp(tmax_avg, tmin_avg) AS bc, covar_samp(tmin_avg, tmin_avg) AS cc,
         covar_samp(snow_avg, prcp_avg) AS ay, covar_samp(tmax_avg, prcp_avg) AS bp,
         covar_samp(tmin_avg, prcp_avg) AS cy,
         avg(snow_avg) AS am, avg(tmax_avg) AS bm, avg(tmin_avg) AS cm, avg(prcp_avg) AS ym
  FROM parts WHERE train),
solved AS (
  SELECT (ay * (bb * cc - bc * bc) - ab * (bp * cc - bc * cy) + ac * (bp * bc - bb * cy)) / det AS s,
         (aa * (bp * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - bp * ac)) / det AS x,
         (aa * (bb * cy - bp * bc) - ab * (ab * cy - bp * ac) + ay * (ab * bc - bb * ac)) / det AS n,
         am, bm, cm, ym
  FROM (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det
        FROM moments)),
model AS (SELECT s, x, n, ym - s * am - x * bm - n * cm AS c FROM solved),
predicted AS (
  SELECT station_id, year, month, prcp_avg, c + s * snow_avg + x * tmax_avg + n * tmin_avg AS prediction
  FROM parts, model WHERE NOT train)
"""


def _distance(center: tuple[float, float, float]) -> str:
    axes = zip(("latitude", "longitude", "elevation"), center)
    return " + ".join(f"({a} - ({c})) * ({a} - ({c}))" for a, c in axes)


_CENTERS = [(0, 0, 100), (45, 90, 600), (-45, -90, 1200), (30, -120, 1800)]


def _checksum(name: str, body: str, measure: str) -> str:
    return (
        f"SELECT '{name}' AS product, count(*) AS n_rows, round(sum({measure}), 4) AS checksum"
        f" FROM ({body}) AS t_{name}"
    )


CHECKSUMS = " UNION ALL ".join(
    [
        _checksum("temp_gap", TEMP_GAP, "gap"),
        _checksum("continent_prcp", CONTINENT_PRCP, "avg_prcp"),
        _checksum("elevation_snow", ELEVATION_SNOW, "avg_snow"),
        _checksum("station_var_mean", STATION_PRCP, "prcp"),
        _checksum("ml_features", FEATURES, "prcp_avg"),
        _checksum("bonus_station_month", BONUS, "snwd_avg"),
    ]
)

_QUERIES = {
    "temp_gap": TEMP_GAP,
    "continent_prcp": CONTINENT_PRCP,
    "elevation_snow": ELEVATION_SNOW,
    "station_var_mean": STATION_PRCP,
    "ml_features": FEATURES,
    "bonus_station_month": BONUS,
    "temp_gap_state": f"""
  SELECT year, {_filled_state('TMAX')}, {_filled_state('TMIN')}
  FROM readings WHERE variable IN ('TMAX', 'TMIN') GROUP BY year""",
    "elevation_snow_state": f"""
  SELECT elevation, {_filled_state('SNOW')} FROM readings JOIN stations USING (station_id)
  WHERE variable = 'SNOW' AND month = 1 AND elevation IS NOT NULL GROUP BY elevation""",
    "ml_features_state": f"""
  SELECT station_id, year, month, {', '.join(_filled_state(v) for v in ('SNOW', 'TMAX', 'TMIN', 'PRCP'))}
  FROM readings
  WHERE variable IN ('SNOW', 'TMAX', 'TMIN', 'PRCP') AND month IN (1, 2) AND year > 1995
  GROUP BY station_id, year, month""",
    "bonus_daily_state": f"""
  SELECT station_id, CAST(obs_date AS VARCHAR) AS obs_date, {', '.join(_filled_state(v) for v in CORE)}
  FROM readings WHERE variable IN {_CORE_LIST} AND month IN (1, 2) GROUP BY station_id, obs_date""",
    "monthly_ledger": f"""
  SELECT station_id, year, month, {', '.join(_page(v) for v in CORE)}
  FROM readings WHERE variable IN {_CORE_LIST} GROUP BY station_id, year, month""",
    "temp_gap_from_ledger": TEMP_GAP,
    "continent_prcp_from_ledger": CONTINENT_PRCP,
    "elevation_snow_from_ledger": ELEVATION_SNOW,
    "station_var_mean_from_ledger": STATION_PRCP,
    "ml_features_from_ledger": FEATURES,
    "bonus_station_month_from_ledger": BONUS,
    "products_from_ledger": CHECKSUMS,
    "stream_ledger": CHECKSUMS,
    "top_country": """
  SELECT country, avg(value) AS mean FROM readings JOIN geo USING (fips)
  WHERE variable = 'PRCP' GROUP BY country ORDER BY mean DESC, country LIMIT 1""",
    "temp_gap_extremes": f"""
  SELECT * FROM (
    SELECT year, max(CASE WHEN variable = 'TMAX' THEN value END) AS max_tmax,
           min(CASE WHEN variable = 'TMIN' THEN value END) AS min_tmin,
           {_mean('TMAX')} - {_mean('TMIN')} AS gap
    FROM readings WHERE variable IN ('TMAX', 'TMIN') GROUP BY year)
  WHERE max_tmax IS NOT NULL AND min_tmin IS NOT NULL""",
    "clean_readings": CLEAN,
    "readings_by_country": """
  SELECT fips AS country, count(*) AS n, CAST(sum(value) AS BIGINT) AS total
  FROM readings WHERE fips IN ('03', '07', '11', '24') GROUP BY fips""",
    "fixed_width_stations": "SELECT * FROM stations",
    "fixed_width_altitudes": "SELECT station_id, coalesce(elevation, -999.9) AS altitude FROM stations",
    "fixed_width_inventory": """
  SELECT station_id, latitude, longitude, variable,
         CAST(min(year) AS BIGINT) AS first_year, CAST(max(year) AS BIGINT) AS last_year
  FROM readings JOIN stations USING (station_id)
  GROUP BY station_id, latitude, longitude, variable""",
    "stations_like_prefix": """
  SELECT station_id, latitude, longitude, elevation FROM stations WHERE station_id LIKE '03%'""",
    "geo_csv": "SELECT *, true AS header FROM geo UNION ALL SELECT *, false AS header FROM geo",
    "geo_codes": """
  SELECT fips, continent, country FROM geo
  UNION ALL SELECT 'R' || substr(continent, 1, 1) AS fips, continent, country FROM geo""",
    "geo_unique_codes": """
  SELECT country, continent, count(*) AS n_stations
  FROM stations JOIN geo ON substr(station_id, 1, 2) = fips GROUP BY country, continent""",
    "partitioned_sink": CONTINENT_YEAR.format(
        columns="avg(value) AS avg_prcp", where="AND year > 1995 AND year < 2001"
    ),
    "single_csv": TEMP_GAP,
    "continent_year_mean": CONTINENT_YEAR.format(columns="avg(value) AS prcp", where=""),
    "partial_state": CONTINENT_YEAR.format(
        columns="CAST(sum(value) AS BIGINT) AS total, count(value) AS n", where=""
    ),
    "merge_partials": f"""
  SELECT year, {', '.join(f'{_mean(v)} AS {v.lower()}_avg' for v in CORE)}
  FROM readings WHERE variable IN {_CORE_LIST} GROUP BY year""",
    "weighted_mean_merge": """
  SELECT year, round(avg(value), 6) AS mean, count(value) AS n
  FROM readings WHERE variable = 'PRCP' GROUP BY year""",
    "pivot_sum_count": f"""
  SELECT year, {', '.join(_state(v) for v in CORE)}
  FROM readings WHERE variable IN {_CORE_LIST} GROUP BY year""",
    "pivot_avg": f"""
  SELECT year, {_mean('TMAX')} AS TMAX_avg, {_mean('TMIN')} AS TMIN_avg,
         count(CASE WHEN variable = 'TMAX' THEN value END) AS TMAX_count,
         count(CASE WHEN variable = 'TMIN' THEN value END) AS TMIN_count
  FROM readings WHERE variable IN ('TMAX', 'TMIN') GROUP BY year""",
    "distinct_continents": """
  SELECT DISTINCT continent FROM readings JOIN geo USING (fips) WHERE variable = 'PRCP'""",
    "row_count": "SELECT count(*) AS n_rows FROM readings",
    "ordered_limit": """
  SELECT year, avg(value) AS prcp, CAST(sum(value) AS BIGINT) AS total, count(*) AS n,
         CAST(max(obs_date) AS VARCHAR) AS last_date
  FROM (SELECT * FROM readings WHERE variable = 'PRCP' AND value IS NOT NULL
        ORDER BY obs_date, station_id, value LIMIT 5000)
  GROUP BY year""",
    "stream_partials_merge": "SELECT *, CAST(3 AS BIGINT) AS n_batches FROM features",
    "stream_continent_prcp": CONTINENT_PRCP,
    "stream_elevation_snow": ELEVATION_SNOW,
    "stream_bonus_station_month": BONUS,
    "stream_country_variable": """
  SELECT elevation, avg(value) AS tmax, count(value) AS tmax_count
  FROM readings JOIN stations USING (station_id)
  WHERE variable = 'TMAX' AND fips = '03' AND elevation IS NOT NULL GROUP BY elevation""",
    "stream_clean": CLEAN,
    "stream_temp_gap": TEMP_GAP,
    "stream_static_join": CONTINENT_YEAR.format(columns="avg(value) AS avg_prcp", where=""),
    "stream_limit": "SELECT count(*) AS n_rows FROM (SELECT * FROM readings LIMIT 25000)",
    "complete_cases": "SELECT * FROM complete",
    "median_impute": """
  SELECT station_id, year, month,
         round(coalesce(snow_avg, (SELECT median(snow_avg) FROM features)), 6) AS snow_avg,
         round(coalesce(tmax_avg, (SELECT median(tmax_avg) FROM features)), 6) AS tmax_avg,
         round(coalesce(tmin_avg, (SELECT median(tmin_avg) FROM features)), 6) AS tmin_avg,
         round(prcp_avg, 6) AS prcp_avg
  FROM features WHERE prcp_avg IS NOT NULL""",
    "split_sizes": f"""
  SELECT CASE WHEN {_train('l_orderkey', 'l_linenumber')} THEN 'train' ELSE 'test' END AS part,
         count(*) AS n
  FROM lineitem GROUP BY 1""",
    "random_split_rows": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off FROM orders",
    "kmeans_assignment": """
  SELECT count(*) AS n_stations, count(*) AS n_in_clusters, CAST(10 AS BIGINT) AS n_centers,
         count(*) AS n_nearest
  FROM stations WHERE elevation IS NOT NULL""",
    "standard_scale": """
  SELECT station_id, year, month,
         round(snow_avg / (SELECT stddev_samp(snow_avg) FROM complete), 6) AS z_snow_avg,
         round(tmax_avg / (SELECT stddev_samp(tmax_avg) FROM complete), 6) AS z_tmax_avg,
         round(tmin_avg / (SELECT stddev_samp(tmin_avg) FROM complete), 6) AS z_tmin_avg
  FROM complete""",
    "linreg_simple": f"""
, parts AS (SELECT *, {_train('l_orderkey', 'l_linenumber')} AS train FROM lineitem),
model AS (
  SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
         regr_intercept(l_extendedprice, l_quantity) AS intercept
  FROM parts WHERE train)
  SELECT round(slope, 4) AS slope, round(intercept, 4) AS intercept,
         round(sqrt(avg(pow(intercept + slope * l_quantity - l_extendedprice, 2))), 4) AS rmse
  FROM parts, model WHERE NOT train GROUP BY slope, intercept""",
    "linreg_multi": REGRESSION
    + """
  SELECT round(c, 6) AS intercept, round(s, 6) AS coef_snow_avg, round(x, 6) AS coef_tmax_avg,
         round(n, 6) AS coef_tmin_avg,
         round((SELECT sqrt(avg(pow(prediction - prcp_avg, 2))) FROM predicted), 6) AS rmse
  FROM model""",
    "linreg_predict": REGRESSION
    + "SELECT station_id, year, month, round(prediction, 6) AS prediction FROM predicted",
    "nearest_center": f"""
  SELECT station_id, cluster FROM (
    SELECT station_id, CASE {' '.join(f'WHEN least(d0, d1, d2, d3) = d{i} THEN {i}' for i in range(4))} END
           AS cluster
    FROM (SELECT station_id, {', '.join(f'{_distance(c)} AS d{i}' for i, c in enumerate(_CENTERS))}
          FROM stations WHERE elevation IS NOT NULL))""",
}

def _clusters(k: int, rounds: int) -> str:
    """K-means unrolled: the farthest position ``k`` times, then rounds of assignment and means."""
    axes = ("latitude", "longitude", "elevation")
    apart = " + ".join(f"(z.{a} - c.{a}) * (z.{a} - c.{a})" for a in axes)
    scaled = ", ".join(f"round({a} / (SELECT stddev_samp({a}) FROM placed), 6) AS {a}" for a in axes)
    columns = ", ".join(axes)
    parts = [
        "placed AS (SELECT * FROM stations WHERE elevation IS NOT NULL)",
        f"z AS MATERIALIZED (SELECT station_id, {scaled} FROM placed)",
        f"c0 AS MATERIALIZED (SELECT 0 AS i, {columns} FROM z ORDER BY station_id LIMIT 1)",
    ]
    for n in range(1, k):
        parts.append(f"""c{n} AS MATERIALIZED (
  SELECT * FROM c{n - 1} UNION ALL SELECT {n}, {columns} FROM (
    SELECT z.station_id, {', '.join(f'any_value(z.{a}) AS {a}' for a in axes)}, min({apart}) AS far
    FROM z, c{n - 1} AS c GROUP BY z.station_id ORDER BY far DESC, z.station_id LIMIT 1))""")
    centers = f"c{k - 1}"
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
  SELECT z.station_id, {', '.join(f'z.{a}' for a in axes)}, c.i AS cluster FROM z, {centers} AS c
  QUALIFY row_number() OVER (PARTITION BY z.station_id ORDER BY {apart}, c.i) = 1)""")
        means = ", ".join(f"coalesce(round(avg(a.{a}), 6), any_value(c.{a})) AS {a}" for a in axes)
        parts.append(f"""m{n} AS MATERIALIZED (
  SELECT c.i, {means} FROM {centers} AS c LEFT JOIN a{n} AS a ON a.cluster = c.i GROUP BY c.i)""")
        centers = f"m{n}"
    return ", " + ", ".join(parts) + f" SELECT station_id, CAST(cluster AS INTEGER) AS cluster FROM a{rounds}"


_QUERIES |= {
    "stream_update_gap": f"SELECT *, CAST(3 AS BIGINT) AS n_batches FROM ({TEMP_GAP})",
    "stream_merged_features": FEATURES,
    "stream_grouped_median": f"""
  SELECT fips, variable, median(value) AS median, count(value) AS n FROM readings
  WHERE variable IN {_CORE_LIST} AND value IS NOT NULL GROUP BY fips, variable""",
    "stream_changing_stations": """
, lines AS (
  SELECT lpad(CAST(l_suppkey % 25 AS VARCHAR), 2, '0') || to_hex(l_suppkey + 4294967296) AS station_id,
         40 * (l_orderkey % 3) AS rise, CASE WHEN l_tax > 0 THEN CAST(l_quantity AS INTEGER) * 3 END AS value
  FROM lineitem WHERE l_linenumber = 1 AND l_discount <> 0)
  SELECT elevation + rise AS elevation, avg(value) AS tmax, count(value) AS tmax_count
  FROM lines JOIN stations USING (station_id) WHERE elevation IS NOT NULL GROUP BY elevation + rise""",
    "stream_quarantine": """
, counted AS (
  SELECT count(*) AS n_lines, count(CASE WHEN q_flag IS NULL THEN 1 END) AS n_kept,
         count(CASE WHEN q_flag IS NOT NULL THEN 1 END) AS n_flagged,
         count(CASE WHEN value IS NULL THEN 1 END) AS n_unparsable
  FROM raw)
  SELECT n_lines + n_unparsable AS n_read, n_kept, n_flagged, n_unparsable,
         n_kept AS rows_kept, n_flagged AS rows_flagged, n_unparsable AS rows_unparsable FROM counted""",
    "stream_bytes_bound": """
  SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_over, CAST(1 AS INTEGER) AS is_bound FROM lineitem""",
    "stream_restart": _QUERIES["monthly_ledger"],
    "stream_partitions": CONTINENT_PRCP,
    "stream_linreg": _QUERIES["linreg_multi"],
    "stream_saved_model": _QUERIES["linreg_predict"],
    "kmeans_stations": _clusters(10, 10),
}

ORACLES = {key: BASE + body for key, body in _QUERIES.items()}
