"""DuckDB SQL for every registered query, for the correctness gate.

The driver tables are pre-registered as views.  The SQL rebuilds the
stand-in views, the cleansing and the model with plain SQL, written the way
the source job computes them (DISTINCT over the joined fact, reports over
the full star join), so the comparison also checks the rewrites of the
Spark plans (inputs de-duplicated before the join, aggregation before the
star join).
"""

from __future__ import annotations

from climastar.plans.catalog import CLUSTERED_CITY, CLUSTERED_YEAR, DELIVERY, VETERAN_MAX_TEMPERATURE, VETERAN_MIN_TEMPERATURE
from climastar.plans.model import FACT_COLUMNS
from climastar.plans.reports import LAPSE_RATE_PER_FT, poisson_steps
from climastar.sources.contracts import constraint_rules
from climastar.sources.standins import STANDIN_COUNTRY

C = STANDIN_COUNTRY


def _int(x: str, t: str = "INTEGER") -> str:
    return f"TRY_CAST(TRUNC(TRY_CAST({x} AS DOUBLE)) AS {t})"


def _hemi(x: str) -> str:
    return (f"TRY_CAST(TRY_CAST(substr({x}, 1, length({x}) - 1) AS FLOAT) * "
            f"CASE WHEN regexp_matches({x}, '[SW]$') THEN -1 ELSE 1 END AS DECIMAL(9,2))")


BASE = f"""
geo AS (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
v_temperature AS (
  SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS dt,
         CASE WHEN o.o_orderstatus = 'P' THEN CAST(NULL AS VARCHAR)
              ELSE CAST(CAST(o.o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS AverageTemperature,
         CAST(CAST(c.c_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS AverageTemperatureUncertainty,
         g.n_name AS City,
         g.r_name AS Country,
         CAST(CAST(abs(c.c_acctbal) AS DECIMAL(9,2)) AS VARCHAR)
           || CASE WHEN c.c_acctbal < 0 THEN 'S' ELSE 'N' END AS Latitude,
         CAST(CAST(abs(c.c_acctbal) AS DECIMAL(9,2)) AS VARCHAR)
           || CASE WHEN c.c_acctbal < 0 THEN 'W' ELSE 'E' END AS Longitude
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey),
v_airport AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS ident,
         CASE WHEN s.s_acctbal < 0 THEN 'heliport' ELSE 'small_airport' END AS "type",
         s.s_name AS "name",
         CAST(CAST(s.s_acctbal AS DECIMAL(9,2)) AS VARCHAR) AS elevation_ft,
         'NA' AS continent,
         g.r_name AS iso_country,
         g.r_name || '-' || CAST(g.n_nationkey AS VARCHAR) AS iso_region,
         g.n_name AS municipality,
         CAST(s.s_suppkey AS VARCHAR) AS gps_code,
         CAST(NULL AS VARCHAR) AS iata_code,
         CAST(s.s_suppkey AS VARCHAR) AS local_code,
         CAST(s.s_suppkey AS VARCHAR) || ', ' || CAST(s.s_nationkey AS VARCHAR) AS coordinates
  FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey),
cust_seg AS (
  SELECT g.n_name, g.r_name, c.c_mktsegment,
         count(*) AS seg_count,
         sum(CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END) AS seg_veterans,
         sum(CASE WHEN c.c_custkey % 2 = 0 THEN 1 ELSE 0 END) AS seg_male,
         sum(CASE WHEN c.c_custkey % 2 = 1 THEN 1 ELSE 0 END) AS seg_female,
         sum(CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS seg_foreign,
         min(c.c_acctbal) AS seg_min,
         max(c.c_acctbal) AS seg_max
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey
  GROUP BY g.n_name, g.r_name, c.c_mktsegment),
v_demographics AS (
  SELECT n_name AS city, r_name AS state,
         min(seg_min) OVER w AS median_age,
         CAST(sum(seg_male) OVER w AS BIGINT) AS male_population,
         CAST(sum(seg_female) OVER w AS BIGINT) AS female_population,
         CAST(sum(seg_count) OVER w AS BIGINT) AS total_population,
         CAST(sum(seg_veterans) OVER w AS BIGINT) AS number_of_veterans,
         CAST(sum(seg_foreign) OVER w AS BIGINT) AS foreign_born,
         max(seg_max) OVER w AS average_household_size,
         substr(r_name, 1, 2) AS state_code,
         c_mktsegment AS race,
         CAST(seg_count AS BIGINT) AS "count"
  FROM cust_seg
  WINDOW w AS (PARTITION BY n_name)),
t_clean AS (
  SELECT {_int("string_split(dt, '-')[1]")} AS year,
         {_int("string_split(dt, '-')[2]")} AS mon,
         TRY_CAST(AverageTemperature AS DOUBLE) AS average_temperature,
         TRY_CAST(AverageTemperatureUncertainty AS DOUBLE) AS average_temperature_uncertainty,
         City AS city,
         Country AS country,
         {_hemi("Latitude")} AS latitude,
         {_hemi("Longitude")} AS longitude
  FROM v_temperature
  WHERE Country = '{C}'
    AND TRY_CAST(AverageTemperature AS DOUBLE) IS NOT NULL
    AND NOT isnan(TRY_CAST(AverageTemperature AS DOUBLE))),
a_clean AS (
  SELECT ident, "type", "name" AS airport_name,
         {_int("elevation_ft")} AS elevation_ft,
         continent, iso_country, iso_region, municipality, gps_code, iata_code, local_code,
         TRY_CAST(string_split(coordinates, ', ')[2] AS DOUBLE) AS latitude,
         TRY_CAST(string_split(coordinates, ', ')[1] AS DOUBLE) AS longitude
  FROM v_airport
  WHERE iso_country = '{C}'),
d_clean AS (
  SELECT city, state,
         TRY_CAST(median_age AS DOUBLE) AS median_age,
         {_int("male_population")} AS male_population,
         {_int("female_population")} AS female_population,
         {_int("total_population")} AS total_population,
         {_int("number_of_veterans")} AS veteran_population,
         {_int("foreign_born")} AS foreign_born,
         TRY_CAST(average_household_size AS DOUBLE) AS ave_household_size,
         state_code, race,
         {_int('"count"')} AS "count"
  FROM v_demographics),
fact0 AS (
  SELECT DISTINCT t.average_temperature, t.average_temperature_uncertainty, t.city, t.country,
         t.year, t.mon, a.ident, a."type", a.elevation_ft, a.continent, a.iso_country,
         a.iso_region, a.gps_code, a.iata_code, a.local_code, d.ave_household_size,
         d."count", d.state, d.state_code, d.total_population
  FROM t_clean t
  JOIN a_clean a ON t.city = a.municipality
  JOIN d_clean d ON t.city = d.city),
dim_airport AS (
  SELECT DISTINCT municipality, elevation_ft, airport_name, iso_country, iso_region,
         latitude, longitude
  FROM a_clean),
dim_demographics AS (
  SELECT DISTINCT city, state, median_age, male_population, female_population,
         total_population, veteran_population, foreign_born, ave_household_size,
         state_code, race, "count"
  FROM d_clean)"""

_STRING_COLUMNS = {"city", "country", "ident", "type", "continent", "iso_country", "iso_region", "gps_code", "iata_code",
                   "local_code", "state", "state_code"}


def _canon(col: str) -> str:
    if col in _STRING_COLUMNS:
        return f"""COALESCE(length("{col}") || ':' || "{col}", '-')"""
    return f"""COALESCE(CAST("{col}" AS VARCHAR), '') || '|'"""


def _key(cols: list[str]) -> str:
    return "substr(sha256(" + " || ".join(_canon(c) for c in cols) + "), 1, 32)"


FACT = f"fact AS (SELECT *, {_key(FACT_COLUMNS)} AS id FROM fact0)"


def _report_cte(attribute: str) -> str:
    return f"""report AS (
  SELECT f.city,
         -- favg: compensated summation; the star join repeats each fact row
         -- |D|*|A| times, and a plain sum over ~10^8 rows per city drifts
         -- into the sixth decimal
         round(favg(f.average_temperature), 6) AS average_temperature,
         first(d.{attribute} ORDER BY d.state NULLS FIRST, d.race NULLS FIRST,
               d.{attribute} NULLS FIRST) AS {attribute},
         count(DISTINCT a.airport_name) AS total_airports
  FROM fact0 f
  JOIN dim_demographics d ON f.city = d.city
  JOIN dim_airport a ON f.city = a.municipality
  GROUP BY f.city)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((BASE,) + ctes) + "\n"


IMMIGRATION = """v_immigration AS (
  SELECT o_orderkey AS cicid, CAST(year(o_orderdate) AS INTEGER) AS i94yr, CAST(month(o_orderdate) AS SMALLINT) AS i94mon,
         CAST(c_nationkey AS INTEGER) AS i94cit, CAST(c_nationkey AS INTEGER) AS i94res, substr(c_mktsegment, 1, 3) AS i94port,
         CAST(NULL AS INTEGER) AS arrdate, CAST(NULL AS INTEGER) AS i94mode, CAST(NULL AS VARCHAR) AS i94addr,
         CAST(NULL AS INTEGER) AS depdate, CAST(NULL AS INTEGER) AS i94bir, CAST(NULL AS INTEGER) AS i94visa, 1 AS "count",
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS dtadfile, CAST(NULL AS VARCHAR) AS visapost,
         CAST(NULL AS VARCHAR) AS occup, o_orderstatus AS entdepa, CAST(NULL AS VARCHAR) AS entdepd,
         CAST(NULL AS VARCHAR) AS entdepu, CAST(NULL AS VARCHAR) AS matflag, CAST(NULL AS INTEGER) AS biryear,
         CAST(NULL AS INTEGER) AS dtaddto,
         CASE WHEN o_orderkey % 3 = 0 THEN 'M' WHEN o_orderkey % 3 = 1 THEN 'F' ELSE 'unknown' END AS gender,
         CAST(NULL AS VARCHAR) AS insnum, CAST(NULL AS VARCHAR) AS airline,
         CAST(9007199254740993 + o_orderkey AS BIGINT) AS admnum, CAST(NULL AS VARCHAR) AS fltno, 'B2' AS visatype
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

STATE_TEMPERATURES = """v_state AS (
  SELECT year, mon, round(avg(average_temperature), 6) AS average_temperature,
         max(average_temperature_uncertainty) AS average_temperature_uncertainty, city AS state, country
  FROM t_clean GROUP BY year, mon, city, country)"""


def _constraints() -> str:
    sources = {"cities_demog": "d_clean", "airport_codes": "a_clean", "city_surface_temps": "t_clean",
               "immigration": "v_immigration", "state_surface_temps": "v_state"}
    parts = []
    for table, src in sources.items():
        for r in constraint_rules(table):
            col = f'CAST("{r.column}" AS VARCHAR)'
            bad = f'"{r.column}" IS NULL' if r.rule == "not_null" else f"length({col}) > {r.limit}"
            limit = "CAST(NULL AS INTEGER)" if r.limit is None else f"CAST({r.limit} AS INTEGER)"
            parts.append(
                f"SELECT '{table}' AS \"table\", '{r.column}' AS \"column\", '{r.rule}' AS rule, "
                f"{limit} AS max_length, "
                f"CAST(COALESCE(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations "
                f"FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _broken(table: str) -> str:
    """Broken rules of a row in declared order, joined."""
    texts = []
    for r in constraint_rules(table):
        col = f'CAST("{r.column}" AS VARCHAR)'
        bad, text = ((f'"{r.column}" IS NULL', f"{r.column}: not null") if r.rule == "not_null" else
                     (f"length({col}) > {r.limit}", f"{r.column}: at most {r.limit} characters"))
        texts.append(f"CASE WHEN {bad} THEN '{text}' END")
    return f"concat_ws('; ', {', '.join(texts)})"


_MODEL_TABLES = [("fact_table", "fact0"), ("dimension_table_airport", "dim_airport"),
                 ("dimension_table_demographics", "dim_demographics")]


def _dup_rows(name: str, rel: str) -> str:
    return (f"SELECT '{name}' AS \"table\", r AS rows, dr AS distinct_rows, r - dr AS duplicates, "
            f"r = dr AS passed FROM (SELECT (SELECT count(*) FROM {rel}) AS r, "
            f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {rel})) AS dr)")


def _qa_rows() -> str:
    parts = []
    for name, rel in _MODEL_TABLES:
        parts.append(f"SELECT '{name}' AS \"table\", 'row_count' AS \"check\", count(*) AS expected, "
                     f"count(*) AS actual, true AS passed FROM {rel}")
        parts.append(f"SELECT '{name}' AS \"table\", 'duplicates' AS \"check\", CAST(0 AS BIGINT) AS expected, "
                     f"r - dr AS actual, r = dr AS passed FROM (SELECT (SELECT count(*) FROM {rel}) AS r, "
                     f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {rel})) AS dr)")
    return "\nUNION ALL\n".join(parts)


TEMP_KEY_COLUMNS = ["year", "mon", "average_temperature", "average_temperature_uncertainty",
                    "city", "country", "latitude", "longitude"]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_csv_strings"] = _with() + "SELECT * FROM v_airport"
    q["scan_json"] = _with() + "SELECT * FROM d_clean"
    q["scan_parquet"] = "SELECT * FROM orders"
    q["sink_parquet_overwrite"] = _with() + "SELECT * FROM a_clean"
    q["preview_top20"] = _with(_report_cte("total_population")) + \
        "SELECT * FROM report ORDER BY city LIMIT 20"
    q["table_reset"] = _with() + (
        "SELECT year, mon, average_temperature, average_temperature_uncertainty, city, country, "
        "CAST(latitude AS VARCHAR) AS latitude, CAST(longitude AS VARCHAR) AS longitude FROM t_clean")
    q["table_reset_all"] = _with(IMMIGRATION, STATE_TEMPERATURES) + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, CAST(0 AS BIGINT) AS rejected FROM {src}" for t, src in (
            ("cities_demog", "d_clean"), ("airport_codes", "a_clean"), ("immigration", "orders"),
            ("city_surface_temps", "t_clean"), ("state_surface_temps", "v_state")))
    q["quarantine_load"] = _with(IMMIGRATION) + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", {_broken(t)} AS violations, count(*) AS rows FROM {src} GROUP BY ALL" for t, src in (
            ("airport_codes", "a_clean"), ("immigration", "v_immigration")))
    q["scan_csv_malformed"] = _with() + (
        "SELECT CASE WHEN \"type\" <> 'heliport' THEN ident END AS ident, "
        "CASE WHEN \"type\" = 'heliport' THEN ident || ',' || \"type\" || ',' || \"name\" END AS malformed FROM v_airport")
    q["scan_json_malformed"] = _with() + """SELECT CASE WHEN race <> 'BUILDING' THEN city END AS city, CASE WHEN race <> 'BUILDING' THEN race END AS race,
  CASE WHEN race = 'BUILDING' THEN '{"city":"' || city || '","race":"' || race || '","state_code":"' || state_code || '"' END AS malformed
FROM v_demographics"""
    q["publish_versions"] = _with() + (
        "SELECT 1 AS version, municipality, ident FROM a_clean WHERE \"type\" = 'heliport' "
        "UNION ALL SELECT 2, municipality, ident FROM a_clean")
    q["incremental_rebuild"] = _with(f"late AS (SELECT DISTINCT year FROM t_clean WHERE year > {DELIVERY[0]} OR (year = {DELIVERY[0]} AND mon >= {DELIVERY[1]}))") + (
        "SELECT year, count(*) AS fact_rows, year IN (SELECT year FROM late) AS rewritten FROM fact0 GROUP BY year")
    q["fact_clustered_city"] = _with(FACT) + f"SELECT * FROM fact WHERE city = '{CLUSTERED_CITY}' AND year = {CLUSTERED_YEAR}"
    q["dq_content_match"] = _with() + " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows_written, count(*) AS rows_read, true AS passed FROM {rel}" for name, rel in _MODEL_TABLES)
    q["dq_file_audit"] = _with() + " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", 'ok' AS status, count(*) AS rows FROM {rel}" for name, rel in _MODEL_TABLES)
    q["adjust_joint"] = _with("""m AS (
  SELECT t.city, t.t, a.e, a.l FROM (SELECT city, round(favg(average_temperature), 6) AS t FROM (SELECT DISTINCT average_temperature, average_temperature_uncertainty, city, country, year, mon FROM t_clean) GROUP BY city) t
  JOIN (SELECT municipality, favg(elevation_ft) AS e, favg(latitude) AS l FROM dim_airport GROUP BY municipality) a ON t.city = a.municipality
  WHERE t.city IN (SELECT city FROM dim_demographics)),
f AS (SELECT avg(t) AS mt, avg(e) AS me, avg(l) AS ml, covar_pop(e, e) AS ee, covar_pop(l, l) AS ll, covar_pop(e, l) AS el, covar_pop(t, e) AS te, covar_pop(t, l) AS tl
      FROM m WHERE t IS NOT NULL AND e IS NOT NULL AND l IS NOT NULL),
s AS (SELECT *, CASE WHEN ee * ll - el * el > 1e-9 * ee * ll THEN ee * ll - el * el END AS det FROM f),
b AS (SELECT *, (te * ll - tl * el) / det AS be, (tl * ee - te * el) / det AS bl FROM s)""") + """SELECT city, t AS average_temperature, round(e, 6) AS mean_elevation_ft, round(l, 6) AS mean_latitude,
  round(be, 4) AS elevation_slope, round(bl, 4) AS latitude_slope, round(mt + be * (e - me) + bl * (l - ml), 4) AS expected_temperature,
  round(t - (mt + be * (e - me) + bl * (l - ml)), 4) AS residual FROM m CROSS JOIN b"""
    q["schema_conform_immigration"] = _with(IMMIGRATION) + "SELECT * FROM v_immigration"
    q["schema_conform_state_temperatures"] = _with(STATE_TEMPERATURES) + "SELECT * FROM v_state"
    q["schema_conform_demographics"] = _with() + "SELECT * FROM d_clean"
    q["schema_conform_temperatures"] = q["table_reset"]
    q["schema_conform"] = _with() + (
        "SELECT ident, \"type\", airport_name, elevation_ft, continent, iso_country, iso_region, "
        "municipality, gps_code, iata_code, local_code, latitude, longitude FROM a_clean")
    q["constraint_violations"] = _with(IMMIGRATION, STATE_TEMPERATURES) + _constraints()
    q["project_rename"] = _with() + (
        "SELECT dt AS \"date\", AverageTemperature AS average_temperature, "
        "AverageTemperatureUncertainty AS average_temperature_uncertainty, City AS city, "
        "Country AS country, Latitude AS latitude, Longitude AS longitude FROM v_temperature")
    q["cast_tolerant"] = _with() + f"""SELECT dt, AverageTemperature, AverageTemperatureUncertainty,
  CAST('90071992547' || lpad(regexp_extract(AverageTemperature, '^\\d+', 0), 8, '0') AS BIGINT) AS large_long,
  CAST(NULL AS INTEGER) AS suffixed_int,
  {_int("dt")} AS dt_int,
  {_int("AverageTemperature")} AS temperature_int,
  {_int("AverageTemperature", "BIGINT")} AS temperature_long,
  TRY_CAST(AverageTemperature AS FLOAT) AS temperature_float,
  TRY_CAST(AverageTemperature AS DOUBLE) AS temperature_double,
  TRY_CAST(AverageTemperatureUncertainty AS DECIMAL(9,2)) AS uncertainty_decimal,
  TRY_CAST(AverageTemperature AS DECIMAL(5,2)) AS temperature_decimal_overflow
FROM v_temperature"""
    q["project_drop"] = _with() + (
        "SELECT ident, \"type\", \"name\", elevation_ft, continent, iso_country, iso_region, "
        "municipality, gps_code, iata_code, local_code, "
        "TRY_CAST(string_split(coordinates, ', ')[2] AS DOUBLE) AS latitude, "
        "TRY_CAST(string_split(coordinates, ', ')[1] AS DOUBLE) AS longitude FROM v_airport")
    q["surrogate_key_stable"] = _with() + (
        f"SELECT *, {_key(TEMP_KEY_COLUMNS)} AS id FROM t_clean")
    q["surrogate_key_monotonic"] = _with() + (
        "SELECT count(*) AS rows, count(*) AS distinct_ids, true AS passed FROM fact0")
    q["filter_country_code"] = _with() + f"SELECT * FROM v_airport WHERE iso_country = '{C}'"
    q["filter_country_name"] = _with() + f"SELECT * FROM v_temperature WHERE Country = '{C}'"
    q["filter_drop_null_measure"] = _with() + (
        "SELECT dt, City, Country, TRY_CAST(AverageTemperature AS DOUBLE) AS average_temperature "
        "FROM v_temperature WHERE TRY_CAST(AverageTemperature AS DOUBLE) IS NOT NULL "
        "AND NOT isnan(TRY_CAST(AverageTemperature AS DOUBLE))")
    q["join_city_municipality"] = _with() + (
        "SELECT t.*, a.municipality, a.ident, a.airport_name, a.elevation_ft "
        "FROM t_clean t JOIN a_clean a ON t.city = a.municipality")
    q["join_star_report"] = _with(
        "fc AS (SELECT city, count(*) AS fact_rows FROM fact0 GROUP BY city)",
        "dc AS (SELECT city, count(*) AS demographics_rows FROM dim_demographics GROUP BY city)",
        "ac AS (SELECT municipality, count(*) AS airport_rows FROM dim_airport GROUP BY municipality)",
        "j AS (SELECT f.city, count(*) AS joined_rows FROM fact0 f "
        "JOIN dim_demographics d ON f.city = d.city "
        "JOIN dim_airport a ON f.city = a.municipality GROUP BY f.city)") + (
        "SELECT fc.city, fact_rows, demographics_rows, airport_rows, joined_rows FROM fc "
        "JOIN dc ON fc.city = dc.city JOIN ac ON fc.city = ac.municipality JOIN j ON fc.city = j.city")
    q["agg_count"] = _with() + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {rel}" for n, rel in
        [("temperatures", "t_clean"), ("airports", "a_clean"), ("demographics", "d_clean")]
        + _MODEL_TABLES)
    q["agg_group_city"] = _with() + (
        "SELECT city, count(*) AS fact_rows, round(avg(average_temperature), 6) AS average_temperature, "
        "min(year) AS first_year, max(year) AS last_year FROM fact0 GROUP BY city")
    q["agg_first_deterministic"] = _with() + (
        "SELECT city, first(total_population ORDER BY state NULLS FIRST, race NULLS FIRST, "
        "total_population NULLS FIRST) AS total_population FROM dim_demographics GROUP BY city")
    q["agg_count_distinct"] = _with() + (
        "SELECT municipality, count(DISTINCT airport_name) AS total_airports "
        "FROM dim_airport GROUP BY municipality")
    q["dedup_full_row"] = _with() + (
        "SELECT DISTINCT average_temperature, average_temperature_uncertainty, city, country, "
        "year, mon FROM t_clean")
    q["split_lon_lat"] = _with() + (
        "SELECT ident, coordinates, "
        "TRY_CAST(string_split(coordinates, ', ')[2] AS DOUBLE) AS latitude, "
        "TRY_CAST(string_split(coordinates, ', ')[1] AS DOUBLE) AS longitude, "
        "string_split(coordinates, ', ')[3] AS third_item FROM v_airport")
    year, mon = _int("string_split(dt, '-')[1]"), _int("string_split(dt, '-')[2]")
    q["date_year_month"] = _with() + f"SELECT dt, {year} AS year, {mon} AS mon FROM v_temperature"
    hemi = (f"SELECT Latitude AS latitude_text, Longitude AS longitude_text, "
            f"{_hemi('Latitude')} AS latitude, {_hemi('Longitude')} AS longitude FROM v_temperature")
    q["hemisphere_coordinate"] = _with() + hemi
    q["hemisphere_coordinate_udf"] = _with() + hemi
    q["dq_non_empty"] = _with() + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS source, count(*) > 0 AS non_empty FROM (SELECT 1 FROM {rel} LIMIT 1)"
        for n, rel in [("temperatures", "t_clean"), ("airports", "a_clean"), ("demographics", "d_clean")])
    q["dq_readable"] = _with() + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"table\", true AS readable, true AS schema_matches, count(*) AS rows_decoded FROM {rel}"
        for n, rel in _MODEL_TABLES)
    q["dq_row_count_match"] = _with() + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"table\", count(*) AS rows_written, count(*) AS rows_read, true AS passed FROM {rel}"
        for n, rel in _MODEL_TABLES)
    q["dq_duplicates"] = _with() + "\nUNION ALL\n".join(_dup_rows(n, rel) for n, rel in _MODEL_TABLES)
    q["dq_report"] = _with() + _qa_rows()
    q["clean_demographics"] = _with() + "SELECT * FROM d_clean"
    q["clean_airports"] = _with() + "SELECT * FROM a_clean"
    q["clean_temperatures"] = _with() + "SELECT * FROM t_clean"
    q["fact_city_airport"] = _with(FACT) + "SELECT * FROM fact"
    q["dim_airport"] = _with() + "SELECT * FROM dim_airport"
    q["dim_demographics"] = _with() + "SELECT * FROM dim_demographics"
    q["report_city_climate"] = _with(_report_cte("total_population")) + "SELECT * FROM report"
    q["report_city_climate_colocated"] = q["report_city_climate"]
    q["report_city_veterans"] = _with(_report_cte("veteran_population")) + "SELECT * FROM report"
    q["report_city_female"] = _with(_report_cte("female_population")) + "SELECT * FROM report"
    q["pipeline_end_to_end"] = _with() + _qa_rows()
    q["influence_correlation"] = _with(_report_cte("total_population")) + """SELECT cities,
  corr_airports_temperature, corr_population_temperature,
  CASE WHEN abs(corr_airports_temperature) > abs(corr_population_temperature) THEN 'airports'
       WHEN abs(corr_airports_temperature) < abs(corr_population_temperature) THEN 'population'
       ELSE 'tie' END AS stronger
FROM (SELECT count(*) AS cities,
             round(CASE WHEN count(*) > 1 THEN corr(total_airports, average_temperature) END, 6)
               AS corr_airports_temperature,
             round(CASE WHEN count(*) > 1 THEN corr(total_population, average_temperature) END, 6)
               AS corr_population_temperature
      FROM report)"""
    drawn = " + ".join(f"CASE WHEN u >= {x!r} THEN 1 ELSE 0 END" for x in poisson_steps())
    spread = lambda c, d: f"(x{c}{d} - s{c} * s{d} / n)"                                  # noqa: E731
    corr = lambda c: (f"CASE WHEN n > 0 AND {spread(c, c)} > 1e-9 * x{c}{c} AND {spread('t', 't')} > 1e-9 * xtt "        # noqa: E731
                      f"THEN {spread(c, 't')} / sqrt({spread(c, c)} * {spread('t', 't')}) END")
    q["influence_certainty"] = _with(_report_cte("total_population"), """c AS (
  SELECT city, total_airports - avg(total_airports) OVER () AS a, total_population - avg(total_population) OVER () AS p,
         average_temperature - avg(average_temperature) OVER () AS t FROM report
  WHERE total_airports IS NOT NULL AND total_population IS NOT NULL AND average_temperature IS NOT NULL)""",
        "u AS (SELECT *, CAST(('0x' || substr(md5(city || ':' || b), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM c, (SELECT unnest(range(1, 201)) AS b))",
        f"w AS (SELECT *, {drawn} AS w FROM u)",
        "s AS (SELECT b, sum(w) AS n, sum(w * a) AS sa, sum(w * p) AS sp, sum(w * t) AS st, sum(w * a * a) AS xaa, sum(w * p * p) AS xpp, "
        "sum(w * t * t) AS xtt, sum(w * a * t) AS xat, sum(w * p * t) AS xpt FROM w GROUP BY b)",
        f"r AS (SELECT {corr('a')} AS ca, {corr('p')} AS cp FROM s)",
        "e AS (SELECT 'airports' AS measure, ca AS x FROM r UNION ALL SELECT 'population', cp FROM r "
        "UNION ALL SELECT 'airports less population', abs(ca) - abs(cp) FROM r)") + (
        "SELECT measure, round(quantile_cont(x, 0.05), 4) AS low, round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.95), 4) AS high, "
        "count(x) AS replicates FROM e WHERE x IS NOT NULL GROUP BY measure")
    q["rank_veteran_cities"] = _with(_report_cte("veteran_population")) + (
        f"SELECT * FROM report WHERE average_temperature >= {VETERAN_MIN_TEMPERATURE} "
        f"AND average_temperature <= {VETERAN_MAX_TEMPERATURE} "
        "ORDER BY veteran_population DESC, total_airports DESC, city ASC LIMIT 10")
    q["adjust_elevation"] = _with(
        "tc AS (SELECT city, round(avg(average_temperature), 6) AS average_temperature "
        "FROM fact0 GROUP BY city)",
        "ec AS (SELECT municipality, avg(elevation_ft) AS mean_elevation_ft "
        "FROM dim_airport GROUP BY municipality)") + (
        "SELECT tc.city, tc.average_temperature, round(ec.mean_elevation_ft, 6) AS mean_elevation_ft, "
        f"round(tc.average_temperature + CAST({LAPSE_RATE_PER_FT} AS DOUBLE) * ec.mean_elevation_ft, 6) "
        "AS sea_level_temperature FROM tc JOIN ec ON tc.city = ec.municipality")
    q["adjust_latitude"] = _with(
        "tc AS (SELECT city, round(avg(average_temperature), 6) AS average_temperature FROM fact0 GROUP BY city)",
        "lc AS (SELECT municipality, avg(latitude) AS mean_latitude FROM dim_airport GROUP BY municipality)",
        "j AS (SELECT city, average_temperature, mean_latitude FROM tc JOIN lc ON city = municipality)",
        "line AS (SELECT regr_slope(average_temperature, mean_latitude) AS b, "
        "regr_intercept(average_temperature, mean_latitude) AS a FROM j)") + (
        "SELECT city, average_temperature, round(mean_latitude, 6) AS mean_latitude, "
        "round(a + b * mean_latitude, 4) AS expected_temperature, "
        "round(average_temperature - (a + b * mean_latitude), 4) AS residual FROM j, line")
    return q
