"""Per-city reports.

The source job joined fact x demographics x airports and then grouped by
city: every fact row of a city is repeated |D_city|·|A_city| times, so the
join grows with the square of the dimension sizes.  Every aggregate used
here survives aggregating *before* the join:

* mean temperature: each fact row of a city is repeated equally often;
* distinct airport names: depend on the airport dimension only;
* one population value: depends on the demographics dimension only;

so each is computed per city on its own table (partial + final hash
aggregation, one small shuffle) and the per-city rows are inner-joined,
which keeps the inner-join meaning: only cities present on all sides.
``sum``/``count`` over the joined rows would not survive this rewrite;
``star_join_counts`` gives the joined row count by multiplication instead.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climastar.operators.aggregates import distinct_count_per_group, first_per_group
from climastar.plans.model import StarModel

MEAN_DIGITS = 6
#: Of the sum of squares: a spread below this share counts as none.
FLAT = 1e-9
DEMOGRAPHICS_ORDER = ["state", "race"]


def city_mean_temperature(model: StarModel) -> DataFrame:
    """(city, average_temperature) rounded to ``MEAN_DIGITS``.

    From the distinct temperature rows when the model is built in the same
    plan (before the fan-out), else from the fact table.  The first form
    also has cities that have no fact rows; callers inner-join with the
    per-city airport and demographics aggregates, which removes them.  Equal
    values of the fact are counted before they are summed: one by one, the
    rounding of millions of additions shows in the last digits.
    """
    if model.temperature_part is not None:
        return model.temperature_part.groupBy("city").agg(
            F.round(F.avg("average_temperature"), MEAN_DIGITS).alias("average_temperature"))
    value = F.col("average_temperature")
    values = model.fact.groupBy("city", "average_temperature").agg(F.count(value).alias("n"))
    return values.groupBy("city").agg(
        F.round(F.try_divide(F.sum(value * F.col("n")), F.sum("n")), MEAN_DIGITS).alias("average_temperature"))


def city_airport_counts(model: StarModel) -> DataFrame:
    """(municipality, total_airports): distinct airport names per city."""
    return distinct_count_per_group(model.dim_airport, "municipality", "airport_name",
                                    "total_airports")


def city_attribute(model: StarModel, attribute: str) -> DataFrame:
    """(city, attribute): the value of the demographics row least in
    (state, race), a deterministic stand-in for ``first``."""
    return first_per_group(model.dim_demographics, "city", attribute, DEMOGRAPHICS_ORDER)


def city_report(model: StarModel, attribute: str = "total_population") -> DataFrame:
    """(city, average_temperature, <attribute>, total_airports).

    The three inputs are one row per city; AQE measures the shuffled sides
    and broadcasts them at run time when they are small.
    """
    temp = city_mean_temperature(model)
    attr = city_attribute(model, attribute).withColumnRenamed("city", "__a_city")
    air = city_airport_counts(model)
    joined = (temp.join(attr, temp.city == attr.__a_city)
                  .join(air, temp.city == air.municipality))
    return joined.select("city", "average_temperature", attribute, "total_airports")


def report_city_climate(model: StarModel) -> DataFrame:
    return city_report(model, "total_population")


def report_city_veterans(model: StarModel) -> DataFrame:
    return city_report(model, "veteran_population")


def report_city_female(model: StarModel) -> DataFrame:
    return city_report(model, "female_population")


def preview(df: DataFrame, n: int = 20, order: str = "city") -> DataFrame:
    """The console preview, made deterministic: first ``n`` rows by ``order``."""
    return df.orderBy(order).limit(n)


def city_fact_rows(model: StarModel) -> DataFrame:
    """(city, fact_rows).  When the model is built in the same plan, the fact
    is never generated for this: its rows per city are the product of the
    distinct parts, |T_c|·|A_c|·|D_c|, three small per-city counts.  For a
    model read from written tables, the stored fact is counted."""
    if model.source is None:
        return model.fact.groupBy("city").agg(F.count(F.lit(1)).alias("fact_rows"))
    from climastar.plans.model import fact_parts, fact_row_count

    src = model.source
    return fact_row_count(*fact_parts(src.temperatures, src.airports, src.demographics))


def star_join_counts(model: StarModel) -> DataFrame:
    """(city, fact_rows, demographics_rows, airport_rows, joined_rows): the
    size of fact x demographics x airports per city, from per-city counts."""
    f = city_fact_rows(model)
    d = (model.dim_demographics.groupBy(F.col("city").alias("__d_city"))
         .agg(F.count(F.lit(1)).alias("demographics_rows")))
    a = (model.dim_airport.groupBy("municipality")
         .agg(F.count(F.lit(1)).alias("airport_rows")))
    j = f.join(d, f.city == d.__d_city).join(a, f.city == a.municipality)
    return j.select("city", "fact_rows", "demographics_rows", "airport_rows",
                    (F.col("fact_rows") * F.col("demographics_rows") * F.col("airport_rows"))
                    .alias("joined_rows"))


def influence_correlation(model: StarModel) -> DataFrame:
    """Across cities: Pearson correlation of mean temperature with the number
    of airports and with the population; which one is stronger."""
    r = city_report(model, "total_population")
    c = r.agg(
        F.count(F.lit(1)).alias("cities"),
        F.round(F.corr("total_airports", "average_temperature"), MEAN_DIGITS).alias("corr_airports_temperature"),
        F.round(F.corr("total_population", "average_temperature"), MEAN_DIGITS).alias("corr_population_temperature"),
    )
    return c.withColumn(
        "stronger",
        F.when(F.abs("corr_airports_temperature") > F.abs("corr_population_temperature"), F.lit("airports"))
         .when(F.abs("corr_airports_temperature") < F.abs("corr_population_temperature"), F.lit("population"))
         .otherwise(F.lit("tie")))


def poisson_steps(most: int = 12) -> list[float]:
    """Cumulative probabilities of 0, 1, .. under a Poisson distribution of mean one."""
    out, term = [], math.exp(-1)
    for k in range(most):
        out.append((out[-1] if out else 0.0) + term)
        term /= k + 1
    return out


def influence_certainty(model: StarModel, replicates: int = 200) -> DataFrame:
    """How certain ``influence_correlation`` is: (measure, low, median, high, replicates) of both correlations and of the difference of
    their absolute values (airports less population), with the 5 %, 50 % and 95 % points over bootstrap replicates.

    In each replicate a city counts as often as a Poisson variable of mean one says, drawn by a hash of city and replicate: no
    resampling, one pass of sums per replicate, the same result on every run and engine.  Replicates in which
    a measure does not vary have no correlation and are left out; ``replicates`` is the number of the others.
    """
    r = city_report(model, "total_population").select("city", F.col("total_airports").cast("double").alias("a"), F.col("total_population").cast("double").alias("p"),
                                                      F.col("average_temperature").alias("t")).where("a is not null and p is not null and t is not null")
    # Centred, so that the sums keep their digits.
    mean = r.agg(*[F.avg(c).alias(f"m{c}") for c in "apt"]).withColumn("one", F.lit(1))
    r = r.join(mean, F.lit(1) == F.col("one")).select("city", *[(F.col(c) - F.col(f"m{c}")).alias(c) for c in "apt"])
    drawn = r.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    u = F.conv(F.substring(F.md5(F.concat_ws(":", "city", F.col("b").cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    w = F.lit(0)
    for step in poisson_steps():
        w = w + F.when(u >= step, 1).otherwise(0)
    drawn = drawn.withColumn("w", w.cast("double"))
    sums = drawn.groupBy("b").agg(F.sum("w").alias("n"), *[F.sum(F.col("w") * F.col(c)).alias(f"s{c}") for c in "apt"],
                                  *[F.sum(F.col("w") * F.col(c) * F.col(d)).alias(c + d) for c, d in ("aa", "pp", "tt", "at", "pt")])

    def spread(c: str, d: str):
        return F.col(c + d) - F.try_divide(F.col(f"s{c}") * F.col(f"s{d}"), F.col("n"))

    def corr(c: str):
        varies = (F.col("n") > 0) & (spread(c, c) > F.lit(FLAT) * F.col(c + c)) & (spread("t", "t") > F.lit(FLAT) * F.col("tt"))
        return F.when(varies, spread(c, "t") / F.sqrt(spread(c, c) * spread("t", "t")))

    both = sums.select(corr("a").alias("ca"), corr("p").alias("cp"))
    each = both.select(F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), v.alias("x")) for n, v in (
        ("airports", F.col("ca")), ("population", F.col("cp")), ("airports less population", F.abs("ca") - F.abs("cp")))])).alias("e")).select("e.*")
    points = [F.round(F.percentile("x", F.lit(q)), 4).alias(n) for n, q in (("low", 0.05), ("median", 0.5), ("high", 0.95))]
    return each.where("x is not null").groupBy("measure").agg(*points, F.count("x").alias("replicates"))


def rank_veteran_cities(model: StarModel, min_temperature: float | None = None,
                        max_temperature: float | None = None, top: int = 10) -> DataFrame:
    """Top ``top`` cities for a veteran: mean temperature within the
    preferred range, most veterans first, then most airports, then name."""
    r = city_report(model, "veteran_population")
    if min_temperature is not None:
        r = r.filter(F.col("average_temperature") >= F.lit(min_temperature))
    if max_temperature is not None:
        r = r.filter(F.col("average_temperature") <= F.lit(max_temperature))
    return (r.orderBy(F.desc("veteran_population"), F.desc("total_airports"), F.asc("city"))
             .limit(top))


# Standard-atmosphere lapse rate, 6.5 degrees per km, expressed per foot.
LAPSE_RATE_PER_FT = 0.0019812


def adjust_elevation(model: StarModel, lapse_rate_per_ft: float = LAPSE_RATE_PER_FT) -> DataFrame:
    """(city, average_temperature, mean_elevation_ft, sea_level_temperature):
    mean temperature moved to sea level using the mean elevation of the
    city's airports and a lapse rate (an argument; the source gives none)."""
    temp = city_mean_temperature(model)
    elev = (model.dim_airport.groupBy("municipality")
            .agg(F.avg("elevation_ft").alias("mean_elevation_ft")))
    # cities of the fact only: present in the demographics as well
    demo = model.dim_demographics.select(F.col("city").alias("__d_city")).distinct()
    j = (temp.join(elev, temp.city == elev.municipality)
             .join(demo, temp.city == demo.__d_city, "left_semi"))
    return j.select(
        "city", "average_temperature",
        F.round("mean_elevation_ft", MEAN_DIGITS).alias("mean_elevation_ft"),
        F.round(F.col("average_temperature") + F.lit(lapse_rate_per_ft) * F.col("mean_elevation_ft"),
                MEAN_DIGITS).alias("sea_level_temperature"))


#: Of the product of the variances: a determinant below this share counts as zero.
COLLINEAR = 1e-9


def adjust_latitude(model: StarModel) -> DataFrame:
    """(city, average_temperature, mean_latitude, expected_temperature,
    residual): the temperature that a straight line over the cities' mean
    latitudes (of their airports) gives, and what is left of a city's mean.

    The line is fitted by two aggregates over one row per city; with one
    city, or all at one latitude, there is none and both are NULL.
    """
    temp = city_mean_temperature(model)
    where = model.dim_airport.groupBy("municipality").agg(F.avg("latitude").alias("mean_latitude"))
    demo = model.dim_demographics.select(F.col("city").alias("__d_city")).distinct()
    j = (temp.join(where, temp.city == where.municipality)
             .join(demo, temp.city == demo.__d_city, "left_semi")
             .select("city", "average_temperature", "mean_latitude", F.lit(1).alias("__one")))
    line = j.agg(F.regr_slope("average_temperature", "mean_latitude").alias("__b"),
                 F.regr_intercept("average_temperature", "mean_latitude").alias("__a")).withColumn("__k", F.lit(1))
    fitted = F.col("__a") + F.col("__b") * F.col("mean_latitude")
    return j.join(line, F.col("__one") == F.col("__k")).select(
        "city", "average_temperature", F.round("mean_latitude", MEAN_DIGITS).alias("mean_latitude"),
        F.round(fitted, 4).alias("expected_temperature"),
        F.round(F.col("average_temperature") - fitted, 4).alias("residual"))


def adjust_joint(model: StarModel) -> DataFrame:
    """(city, average_temperature, mean_elevation_ft, mean_latitude, elevation_slope, latitude_slope, expected_temperature, residual):
    the plane of least squares over elevation and latitude together, fitted over the cities' means, and what is left of a city's mean.

    The fit needs the variances and covariances of three columns, which merge from
    partial aggregates; the two normal equations are solved in one
    expression.  With fewer than three cities, or if elevation and latitude lie on a line, there is no plane and the
    last four are NULL.
    """
    temp = city_mean_temperature(model)
    where = model.dim_airport.groupBy("municipality").agg(F.avg("elevation_ft").alias("e"), F.avg("latitude").alias("l"))
    demo = model.dim_demographics.select(F.col("city").alias("__d_city")).distinct()
    j = (temp.join(where, temp.city == where.municipality).join(demo, temp.city == demo.__d_city, "left_semi")
         .select("city", F.col("average_temperature").alias("t"), "e", "l"))
    both = j.where("t is not null and e is not null and l is not null")
    fit = both.agg(*[F.avg(c).alias(f"m{c}") for c in "tel"], *[F.covar_pop(a, b).alias(a + b) for a, b in ("ee", "ll", "el", "te", "tl")])
    det = F.col("ee") * F.col("ll") - F.col("el") * F.col("el")
    solvable = det > F.lit(COLLINEAR) * F.col("ee") * F.col("ll")
    fit = fit.select("mt", "me", "ml", F.when(solvable, (F.col("te") * F.col("ll") - F.col("tl") * F.col("el")) / det).alias("be"),
                     F.when(solvable, (F.col("tl") * F.col("ee") - F.col("te") * F.col("el")) / det).alias("bl"))
    plane = F.col("mt") + F.col("be") * (F.col("e") - F.col("me")) + F.col("bl") * (F.col("l") - F.col("ml"))
    return j.join(fit.withColumn("one", F.lit(1)), F.lit(1) == F.col("one")).select(
        "city", F.col("t").alias("average_temperature"), F.round("e", MEAN_DIGITS).alias("mean_elevation_ft"), F.round("l", MEAN_DIGITS).alias("mean_latitude"),
        F.round("be", 4).alias("elevation_slope"), F.round("bl", 4).alias("latitude_slope"),
        F.round(plane, 4).alias("expected_temperature"), F.round(F.col("t") - plane, 4).alias("residual"))
