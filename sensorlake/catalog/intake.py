"""Queries: sources, decoding, validation and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sensorlake.catalog.base import SHORT, query, readings, rounded, tidy, unioned
from sensorlake.functions import columns as fn
from sensorlake.operators import clean, profile, validate
from sensorlake.plans.features import prepare_features
from sensorlake.sources import files
from sensorlake.sources.payloads import payloads
from sensorlake.sources.readings import project_readings
from sensorlake.spec import (DOUBLE_CHANNELS, HUMIDITY, NUMERIC_CHANNELS, REQUIRED_CHANNELS, RULES,
                             TEMPERATURE, c)

_FAULTS = """faults AS (
  SELECT *, id % 53 = 17 AS corrupt, id % 31 = 7 AS bad_tvoc, id % 41 = 13 AS no_alarm,
    id % 37 = 11 AND id % 41 <> 13 AS odd_alarm,
    t IS NULL OR h IS NULL OR id % 41 = 13 AS missing FROM r)"""
_N_ERRORS = """CASE WHEN corrupt THEN 1 ELSE cast(missing AS int) + cast(coalesce(t < -50 OR t > 100, false) AS int)
  + cast(coalesce(h < 0 OR h > 100, false) AS int) + cast(pressure < 800 OR pressure > 1200 AS int)
  + cast(CASE WHEN bad_tvoc THEN true ELSE tvoc < 0 END AS int) + cast(odd_alarm AS int) END"""


def _decoded(spark, d):
    return validate.decode(payloads(readings(spark, d)))


def _validated(spark, d):
    return validate.validate(_decoded(spark, d))


@query("a06_previous_day",
       "SELECT id AS event_id, device_id, " + rounded("t", "temperature")
       + " FROM r WHERE cast(ts AS date) = DATE '2024-01-09'")
def a06(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").where(
        "ts >= timestamp_ntz'2024-01-09 00:00:00' AND ts < timestamp_ntz'2024-01-10 00:00:00'")
    dated = project_readings(events).withColumn("ds", F.to_date("timestamp"))
    return tidy(profile.recent_day(dated, "2024-01-10").select(
        "event_id", "device_id", c(TEMPERATURE).alias("temperature")))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")


def _inventory(spark, d):
    """The files of all tables."""
    found = [files.file_inventory(spark.read.parquet(f"{d}/{name}.parquet")) for name in _TABLES]
    return reduce(lambda a, b: a.unionByName(b), found)


@query("a08_file_inventory")
def a08(spark, d):
    return _inventory(spark, d).orderBy(F.col("modified").desc(), "path")


@query("k02_newest_file")
def k02(spark, d):
    return files.newest_file(_inventory(spark, d))


@query("a10_json_properties",
       "SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events")
def a10(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    parsed = F.from_json("props", "k STRING, _corrupt STRING",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return events.select("event_id", fn.to_int(parsed.getField("k")).cast("bigint").alias("k"))


@query("a10_corrupt_payloads", "SELECT id AS event_id FROM faults WHERE corrupt", _FAULTS)
def a10_corrupt(spark, d):
    return _decoded(spark, d).where(validate.is_corrupt()).select("event_id")


@query("c02_decode_payload",
       "SELECT id AS event_id, " + ", ".join(
           rounded(f"CASE WHEN corrupt{' OR bad_tvoc' if SHORT[n] == 'tvoc' else ''} THEN NULL ELSE {SHORT[n]} END",
                   SHORT[n]) for n in DOUBLE_CHANNELS)
       + ", cast(CASE WHEN corrupt THEN NULL ELSE cnt END AS bigint) AS cnt, "
         "cast(CASE WHEN corrupt OR no_alarm THEN NULL WHEN odd_alarm THEN 2 ELSE alarm END AS bigint) AS alarm, "
         "CASE WHEN corrupt THEN NULL ELSE sec END AS sec, "
         "CASE WHEN corrupt THEN NULL ELSE device_id END AS device_id FROM faults WHERE NOT corrupt", _FAULTS)
def c02(spark, d):
    ok = _decoded(spark, d).where(~validate.is_corrupt())
    flat = validate.flatten(ok, "event_id")
    return tidy(flat.select("event_id", *[c(n).alias(SHORT[n]) for n in REQUIRED_CHANNELS],
                            F.col("timestamp").alias("sec"), "device_id"))


@query("c04_missing_fields",
       "SELECT id AS event_id, cast(cast(t IS NULL AS int) + cast(h IS NULL AS int) + cast(no_alarm AS int) "
       "AS bigint) AS missing FROM faults WHERE NOT corrupt AND missing", _FAULTS)
def c04(spark, d):
    required = F.array(*[F.lit(n) for n in REQUIRED_CHANNELS])
    ok = _decoded(spark, d).where(~validate.is_corrupt())
    counted = ok.select("event_id", F.size(F.array_except(required, "fields")).alias("missing"))
    return tidy(counted.where("missing > 0"))


@query("c05_not_numeric", "SELECT id AS event_id, 'TVOC[ppb]' AS channel, 'bad' AS text FROM faults "
       "WHERE NOT corrupt AND bad_tvoc", _FAULTS)
def c05(spark, d):
    cells = F.array(*[F.struct(F.lit(n).alias("channel"), validate.raw_field(n).alias("text"))
                      for n in NUMERIC_CHANNELS])
    ok = _decoded(spark, d).where(~validate.is_corrupt())
    return ok.select("event_id", F.inline(cells)).where(
        F.col("text").isNotNull() & fn.to_double(F.col("text")).isNull())


_LIMITS = [(r.channel, SHORT[r.channel], r.lo, r.hi) for r in RULES]


@query("c06_range_errors", unioned([
    f"SELECT id AS event_id, '{n}' AS channel, {rounded(s, 'value')} FROM r WHERE {s} < {lo}"
    + (f" OR {s} > {hi}" if hi is not None else "") for n, s, lo, hi in _LIMITS]))
def c06(spark, d):
    tests = [
        F.when(validate.out_of_range(r, c(r.channel)),
               F.struct(F.lit(r.channel).alias("channel"), c(r.channel).cast("double").alias("value")))
        for r in RULES]
    return tidy(fn.rows_from(readings(spark, d), ["event_id"], tests))


@query("c07_alarm_domain",
       "SELECT id AS event_id FROM faults WHERE NOT corrupt AND odd_alarm", _FAULTS)
def c07(spark, d):
    alarm = validate.raw_field("Fire Alarm")
    ok = _decoded(spark, d).where(~validate.is_corrupt())
    return ok.where(F.array_contains("fields", "Fire Alarm")
                    & ~F.coalesce(alarm.isin("0", "1"), F.lit(False))).select("event_id")


@query("c08_validation",
       f"SELECT id AS event_id, cast({_N_ERRORS} AS bigint) AS n_errors, ({_N_ERRORS}) = 0 AS is_valid FROM faults",
       _FAULTS)
def c08(spark, d):
    return tidy(_validated(spark, d).select("event_id", F.size("errors").alias("n_errors"), "is_valid"))


@query("j08_dead_letters",
       f"SELECT id % 10 AS part, count(*) AS n, cast(sum({_N_ERRORS}) AS bigint) AS errors FROM faults "
       f"WHERE ({_N_ERRORS}) > 0 GROUP BY 1", _FAULTS)
def j08(spark, d):
    _, dead = validate.split_valid(_validated(spark, d))
    return tidy(dead.groupBy((F.col("event_id") % 10).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("errors")).alias("errors")))


_DECLARED = [(r.channel, SHORT[r.channel], r.declared_lo, r.declared_hi, r.unit)
             for r in RULES if r.declared_hi is not None]


@query("c09_declared_violations", unioned([
    f"SELECT id AS event_id, '{n}' AS channel, {rounded(s, 'value')}, {lo}e0 AS lo, {hi}e0 AS hi, '{u}' AS unit "
    f"FROM r WHERE {s} < {lo} OR {s} > {hi}" for n, s, lo, hi, u in _DECLARED]))
def c09(spark, d):
    return tidy(validate.declared_violations(readings(spark, d), "event_id"))


@query("c10_soft_warnings", unioned([
    f"SELECT id AS event_id, '{n}' AS channel, {rounded(s, 'value')}, 'WARN' AS severity FROM r "
    f"WHERE {s} < {lo} OR {s} > {hi}" for n, s, lo, hi in _LIMITS if hi is not None]))
def c10(spark, d):
    return tidy(validate.soft_warnings(readings(spark, d), "event_id").drop("message"))


def _sanitized(s: str, default: float, lo, hi, cond: str = "") -> str:
    value = f"CASE WHEN {cond} THEN NULL ELSE {s} END" if cond else s
    filled = f"coalesce({value}, {default})"
    return f"CASE WHEN {filled} BETWEEN {lo} AND {hi} THEN {filled} ELSE {default} END" if hi is not None else filled


@query("c11_sanitize",
       "SELECT id AS event_id, " + ", ".join(
           rounded(_sanitized(SHORT[r.channel], r.default, r.lo, r.hi,
                              "corrupt OR bad_tvoc" if SHORT[r.channel] == "tvoc" else "corrupt"),
                   SHORT[r.channel]) for r in RULES if r.channel != "CNT")
       + ", cast(CASE WHEN corrupt THEN 0 ELSE cnt END AS bigint) AS cnt, "
         "cast(CASE WHEN corrupt OR no_alarm THEN 0 WHEN odd_alarm THEN 2 ELSE alarm END AS bigint) AS alarm FROM faults",
       _FAULTS)
def c11(spark, d):
    out = validate.sanitize(_decoded(spark, d), text=True)
    return tidy(out.select("event_id", *[c(n).alias(SHORT[n]) for n in REQUIRED_CHANNELS]))


@query("c12_safe_casts",
       "SELECT o_orderkey, cast(coalesce(try_cast(split_part(o_orderpriority, '-', 1) AS double), -1) AS bigint) AS priority, "
       "coalesce(try_cast(o_orderpriority AS double), 0.5e0) AS fallback FROM orders")
def c12(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    first = F.split_part("o_orderpriority", F.lit("-"), F.lit(1))
    return tidy(orders.select("o_orderkey", fn.int_or(first, -1).alias("priority"),
                              fn.double_or(F.col("o_orderpriority"), 0.5).alias("fallback")))


@query("c13_prepare_features",
       "SELECT id AS event_id, " + rounded("coalesce(t, 20)", "t") + ", " + rounded("coalesce(h, 50)", "h")
       + ", 1013.25e0 AS pressure FROM r")
def c13(spark, d):
    narrow = readings(spark, d).select("event_id", c(TEMPERATURE), c(HUMIDITY))
    out = prepare_features(narrow, [TEMPERATURE, HUMIDITY, "Pressure[hPa]"], "defaults", keep=["event_id"])
    return tidy(out.select("event_id", c(TEMPERATURE).alias("t"), c(HUMIDITY).alias("h"),
                           c("Pressure[hPa]").alias("pressure")))


@query("c15_plausible_rows",
       "SELECT id AS event_id FROM r WHERE t > -50 AND t < 100 AND h >= 0 AND h <= 100")
def c15(spark, d):
    return readings(spark, d).where(clean.plausible()).select("event_id")


_IMPUTED = list(NUMERIC_CHANNELS)


def _imputed_sql(agg: str) -> str:
    return ("SELECT id AS event_id, " + ", ".join(
        rounded(f"coalesce({SHORT[n]}, (SELECT {agg.format(SHORT[n])} FROM r))", SHORT[n]) for n in _IMPUTED)
        + " FROM r")


def _imputed(spark, d, policy):
    out = clean.impute(readings(spark, d), _IMPUTED, policy)
    return tidy(out.select("event_id", *[c(n).alias(SHORT[n]) for n in _IMPUTED]))


@query("c17_impute_median", _imputed_sql("quantile_cont({}, 0.5)"))
def c17(spark, d):
    return _imputed(spark, d, "median")


@query("c17_impute_mean", _imputed_sql("avg({})"))
def c17_mean(spark, d):
    return _imputed(spark, d, "mean")


@query("c18_distinct_lines",
       "SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linestatus FROM lineitem")
def c18(spark, d):
    return clean.drop_duplicates(spark.read.parquet(f"{d}/lineitem.parquet"),
                                 ["l_orderkey", "l_partkey", "l_suppkey", "l_linestatus"])


@query("c19_time_parts",
       "SELECT id AS event_id, sec AS datetime, cast(hour(ts) AS bigint) AS hour, "
       "cast(isodow(ts) - 1 AS bigint) AS day_of_week FROM r")
def c19(spark, d):
    # Through epoch seconds, the form CSV exports carry.
    secs = readings(spark, d).select("event_id", F.unix_seconds("timestamp").alias("UTC"))
    return tidy(clean.time_parts(secs, F.timestamp_seconds("UTC")).drop("UTC"))


@query("c22_null_marker",
       "SELECT id AS event_id, CASE WHEN t IS NULL THEN 'NULL' ELSE 'value' END AS t, "
       "coalesce(cast(cnt AS varchar), 'NULL') AS cnt FROM r")
def c22(spark, d):
    t = fn.or_marker(c(TEMPERATURE))
    return readings(spark, d).select(
        "event_id", F.when(t == "NULL", t).otherwise("value").alias("t"),
        fn.or_marker(c("CNT")).alias("cnt"))


@query("c24_two_valued_columns", unioned([
    f"SELECT cast({i} AS bigint) AS position, '{n}' AS channel, count(DISTINCT {e}) = 2 AS two_valued FROM {tab}"
    for i, (n, e, tab) in enumerate((("quality", "quality", "labels"), ("toxic", "toxic", "labels"),
                                     ("doc_id", "doc_id", "labels")))]))
def c24(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    return tidy(clean.two_valued(labels, ["quality", "toxic", "doc_id"]))


@query("c16_clean_chain",
       "SELECT strftime(ts, '%Y-%m-%d') AS ds, cast(hour(ts) AS bigint) AS hour, cast(isodow(ts) - 1 AS bigint) AS day_of_week, "
       f"count(*) AS n, {rounded('avg(ft)', 'mean_t')} FROM ("
       "SELECT DISTINCT ts, device_id, location, coalesce(t, (SELECT quantile_cont(t, 0.5) FROM r)) AS ft, "
       "coalesce(h, (SELECT quantile_cont(h, 0.5) FROM r)) AS fh, tvoc, eco2, h2, ethanol, pressure, pm1, pm25, "
       "nc05, nc1, nc25, cnt, alarm FROM r) WHERE ft > -50 AND ft < 100 AND fh >= 0 AND fh <= 100 GROUP BY 1, 2, 3")
def c16(spark, d):
    cleaned = clean.clean(readings(spark, d))
    return tidy(cleaned.groupBy(F.to_date("timestamp").alias("ds"), "hour", "day_of_week").agg(
        F.count(F.lit(1)).alias("n"), F.avg(c(TEMPERATURE)).alias("mean_t")))
