"""Decoding, validation and sanitising of readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions.columns import finite, once, parsed, rows_from, to_double
from sensorlake.spec import (ALARM, BOUNDED_CHANNELS, COUNTER, DEFAULT_SPEC, NUMERIC_CHANNELS,
                             REQUIRED_CHANNELS, Rule, SensorSpec, c)

# Every field is decoded as text: a wrong type then costs one field, not the row.
RAW_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in REQUIRED_CHANNELS]
    + [T.StructField(n, T.StringType()) for n in ("timestamp", "UTC", "device_id", "location")]
    + [T.StructField("_corrupt", T.StringType())]
)


def decode(df: DataFrame, payload: str = "value") -> DataFrame:
    """Parse a JSON payload column.

    Adds the text struct ``raw``, the names present ``fields`` and ``numbers``, all channels
    as finite doubles in the order of ``NUMBERS``. The names take a second parse, which is
    spared where every required field has a value; ``fields`` then lists the required ones.
    """
    text = c(payload).cast("string")
    raw = F.from_json(text, RAW_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    found = df.select("*", once(raw).alias("raw"))
    every = reduce(lambda a, b: a & b, [raw_field(n).isNotNull() for n in REQUIRED_CHANNELS])
    required = F.array(*[F.lit(n) for n in REQUIRED_CHANNELS])
    # One small function applied to an array: written out per channel it would be
    # more code than the JVM compiles.
    texts = F.array(*[raw_field(n) for n in NUMBERS])
    numbers = F.transform(F.transform(texts, parsed), finite)
    return found.select("*", F.when(every, required).otherwise(F.json_object_keys(text)).alias("fields"),
                        once(numbers).alias("numbers"))


# Channels in the order of the decoded ``numbers`` array.
NUMBERS = (*NUMERIC_CHANNELS, ALARM)


def number(name: str) -> Column:
    return F.get("numbers", F.lit(NUMBERS.index(name)))


def raw_field(name: str) -> Column:
    return F.col("raw").getField(name)


def is_corrupt() -> Column:
    return F.col("raw").isNull() | raw_field("_corrupt").isNotNull()


def typed_columns(broker_time: Column | None = None) -> list[Column]:
    """Typed columns of a decoded payload.

    Event time falls back to UTC seconds, then to the broker's time.
    """
    at = {n: number(n) for n in NUMBERS}
    event_time = [raw_field("timestamp").try_cast("timestamp"),
                  F.timestamp_seconds(to_double(raw_field("UTC")))]
    if broker_time is not None:
        event_time.append(broker_time)
    return (
        [at[n].alias(n) for n in NUMERIC_CHANNELS if n != COUNTER]
        + [at[n].try_cast("int").alias(n) for n in (COUNTER, ALARM)]
        + [F.coalesce(*event_time).alias("timestamp"),
           raw_field("device_id").alias("device_id"), raw_field("location").alias("location")]
    )


def flatten(decoded: DataFrame, *keep: str, broker_time: str | None = None) -> DataFrame:
    """Typed readings from a decoded frame, with a processing time stamp."""
    stamp = c(broker_time) if broker_time else None
    return decoded.select(
        *[c(k) for k in keep], *typed_columns(stamp),
        *([stamp.alias("kafka_timestamp")] if broker_time else []),
        F.current_timestamp().alias("processing_timestamp"))


def out_of_range(rule: Rule, value: Column) -> Column:
    """Outside the rule's valid range; NULL for a missing value."""
    return ~value.between(rule.lo, rule.hi) if rule.hi is not None else value < rule.lo


def range_error(rule: Rule, value: Column) -> Column:
    """Message when the value lies outside the rule's valid range, else NULL."""
    return _range_message(F.lit(rule.channel), F.lit(rule.lo), F.lit(rule.hi).cast("double"), value)


def _range_message(channel: Column, lo: Column, hi: Column, value: Column) -> Column:
    shown = value.cast("string")
    outside = F.concat(channel, F.lit(" out of range: "), shown, F.lit(" (valid: "),
                       lo.cast("string"), F.lit(" to "), hi.cast("string"), F.lit(")"))
    negative = F.concat(F.lit("Negative value for "), channel, F.lit(": "), shown,
                        F.lit(" (must be >= "), lo.cast("string"), F.lit(")"))
    return F.when(hi.isNotNull(), F.when(~value.between(lo, hi), outside)).otherwise(
        F.when(value < lo, negative))


def _rule_array(spec: SensorSpec) -> Column:
    return F.array(*[F.struct(F.lit(r.channel).alias("channel"), F.lit(r.lo).alias("lo"),
                              F.lit(r.hi).cast("double").alias("hi")) for r in spec.rules])


def _known(errors: Column) -> Column:
    return F.filter(errors, lambda e: e.isNotNull())


def payload_errors(spec: SensorSpec = DEFAULT_SPEC) -> Column:
    """Error list of a decoded payload: missing fields, bad numbers, ranges, alarm domain."""
    required = F.array(*[F.lit(n) for n in REQUIRED_CHANNELS])
    missing = F.array_except(required, F.coalesce(F.col("fields"), F.array().cast("array<string>")))
    alarm = raw_field(spec.label)

    def judge(rule: Column, cell: Column) -> Column:
        bad = F.concat(F.lit("Invalid numeric value for "), rule["channel"], F.lit(": "), cell["text"])
        return F.when(cell["text"].isNotNull() & cell["number"].isNull(), bad).otherwise(
            _range_message(rule["channel"], rule["lo"], rule["hi"], cell["number"]))

    cells = F.array(*[F.struct(raw_field(r.channel).alias("text"), number(r.channel).alias("number"))
                      for r in spec.rules])
    odd_alarm = F.array_contains("fields", spec.label) & ~F.coalesce(alarm.isin("0", "1"), F.lit(False))
    # Messages are built for faulty payloads only; the test before them is cheap.
    faulty = reduce(lambda a, b: a | b, [
        F.coalesce(out_of_range(r, number(r.channel)), raw_field(r.channel).isNotNull())
        for r in spec.rules])
    messages = _known(F.concat(
        F.array(F.when(F.size(missing) > 0, F.concat(
            F.lit("Missing required fields: "), F.array_join(missing, ", ")))),
        F.zip_with(_rule_array(spec), cells, judge),
        F.array(F.when(odd_alarm, F.concat(F.lit("Invalid Fire Alarm value: "),
                                           F.coalesce(alarm, F.lit("null")), F.lit(" (must be 0 or 1)"))))))
    return F.when(faulty | odd_alarm | (F.size(missing) > 0), messages).otherwise(no_errors())


def reading_errors(spec: SensorSpec = DEFAULT_SPEC) -> Column:
    """Error list of a typed reading, where only ranges and the alarm domain can fail."""
    alarm = c(spec.label)
    values = F.array(*[c(r.channel).cast("double") for r in spec.rules])
    per_channel = F.zip_with(_rule_array(spec), values, lambda rule, v: _range_message(
        rule["channel"], rule["lo"], rule["hi"], v))
    messages = _known(F.concat(per_channel, F.array(F.when(
        ~F.coalesce(alarm.isin(0, 1), F.lit(False)),
        F.concat(F.lit("Invalid Fire Alarm value: "), F.coalesce(alarm.cast("string"), F.lit("null")))))))
    return F.when(reading_failed(spec), messages).otherwise(no_errors())


def reading_failed(spec: SensorSpec = DEFAULT_SPEC) -> Column:
    """Whether ``reading_errors`` would find anything, without building messages."""
    tests = [out_of_range(r, c(r.channel)) for r in spec.rules]
    tests.append(~F.coalesce(c(spec.label).isin(0, 1), F.lit(False)))
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])


def no_errors() -> Column:
    return F.array().cast("array<string>")


def validate(decoded: DataFrame, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Add ``errors`` and ``is_valid`` to a decoded frame."""
    errors = F.when(is_corrupt(), F.array(F.lit("Corrupt record"))).otherwise(payload_errors(spec))
    return decoded.select("*", once(errors).alias("errors")).withColumn(
        "is_valid", F.size("errors") == 0)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, dead letters)."""
    return validated.where("is_valid"), validated.where("NOT is_valid")


def sanitize_value(rule_default: float, value: Column, rule: Rule | None, as_int: bool) -> Column:
    default = F.lit(int(rule_default) if as_int else float(rule_default))
    clean = F.coalesce(value, default)
    if rule is not None and rule.channel in BOUNDED_CHANNELS:
        clean = F.when(clean.between(rule.lo, rule.hi), clean).otherwise(default)
    return clean


def sanitize(df: DataFrame, text: bool = False, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """Replace missing, unreadable and (bounded channels) outlying values by defaults.

    With ``text`` the channels come from the decoded struct ``raw``, else from columns;
    a channel without a column gets its default.
    """
    rules = {r.channel: r for r in spec.rules}
    out = {}
    for name, default in spec.defaults.items():
        whole = name in (COUNTER, spec.label)
        if text:
            value = number(name).try_cast("int" if whole else "double")
        elif name in df.columns:
            value = c(name).cast("int" if whole else "double")
        else:
            value = F.lit(None).cast("int" if whole else "double")
        out[name] = sanitize_value(default, value, rules.get(name), whole)
    return df.withColumns(out)


def declared_violations(df: DataFrame, *keep: str, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per channel value outside its declared range.

    The rules are few and fixed, so they are tested in place: no unpivot, no join.
    """
    tests = [
        F.when(~c(r.channel).between(r.declared_lo, r.declared_hi), F.struct(
            F.lit(r.channel).alias("channel"), c(r.channel).cast("double").alias("value"),
            F.lit(r.declared_lo).alias("lo"), F.lit(r.declared_hi).alias("hi"),
            F.lit(r.unit).alias("unit")))
        for r in spec.rules if r.declared_hi is not None]
    return rows_from(df, keep, tests)


def soft_warnings(df: DataFrame, *keep: str, spec: SensorSpec = DEFAULT_SPEC) -> DataFrame:
    """WARN rows for temperature, humidity and pressure outside the valid range."""
    tests = [
        F.when(~c(r.channel).between(r.lo, r.hi), F.struct(
            F.lit(r.channel).alias("channel"), c(r.channel).alias("value"),
            F.lit("WARN").alias("severity"), range_error(r, c(r.channel)).alias("message")))
        for r in spec.rules if r.channel in BOUNDED_CHANNELS]
    return rows_from(df, keep, tests)
