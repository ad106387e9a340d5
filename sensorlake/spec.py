"""Data model: reading schema, channel rules and threshold profiles.

Everything an operator needs to know about column names and limits is a field
of :class:`SensorSpec`, so other channel sets can be used by passing another spec.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def c(name: str) -> Column:
    """Column by literal name; back-quoted because names such as ``PM2.5`` hold dots."""
    return F.col(f"`{name}`")


# Channel names, missing-value defaults and valid ranges of a reading.
TEMPERATURE = "Temperature[C]"
HUMIDITY = "Humidity[%]"
TVOC = "TVOC[ppb]"
ECO2 = "eCO2[ppm]"
H2 = "Raw H2"
ETHANOL = "Raw Ethanol"
PRESSURE = "Pressure[hPa]"
PM1 = "PM1.0"
PM25 = "PM2.5"
NC05 = "NC0.5"
NC1 = "NC1.0"
NC25 = "NC2.5"
COUNTER = "CNT"
ALARM = "Fire Alarm"

DOUBLE_CHANNELS = (
    TEMPERATURE, HUMIDITY, TVOC, ECO2, H2, ETHANOL,
    PRESSURE, PM1, PM25, NC05, NC1, NC25,
)
NUMERIC_CHANNELS = DOUBLE_CHANNELS + (COUNTER,)
REQUIRED_CHANNELS = NUMERIC_CHANNELS + (ALARM,)

# Marker for a missing value in text files.
NULL_MARKER = "NULL"

READING_SCHEMA = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in DOUBLE_CHANNELS]
    + [
        T.StructField(COUNTER, T.IntegerType()),
        T.StructField(ALARM, T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

# CSV exports carry an unnamed index column and the event time as epoch seconds.
CSV_SCHEMA = T.StructType(
    [T.StructField("_idx", T.LongType()), T.StructField("UTC", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in DOUBLE_CHANNELS]
    + [T.StructField(COUNTER, T.IntegerType()), T.StructField(ALARM, T.IntegerType())]
)


@dataclass(frozen=True)
class Rule:
    """One channel's default, hard valid range (open end = None) and declared range."""

    channel: str
    default: float
    lo: float | None
    hi: float | None
    declared_lo: float | None = None
    declared_hi: float | None = None
    unit: str = ""


# Fixed values.
RULES = (
    Rule(TEMPERATURE, 20.0, -50.0, 100.0, -40.0, 125.0, "Celsius"),
    Rule(HUMIDITY, 50.0, 0.0, 100.0, 0.0, 100.0, "Percentage"),
    Rule(TVOC, 0.0, 0.0, None, 0.0, 60000.0, "ppb"),
    Rule(ECO2, 400.0, 0.0, None, 400.0, 8192.0, "ppm"),
    Rule(H2, 0.0, 0.0, None, 0.0, 65535.0, "raw"),
    Rule(ETHANOL, 0.0, 0.0, None, 0.0, 65535.0, "raw"),
    Rule(PRESSURE, 1013.25, 800.0, 1200.0, 300.0, 1100.0, "hPa"),
    Rule(PM1, 0.0, 0.0, None, 0.0, 1000.0, "μg/m³"),
    Rule(PM25, 0.0, 0.0, None, 0.0, 1000.0, "μg/m³"),
    Rule(NC05, 0.0, 0.0, None, 0.0, 10000.0, "#/cm³"),
    Rule(NC1, 0.0, 0.0, None, 0.0, 10000.0, "#/cm³"),
    Rule(NC25, 0.0, 0.0, None, 0.0, 10000.0, "#/cm³"),
    Rule(COUNTER, 0, 0.0, None),
)
# Channels whose two-sided range also drives outlier replacement and soft warnings.
BOUNDED_CHANNELS = (TEMPERATURE, HUMIDITY, PRESSURE)
DEFAULTS = {**{r.channel: r.default for r in RULES}, ALARM: 0}

# Columns checked by the batch quality report (fixed values).
QUALITY_CHANNELS = (TEMPERATURE, HUMIDITY, TVOC, ECO2, H2, ETHANOL, PRESSURE, PM1, PM25)


@dataclass(frozen=True)
class WindowLimits:
    """Limits for window averages (fixed values)."""

    temperature_high: float = 50.0
    temperature_low: float = -10.0
    temperature_critical: float = 80.0
    humidity_high: float = 90.0
    humidity_low: float = 10.0
    tvoc_high: float = 1000.0
    tvoc_critical: float = 2000.0
    eco2_high: float = 1000.0
    eco2_critical: float = 1500.0
    pm25_high: float = 35.0
    pm25_critical: float = 75.0
    pressure_high: float = 1050.0
    pressure_low: float = 950.0


# Severity ladder per channel (fixed values); None = step not defined.
@dataclass(frozen=True)
class Ladder:
    channel: str
    low_critical: float | None
    low_high: float | None
    high_medium: float
    high_high: float
    high_critical: float


LADDERS = (
    Ladder(TEMPERATURE, -20.0, 0.0, 40.0, 50.0, 70.0),
    Ladder(HUMIDITY, 5.0, 15.0, 80.0, 90.0, 95.0),
    Ladder(TVOC, None, None, 500.0, 1000.0, 2000.0),
    Ladder(ECO2, None, None, 800.0, 1000.0, 1500.0),
    Ladder(PM25, None, None, 25.0, 35.0, 50.0),
    Ladder(PM1, None, None, 20.0, 30.0, 45.0),
    Ladder(PRESSURE, 900.0, 950.0, 1050.0, 1100.0, 1150.0),
)

# Limits of the multi-channel fire pattern (fixed values).
PATTERN_LIMITS = {TEMPERATURE: 45.0, TVOC: 800.0, ECO2: 800.0, PM25: 30.0}

# Bounds of the recent-rows scan (fixed values): channel -> (min, max).
RECENT_BOUNDS = {
    TEMPERATURE: (-10.0, 60.0),
    HUMIDITY: (0.0, 100.0),
    TVOC: (0.0, 5000.0),
    PM25: (0.0, 500.0),
}

# Sustained alert rules on readings (fixed values): name -> (channel, limit, seconds).
SUSTAINED_RULES = {
    "HighTemperature": (TEMPERATURE, 30.0, 300),
    "HighTVOC": (TVOC, 1000.0, 300),
    "HighCO2": (ECO2, 1000.0, 300),
    "HighPM25": (PM25, 35.0, 300),
}

@dataclass(frozen=True)
class SensorSpec:
    """Column roles and limits shared by all operators."""

    channels: tuple[str, ...] = NUMERIC_CHANNELS
    label: str = ALARM
    event_time: str = "timestamp"
    row_id: str = "event_id"
    device: str = "device_id"
    location: str = "location"
    rules: tuple[Rule, ...] = RULES
    ladders: tuple[Ladder, ...] = LADDERS
    window_limits: WindowLimits = field(default_factory=WindowLimits)
    # Ordered-window operators cut the timeline of busy keys into slices of this many
    # seconds, so that one key becomes many independent tasks. None: measure the table.
    slice_seconds: float | None = None

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(n for n in self.channels if n != self.label)

    @property
    def defaults(self) -> dict[str, float]:
        return {**{r.channel: r.default for r in self.rules}, self.label: 0}


DEFAULT_SPEC = SensorSpec()
