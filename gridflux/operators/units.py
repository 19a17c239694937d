"""Units and time tags of model outputs (UNI). Values come as kmol or kg per m2 and second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AVOGADRO = 6.022140857e23


def _choose(units: Column, gas: Column, particle: Column) -> Column:
    """By unit: kmol is gas, kg is particle; any other unit gives null, which ``unknown_units`` finds."""
    return F.when(units.startswith("kmol"), gas).when(units.startswith("kg"), particle)


def molar_per_area(value: Column, units: Column) -> Column:
    """UNI-01, UNI-04. kmol to mol per m2 and second; kg unchanged."""
    return _choose(units, value * 1e3, value)


def per_cell(value: Column, units: Column, area: Column) -> Column:
    """UNI-02. mol/s or g/s of the whole cell."""
    return _choose(units, value * 1e3 * area, value * 1e3 * area)


def hourly_per_km2(value: Column, units: Column) -> Column:
    """UNI-03. mol per km2 and hour, or micrograms per m2 and second."""
    return _choose(units, value * 1e6 * 1e3 * 3600, value * 1e9)


def molecules_per_cm2(value: Column, units: Column) -> Column:
    """UNI-05. Molecules per cm2 and second; kg unchanged."""
    return _choose(units, value * 1e-4 * 1e3 * AVOGADRO, value)


def time_tag_pair(ts: Column) -> Column:
    """UNI-06. (YYYYJJJ, HHMMSS) as integers."""
    return F.struct(F.date_format(ts, "yyyyDDD").cast("int").alias("yyyyjjj"), F.date_format(ts, "HHmmss").cast("int").alias("hhmmss"))


def time_tag_text(ts: Column) -> Column:
    """UNI-06. YYYY-MM-DD_HH:MM:SS."""
    return F.date_format(ts, "yyyy-MM-dd_HH:mm:ss")


def hours_since(ts: Column, start: Column) -> Column:
    """UNI-06. Hours since the start."""
    return (F.unix_timestamp(ts) - F.unix_timestamp(start)) / 3600


def encoded_date(ts: Column) -> Column:
    """SNK-11. YYYYMMDD + hour / 24."""
    return F.date_format(ts, "yyyyMMdd").cast("double") + F.hour(ts) / 24


def decode_time(number: Column, units: Column, origin: Column) -> Column:
    """SRC-25. Timestamp of a number of seconds, minutes, hours, days, months or years since an origin."""
    n = number.cast("double")
    seconds = F.when(units == "seconds", n).when(units == "minutes", n * 60).when(units == "hours", n * 3600).when(units == "days", n * 86400)
    months = F.when(units == "months", n).when(units == "years", n * 12).cast("int")
    return F.when(months.isNotNull(), F.timestamp_add("MONTH", months, origin)).otherwise(F.timestamp_micros(F.unix_micros(origin) + F.round(seconds * 1e6).cast("long")))


def relabel(variables: DataFrame, labels: DataFrame) -> DataFrame:
    """UNI-07. Unit label and description of each variable by a table (units, new_units, suffix); a
    unit that the table lacks is an error."""
    if bad := [r[0] for r in unknown_units(variables, labels).select("units").distinct().limit(20).collect()]:  # names some in the message
        raise ValueError(f"unknown units {sorted(map(str, bad))}")
    return variables.join(labels, "units", "left").select("variable", "units", "new_units", F.concat_ws(" ", "long_name", "suffix").alias("long_name"))


def unknown_units(variables: DataFrame, labels: DataFrame) -> DataFrame:
    """UNI-07. Variables whose unit the table lacks."""
    return variables.join(labels, "units", "left_anti")


#: Kilograms of a mass unit (fixed values).
KILOGRAMS = {"Mg": 1e3, "Tg": 1e9, "kg": 1.0, "kt": 1e6}


def mass_to_flux(mass: Column, unit: str, area: Column) -> Column:
    """UNI-08. kg per m2 and second of a yearly mass per cell; the year has 365 days."""
    return mass * KILOGRAMS[unit] / area / (365 * 86400)
