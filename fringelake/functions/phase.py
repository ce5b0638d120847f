"""Phase, amplitude and date expressions. A complex number is two columns, re and im."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days between the proleptic day number 1 of year 0 and 1970-01-01.
DATENUM_EPOCH = 719529


def r6(x) -> Column:
    """Rounded to six places, and no negative zero: what a result table shows of a double."""
    return F.round(x, 6) + F.lit(0.0)


def wrap(x) -> Column:
    """An angle in (-pi, pi]."""
    return F.atan2(F.sin(x), F.cos(x))


def rotate(re, im, by) -> tuple[Column, Column]:
    """(re, im) * exp(-i * by): ramp removal."""
    return re * F.cos(by) + im * F.sin(by), im * F.cos(by) - re * F.sin(by)


def unit(re, im) -> tuple[Column, Column]:
    """(re, im) of length one; zero or not finite becomes zero."""
    size = F.hypot(re, im)
    good = size.isNotNull() & ~F.isnan(size) & (size > 0) & (size < F.lit(math.inf))
    return F.when(good, re / size).otherwise(0.0), F.when(good, im / size).otherwise(0.0)


def conj_angle(re_b, im_b, re_a, im_a) -> Column:
    """The angle of b times the conjugate of a."""
    return F.atan2(im_b * re_a - re_b * im_a, re_b * re_a + im_b * im_a)


def positive_pi(x, dt, tolerance: float = 1e-6) -> Column:
    """The branch +pi where an angle is -pi and time runs forward."""
    return F.when((F.abs(x + math.pi) < tolerance) & (dt > 0), F.lit(math.pi)).otherwise(x)


def amplitude(v, is_power: bool) -> Column:
    """Amplitude of a power or amplitude sample; NaN unless finite and above zero."""
    good = v.isNotNull() & ~F.isnan(v) & (v > 0) & (v < F.lit(math.inf))
    return F.when(good, F.sqrt(v) if is_power else v).otherwise(F.lit(float("nan")))


def phase_to_mm(phi, wavelength: float) -> Column:
    """Line-of-sight millimetres of an unwrapped phase."""
    return phi * F.lit(-wavelength * 1000 / (4 * math.pi))


def datenum(date) -> Column:
    return F.unix_date(date) + F.lit(DATENUM_EPOCH)


def from_datenum(day) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(day) - DATENUM_EPOCH).cast("int"))


def from_yyyymmdd(number) -> Column:
    return F.to_date(number.cast("string"), "yyyyMMdd")


def half_away(x) -> Column:
    """Rounded to whole numbers, ties away from zero."""
    return F.signum(x) * F.floor(F.abs(x) + 0.5)


def millimetres(x) -> Column:
    """Metres on a grid of millimetres, in single precision."""
    return (half_away(x.cast("float") * F.lit(1000.0).cast("float")) / 1000).cast("float")


def text_flag(x, default: str | None = None) -> Column:
    """Lower-cased and trimmed text; the default where nothing is left."""
    low = F.lower(F.trim(x))
    return low if default is None else F.coalesce(F.when(low != "", low), F.lit(default))


def unit_scale(text) -> Column:
    """Metres of one unit that a text names; null if it names none."""
    low = F.regexp_replace(F.lower(F.trim(text)), " ", "")
    return (
        F.when(low.contains("millimeter") | low.isin("mm", "millimetre"), 0.001)
        .when(low.contains("centimeter") | low.isin("cm", "centimetre"), 0.01)
        .when(low.isin("m", "meter", "metre", "meters", "metres"), 1.0)
    )


def axis_with_master(days: DataFrame, master: float) -> DataFrame:
    """image_ix, day, is_master: the days in order, the master's put in where it belongs. A row for each acquisition."""
    whole = days.select("day").union(days.sparkSession.createDataFrame([(float(master),)], "day double")).distinct()
    return whole.select(F.row_number().over(Window.orderBy("day")).cast("long").alias("image_ix"), "day", (F.col("day") == master).alias("is_master"))
