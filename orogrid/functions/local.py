"""Local operations: one pixel in, one pixel out, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a quality mask.
EDGE, WATER, CLOUD = 1, 2, 4
#: Least and most of each integer type.
RANGES = {"uint8": (0, 255), "int8": (-128, 127), "uint16": (0, 65535), "int16": (-32768, 32767), "uint32": (0, 4294967295), "int32": (-2147483648, 2147483647)}
#: The type that holds each one when it is written.
WIDER = {"bool": "uint8", "int8": "int16", "float16": "float32"}
_SPARK = {"uint8": "int", "int8": "int", "uint16": "int", "int16": "int", "uint32": "bigint", "int32": "int", "float32": "float", "float64": "double", "float16": "float", "bool": "int"}
#: Radiance gain and offset by sensor.
CALIBRATION = [("WV03", 0.923, -1.7), ("WV02", 0.96, -2.957), ("GE01", 0.978, -1.948), ("QB02", 0.876, -2.157), ("IK01", 0.907, -4.461), ("WV01", 1.016, -3.932)]
SENSOR_ALIASES = {"QB2": "QB02", "IKO": "IK01"}


def is_data(v: Column, nodata: float | None = None) -> Column:
    """True for pixels that hold data: not null, not NaN, not the nodata value."""
    ok = v.isNotNull() & ~F.isnan(v.cast("double"))
    return F.coalesce(ok & (v != nodata) if nodata is not None else ok, F.lit(False))


def nodata_to_null(v: Column, nodata: float | None = None) -> Column:
    return F.when(is_data(v, nodata), v)


def plausible_height(v: Column) -> Column:
    """Null where a height is below -100, exactly 0 or not finite."""
    d = v.cast("double")
    bad = F.isnan(d) | (d < -100) | (d == 0) | (F.abs(d) == float("inf"))
    return F.when(~bad, v)


def round_half_away(v: Column, digits: int = 0) -> Column:
    return F.round(v, digits)


def quantize(v: Column, steps: int = 128) -> Column:
    """To the nearest 1/steps, halves to even."""
    return F.rint(v * steps) / steps


def clip_cast(v: Column, kind: str, rounded: bool = True) -> Column:
    """Cropped to the range of an integer type, rounded half away from zero first (or cut off)."""
    if kind not in RANGES:
        return v.cast(_SPARK[kind])
    low, high = RANGES[kind]
    whole = F.round(v.cast("double"), 0) if rounded else v.cast("double")
    return F.when(v.isNotNull(), F.greatest(F.least(whole, F.lit(float(high))), F.lit(float(low))).cast(_SPARK[kind]))


def stored_type(kind: str) -> str:
    return WIDER.get(kind, kind)


def scaled(v: Column, scale: float, offset: float, nodata: float | None = None) -> Column:
    """Heights stored as scaled integers; nodata stays as it is."""
    out = v * scale + offset
    return F.when(v == nodata, v).otherwise(out) if nodata is not None else out


def filled(v: Column, mask: Column, value: float) -> Column:
    """value where the mask is set."""
    return F.when(F.coalesce(mask, F.lit(False)), F.lit(value)).otherwise(v)


def where_else(v: Column, keep: Column, other: float) -> Column:
    return F.when(F.coalesce(keep, F.lit(False)), v).otherwise(F.lit(other))


def rescale_dn(v: Column, most: float) -> Column:
    return v * F.lit(most) / 32767


def calibration(spark) -> DataFrame:
    return spark.createDataFrame(CALIBRATION, "sensor string, gain double, offset double")


def radiance(df: DataFrame, dn: str, sensor: str, abscal: Column, effbw: Column, out: str = "radiance") -> DataFrame:
    """Top-of-atmosphere radiance from digital numbers; 0 is nodata. An unknown sensor gives null."""
    table = F.broadcast(calibration(df.sparkSession).withColumnRenamed("sensor", "_sensor"))  # six rows
    name = F.col(sensor)
    for short, full in SENSOR_ALIASES.items():
        name = F.when(F.col(sensor) == short, F.lit(full)).otherwise(name)
    joined = df.withColumn("_name", name).join(table, F.col("_name") == F.col("_sensor"), "left")
    value = F.when(F.col(dn) != 0, F.col("gain") * F.col(dn) * (abscal / effbw) + F.col("offset"))
    return joined.withColumn(out, value).drop("_name", "_sensor", "gain", "offset")


def bitmask(edge: Column, water: Column, cloud: Column) -> Column:
    bit = lambda c, k: F.shiftleft(F.coalesce(c, F.lit(False)).cast("int"), k)
    return bit(edge, 0).bitwiseOR(bit(water, 1)).bitwiseOR(bit(cloud, 2))


def has_bit(mask: Column, bit: int) -> Column:
    return mask.bitwiseAND(bit) > 0


def clear_bits(mask: Column, bits: int) -> Column:
    return mask.bitwiseAND(~bits & 7)


def selection(edge: bool = True, water: bool = True, cloud: bool = True) -> str:
    """Which parts of a mask are used, as cloud, water, edge digits."""
    return f"{int(cloud)}{int(water)}{int(edge)}"


def bitstring(mask: Column) -> Column:
    return F.lpad(F.bin(mask.bitwiseAND(7)), 3, "0")


def ramp(w: Column, low: float = 0.25, high: float = 0.55) -> Column:
    """Feather weight: 0 up to low, 1 from high on, straight between."""
    return F.when(w.isNotNull(), F.least(F.greatest((w - low) / (high - low), F.lit(0.0)), F.lit(1.0)))


def blend(first: Column, second: Column, weight: Column) -> Column:
    """weight of the first and the rest of the second where both are there, else the one that is."""
    return F.when(first.isNotNull() & second.isNotNull(), first * weight + second * (1 - weight)).otherwise(F.coalesce(first, second))


def any_suffix(name: Column, suffixes: list[str], ignore_case: bool = False) -> Column:
    """The first suffix that the name ends with, or null."""
    subject = F.lower(name) if ignore_case else name
    return F.get(F.filter(F.array(*map(F.lit, suffixes)), lambda s: F.endswith(subject, F.lower(s) if ignore_case else s)), 0)


def any_prefix(name: Column, prefixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.startswith(name, F.lit(p)) for p in prefixes], F.lit(False))


def rotate(r: Column, c: Column, rows: Column | int, cols: Column | int, quarter_turns: int) -> tuple[Column, Column]:
    """Where a pixel goes when the grid turns counter-clockwise."""
    rows, cols = (x if isinstance(x, Column) else F.lit(x) for x in (rows, cols))
    return [(r, c), (cols - 1 - c, r), (rows - 1 - r, cols - 1 - c), (c, rows - 1 - r)][quarter_turns % 4]


def flip(r: Column, c: Column, rows: Column | int, cols: Column | int, axis: int) -> tuple[Column, Column]:
    rows, cols = (x if isinstance(x, Column) else F.lit(x) for x in (rows, cols))
    return (rows - 1 - r, c) if axis == 0 else (r, cols - 1 - c)


def nodata_policy(v: Column, mask: Column, policy: str, old: float | None, fill: float) -> tuple[Column, float | None]:
    """Masked values and the nodata value written with them.

    same: fill masked pixels, keep the declared nodata; add: declare fill if none was; switch: declare
    fill; convert: also turn old nodata into fill and declare it; unset: declare none.
    """
    out = filled(v, mask, fill)
    if policy == "convert" and old is not None:
        out = F.when(v == old, F.lit(fill)).otherwise(out)
    declared = {"same": old, "add": fill if old is None else old, "switch": fill, "convert": fill, "unset": None}
    return out, declared[policy]
