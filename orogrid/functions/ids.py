"""Identifiers of scenes and strips, versions and resolutions, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats of the identifiers and the names of their parts.
PAIR = r"[A-Z][A-Z0-9]{2}[0-9]_\d{8}_[0-9A-F]{16}_[0-9A-F]{16}"
VERSION_KEY = r"v\d{6}"
RESOLUTION = r"\d+(?:cm|m)"
_TILE, _ORDER, _PART = r"R\d+C\d+", r"\d{12}_\d{2}", r"P\d{3}"
_SIDE = rf"(?:({_TILE})-)?({_ORDER})_({_PART})"
FORMATS = {
    "pairname": (r"([A-Z][A-Z0-9]{2}[0-9])_(\d{8})_([0-9A-F]{16})_([0-9A-F]{16})", ("sensor", "timestamp", "catid1", "catid2")),
    "version_key": (r"v(\d{2})(\d{2})(\d{2})", ("major", "minor", "micro")),
    "resolution": (r"(\d+)(cm|m)", ("value", "unit")),
    "strip_dem": (rf"({PAIR})_({RESOLUTION})_({VERSION_KEY})", ("pairname", "res", "verkey")),
    "strip_dem_folder": (rf"({PAIR})_({RESOLUTION})(?:_(lsf))?_({VERSION_KEY})", ("pairname", "res", "lsf", "verkey")),
    "scene_overlap": (rf"({PAIR})_{_SIDE}_{_SIDE}", ("pairname", "tile1", "ordernum1", "partnum1", "tile2", "ordernum2", "partnum2")),
    "scene_dem": (rf"({PAIR}_(?:{_TILE}-)?{_ORDER}_{_PART}_(?:{_TILE}-)?{_ORDER}_{_PART})_(\d)(-\d{{2}})?", ("overlap", "res", "subtile")),
    "strip_segment": (rf"([A-Z]+)_(s2s\d{{3}})_({PAIR})_({RESOLUTION})(?:_(lsf))?_seg(\d+)", ("algorithm", "s2s_ver", "pairname", "res", "lsf", "segnum")),
    "strip_segment_file": (rf"([A-Z]+_s2s\d{{3}}_{PAIR}_{RESOLUTION}(?:_lsf)?_seg\d+)_(.+)", ("segment", "suffix")),
}
#: Resolutions in metres that names may have.
STANDARD_METERS = (0.5, 1.0, 2.0, 8.0)


def parse(s: Column, kind: str, how: str = "full") -> Column:
    """A struct with the parts of an identifier, or null. how: full, match (from the start) or search."""
    pattern, names = FORMATS[kind]
    anchored = {"full": rf"^(?:{pattern})$", "match": rf"^(?:{pattern})", "search": pattern}[how]
    parts = [F.nullif(F.regexp_extract(s, anchored, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)]
    return F.when(F.regexp_like(s, F.lit(anchored)), F.struct(*parts))


def find_all(s: Column, kind: str) -> Column:
    """All identifiers of a kind in a text."""
    return F.regexp_extract_all(s, F.lit(FORMATS[kind][0]), 0)


def pairname(sensor: Column, timestamp: Column, catid1: Column, catid2: Column) -> Column:
    """A pairname of its parts; null if the parts don't make a valid one."""
    name = F.concat_ws("_", sensor, timestamp, catid1, catid2)
    return F.when(F.regexp_like(name, F.lit(f"^{PAIR}$")), name)


def is_cross_track(strip_id: Column) -> Column:
    return F.regexp_like(F.substring(strip_id, 2, 1), F.lit("[0-9]"))


def version(s: Column, parts: int = 4) -> Column:
    """Comparable numbers of a dotted version, filled up with zeros."""
    numbers = F.transform(F.split(s, r"\."), lambda x: x.cast("int"))
    return F.slice(F.concat(numbers, F.array_repeat(F.lit(0), parts)), 1, parts)


def version_key(s: Column) -> Column:
    """A dotted version of three numbers as vMMmmpp."""
    return F.concat(F.lit("v"), F.array_join(F.transform(F.split(s, r"\."), lambda x: F.lpad(x, 2, "0")), ""))


def meters(s: Column) -> Column:
    """Metres of a resolution: a name (50cm, 2m) or a number, of which a whole 0 means half a metre. Others: null."""
    unit, number = F.regexp_extract(s, r"^(\d+)(cm|m)$", 2), F.regexp_extract(s, r"^(\d+)(?:cm|m)$", 1)
    value = F.when(unit == "m", number.try_cast("double")).when(unit == "cm", number.try_cast("double") / 100).when(s == "0", 0.5).otherwise(s.try_cast("double"))
    return F.when(value.isin(*STANDARD_METERS), value)


def resolution_name(m: Column) -> Column:
    return F.when(m == F.floor(m), F.concat(m.cast("int").cast("string"), F.lit("m"))).otherwise(F.concat(F.floor(m * 100).cast("int").cast("string"), F.lit("cm")))
