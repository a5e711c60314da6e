"""Text files about scenes and strips: readers, and the strip metadata writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(file, line_no, line): whole files as rows, so that lines keep their numbers."""
    whole = spark.read.options(wholetext=True, **options).text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r", "").alias("value"))
    return whole.select("file", F.posexplode(F.split("value", "\n", -1)).alias("line_no", "line"))


def key_values(lines: DataFrame) -> DataFrame:
    """(file, line_no, key, val_str, val_num) of key=value lines.

    Keys are lower-cased with _ for blanks. A key that occurs twice without a prefix is taken as image_1_ and image_2_, in order."""
    parts = F.split("line", "=", 2)
    kv = lines.where(F.contains("line", F.lit("="))).select("file", "line_no", F.replace(F.lower(F.trim(parts[0])), F.lit(" "), F.lit("_")).alias("bare"), F.trim(parts[1]).alias("val_str"))
    each = Window.partitionBy("file", "bare")
    nth, n = F.row_number().over(each.orderBy("line_no")), F.count("*").over(each)
    key = F.when((n > 1) & ~F.regexp_like("bare", F.lit("^image_[12]")), F.concat(F.lit("image_"), nth.cast("string"), F.lit("_"), "bare")).otherwise(F.col("bare"))
    return kv.select("file", "line_no", key.alias("key"), "val_str", F.col("val_str").try_cast("double").alias("val_num"))


def scene_meta(lines: DataFrame) -> DataFrame:
    """(file, meta, sensor): all values of a scene in a map, and the sensor that the first image's name begins with."""
    kv = key_values(lines)
    last = kv.groupBy("file", "key").agg(F.max_by("val_str", "line_no").alias("val_str"))
    per = last.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("key", "val_str"))).alias("meta"))
    image = F.coalesce(F.try_element_at("meta", F.lit("image_1")), F.try_element_at("meta", F.lit("image_1_image")))
    return per.withColumn("sensor", F.substring(F.regexp_extract(image, r"([^/]*)$", 1), 1, 4))


def xml_values(text: Column, tags: list[str]) -> Column:
    """A map of the first value of each tag, with or without a namespace prefix; absent tags are null."""
    items = []
    for tag in tags:
        pattern = rf"<(?:[\w.-]+:)?{tag}(?:\s[^>]*)?>\s*([^<]*?)\s*</"
        items += [F.lit(tag), F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))]
    return F.create_map(*items)


def sections(lines: DataFrame, markers: list[str]) -> DataFrame:
    """lines with the marker that begins the section they stand in (null before the first)."""
    marker = F.get(F.filter(F.array(*map(F.lit, markers)), lambda m: F.startswith(F.trim("line"), m)), 0)
    upto = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.last(marker, ignorenulls=True).over(upto))


#: First words of a strip document's sections, in order.
STRIP_SECTIONS = ["Strip Metadata", "Strip Footprint Vertices", "Mosaicking Alignment Statistics", "Filtering Applied", "Data Coverage Statistics", "Elevation Statistics", "Scene Metadata"]
_ALIGNMENT = ("scene", "rmse", "dz", "dx", "dy", "dz_err", "dx_err", "dy_err")


def strip_alignment(lines: DataFrame) -> DataFrame:
    """(file, ord, scene, rmse, dz, ...): the alignment table of strip documents; nan rows are redundant scenes."""
    inside = sections(lines, STRIP_SECTIONS).where("section = 'Mosaicking Alignment Statistics'")
    row = F.split(F.trim("line"), r"\s+")
    table = inside.where((F.size(row) == len(_ALIGNMENT)) & ~F.contains("line", F.lit(","))).withColumn("_v", row)
    number = F.row_number().over(Window.partitionBy("file").orderBy("line_no"))
    return table.select("file", number.alias("ord"), F.col("_v")[0].alias("scene"), *[F.nullif(F.col("_v")[i + 1].try_cast("double"), F.lit(float("nan"))).alias(n) for i, n in enumerate(_ALIGNMENT[1:])])


def strip_coverage(lines: DataFrame) -> DataFrame:
    """(file, metric, value) of the coverage section; NA is null."""
    inside = sections(lines, STRIP_SECTIONS).where("section = 'Data Coverage Statistics'").where(F.contains("line", F.lit(": ")))
    parts = F.split("line", ": ", 2)
    return inside.select("file", F.trim(parts[0]).alias("metric"), parts[1].try_cast("double").alias("value"))


def translation(lines: DataFrame) -> DataFrame:
    """(file, dz, dx, dy) from registration files."""
    found = F.regexp_extract("line", r"Translation Vector \(dz,dx,dy\)\(m\)=\s*(.*)$", 1)
    v = F.split(found, r",\s*")
    return lines.where(found != "").select("file", *[v[i].try_cast("double").alias(n) for i, n in enumerate(("dz", "dx", "dy"))])


def residuals(lines: DataFrame) -> DataFrame:
    """(file, mean_res, median_res, dz, dx, dy) from registration files."""
    pick = lambda name: F.max(F.nullif(F.regexp_extract("line", rf"{name} Vertical Residual[^=]*=\s*(\S+)", 1), F.lit(""))).try_cast("double")
    per = lines.groupBy("file").agg(pick("Mean").alias("mean_res"), pick("Median").alias("median_res"))
    return per.join(translation(lines), "file", "left")


def task_list(spark: SparkSession, path: str, delimiter: str = ",", names: tuple[str, ...] | None = None) -> DataFrame:
    """A delimited list; all columns are text."""
    df = spark.read.csv(path, sep=delimiter)
    return df.toDF(*names) if names else df


def strip_document(head: DataFrame, alignment: DataFrame, coverage: DataFrame, scenes: DataFrame, cutoff: float = 3.5) -> DataFrame:
    """(strip_id, document): the strip's metadata text.

    head: (strip_id, created, proj4, x, y arrays, mask, low, high); alignment: (strip_id, ord, scene, rmse,
    dz .. dy_err); coverage: (strip_id, ord, metric, value); scenes: (strip_id, ord, scene, meta_text)."""
    number = lambda c: F.when(F.col(c).isNull(), "nan").otherwise(F.format_string("%.4f", F.col(c)))
    line = F.concat_ws(" ", "scene", *[number(c) for c in _ALIGNMENT[1:]])

    def ordered(df: DataFrame, text: Column, name: str) -> DataFrame:
        return df.groupBy("strip_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", text.alias("t")))), lambda x: x["t"]), "\n").alias(name))

    a = ordered(alignment, line, "_a")
    c = ordered(coverage, F.concat_ws(": ", "metric", F.coalesce(F.col("value").cast("string"), F.lit("NA"))), "_c")
    s = ordered(scenes, F.concat(F.lit("scene "), F.col("ord").cast("string"), F.lit(" name="), "scene", F.lit("\n"), "meta_text"), "_s")
    doc = head.join(a, "strip_id", "left").join(c, "strip_id", "left").join(s, "strip_id", "left")
    coords = lambda x: F.array_join(F.transform(x, lambda v: v.cast("string")), " ")
    text = F.concat_ws(
        "\n", F.lit("Strip Metadata"), F.concat(F.lit("Creation Date: "), "created"), F.concat(F.lit("Strip projection (proj4): '"), "proj4", F.lit("'")), F.concat(F.lit("Strip DEM ID: "), "strip_id"), F.lit(""),
        F.lit("Strip Footprint Vertices"), F.concat(F.lit("X: "), coords("x")), F.concat(F.lit("Y: "), coords("y")), F.lit(""),
        F.lit(f"Mosaicking Alignment Statistics (meters, rmse-cutoff={cutoff})"), F.lit(", ".join(_ALIGNMENT)), F.coalesce("_a", F.lit("")), F.lit(""),
        F.concat(F.lit("Filtering Applied: "), "mask"), F.lit(""), F.lit("Data Coverage Statistics"), F.coalesce("_c", F.lit("")), F.lit(""),
        F.lit("Elevation Statistics"), F.concat(F.lit("Minimum elevation: "), F.col("low").cast("string")), F.concat(F.lit("Maximum elevation: "), F.col("high").cast("string")), F.lit(""),
        F.lit("Scene Metadata"), F.coalesce("_s", F.lit("")),
    )
    return doc.select("strip_id", text.alias("document"))


def remerged(alignment: DataFrame, outer: DataFrame) -> DataFrame:
    """Alignment of scenes within segments that were merged again: the segment's own offset is added, errors in quadrature."""
    o = outer.select(F.col("scene").alias("segment"), *[F.col(c).alias(f"_{c}") for c in _ALIGNMENT[2:]])
    both = alignment.join(o, "segment")
    moved = {c: F.col(c) + F.col(f"_{c}") for c in ("dz", "dx", "dy")}
    wider = {c: F.sqrt(F.col(c) * F.col(c) + F.col(f"_{c}") * F.col(f"_{c}")) for c in ("dz_err", "dx_err", "dy_err")}
    return both.withColumns(moved | wider).drop(*[f"_{c}" for c in _ALIGNMENT[2:]])
