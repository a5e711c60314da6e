"""Completeness and validity of file sets, incremental work lists, ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.functions import ids
from orogrid.operators import relations

#: Keys that a scene's metadata has, each once for either image, and the form of their values.
SCENE_KEYS = {
    "image": r"[\d\w_\-/]+\.tif",
    "mean_sun_azimuth_angle": r"\d+\.?\d*",
    "mean_sun_elevation": r"\d+\.?\d*",
    "mean_sat_azimuth_angle": r"\d+\.?\d*",
    "mean_sat_elevation": r"-?\d+\.?\d*",
    "effbw": r"\d+\.?\d*",
    "abscalfact": r"\d+\.?\d*",
    "tdi": r"\d+",
    "min": r"\d+",
    "max": r"\d+",
    "wv_correct": r"[01]",
    "asp_build_id": r"(?:[0-9A-F]+)?",
}
#: Least and most of valid pixels by band, nodata aside.
VALID = {"dem": (-8000.0, 100000.0, -9999.0), "matchtag": (0.0, 1.0, None)}
#: Kinds of checks, with the identifier that groups files and the parts that a group needs.
PROFILES = {
    "scenes": ("scene_dem", ("dem.tif", "matchtag.tif", "meta.txt", "ortho.tif")),
    "pairnames": ("pairname", ("dem.tif", "matchtag.tif", "meta.txt", "ortho.tif")),
    "strip-segments": ("strip_segment", ("dem.tif", "matchtag.tif", "bitmask.tif", "mdf.txt", "meta.txt", "ortho.tif")),
    "strips": ("strip_dem", ("dem.tif", "matchtag.tif", "bitmask.tif", "mdf.txt", "meta.txt", "ortho.tif")),
    "scene-meta": ("scene_dem", ("meta.txt",)),
    "strip-meta": ("strip_segment", ("meta.txt",)),
}


def group_files(files: DataFrame, kind: str, name: str = "fname") -> DataFrame:
    """files with the group that the identifier in their name makes, and the rest of the name as part. Others are left out."""
    pattern = ids.FORMATS[kind][0]
    found = F.regexp_extract(F.col(name), pattern, 0)
    rest = F.ltrim(F.substr(F.col(name), F.length(found) + F.instr(F.col(name), found)), F.lit("_"))
    return files.withColumns({"grp": F.nullif(found, F.lit("")), "part": rest}).where("grp is not null")


def missing(files: DataFrame, profile: str, name: str = "fname", optional: tuple[str, ...] = ()) -> DataFrame:
    """(grp, part) that groups lack; a second ortho only for pairs taken from two tracks."""
    kind, parts = PROFILES[profile]
    grouped = group_files(files, kind, name)
    lacking = relations.missing_parts(grouped, "grp", "part", [p for p in parts if p not in optional])
    if "ortho.tif" in parts:
        pairs = grouped.where(ids.is_cross_track(F.col("grp"))).select("grp").distinct().select("grp", F.lit("ortho2.tif").alias("part"))
        lacking = lacking.union(pairs.join(grouped.select("grp", "part"), ["grp", "part"], "left_anti"))
    return lacking


def status(grouped: DataFrame, checked: DataFrame, errors: DataFrame) -> DataFrame:
    """(grp, files, done, failed, new, stale, state) of each group: how many files were checked, failed, are new or gone since."""
    src = grouped.select("grp", "fname").distinct().withColumn("_s", F.lit(1))
    led = checked.select("grp", "fname").distinct().withColumn("_c", F.lit(1))
    bad = errors.select("grp", "fname").distinct().withColumn("_e", F.lit(1))
    all_ = src.join(led, ["grp", "fname"], "full").join(bad, ["grp", "fname"], "left")
    per = all_.groupBy("grp").agg(
        F.count("_s").alias("files"), F.count_if(F.col("_s").isNotNull() & F.col("_c").isNotNull()).alias("done"), F.count("_e").alias("failed"),
        F.count_if(F.col("_c").isNull()).alias("new"), F.count_if(F.col("_s").isNull()).alias("stale"),
    )
    state = F.when(F.col("failed") > 0, "error").when(F.col("new") + F.col("stale") > 0, "to check").otherwise("done")
    return per.withColumn("state", state)


def work_list(grouped: DataFrame, checked: DataFrame, errors: DataFrame, retry_failed: bool = True) -> DataFrame:
    """Files of groups that are new, changed or (retry_failed) had errors."""
    todo = status(grouped, checked, errors).where(F.col("state").isin("to check", *(["error"] if retry_failed else []))).select("grp")
    return grouped.join(todo, "grp", "left_semi")


def removal_plan(grouped: DataFrame, lacking: DataFrame, errors: DataFrame) -> DataFrame:
    """(grp, fname, why): what could be deleted, as a plan only."""
    a = grouped.join(lacking.select("grp").distinct(), "grp", "left_semi").select("grp", "fname", F.lit("incomplete").alias("why"))
    return a.union(grouped.join(errors.select("grp").distinct(), "grp", "left_semi").select("grp", "fname", F.lit("error").alias("why")))


def meta_problems(lines: DataFrame) -> DataFrame:
    """(file, problem) from scene metadata (file, line_no, key, value): keys not there twice, values of a wrong form, missing correction."""
    rules = F.create_map(*[F.lit(x) for pair in SCENE_KEYS.items() for x in pair])
    bare = F.regexp_replace(F.lower(F.regexp_replace("key", " ", "_")), r"^image_[12]_", "")
    bare = F.when(F.regexp_like(bare, F.lit("^image_[12]$")), "image").otherwise(bare)
    known = lines.withColumn("bare", bare).withColumn("rule", F.try_element_at(rules, F.col("bare"))).where("rule is not null")
    wrong = known.where(~F.regexp_like(F.col("value"), F.concat(F.lit("^(?:"), F.col("rule"), F.lit(")$")))).select("file", F.concat(F.lit("value: "), "bare").alias("problem"))
    wanted = lines.select("file").distinct().select("file", F.explode(F.array(*map(F.lit, SCENE_KEYS))).alias("bare"))
    counts = known.groupBy("file", "bare").agg(F.count("*").alias("n"))
    twice = wanted.join(counts, ["file", "bare"], "left").where("coalesce(n, 0) <> 2").select("file", F.concat(F.lit("count: "), "bare").alias("problem"))
    sensor = known.where("bare = 'image'").select("file", F.regexp_extract("value", r"(?:^|/)([A-Z]{2}\d{2})[^/]*$", 1).alias("sat"))
    uncorrected = known.where("bare = 'wv_correct' and value <> '1'").join(sensor.where("sat in ('WV01', 'WV02')").select("file", "sat").distinct(), "file")
    excused = lines.where(F.lower("key").like("%gen_time%")).select("file").distinct().withColumn("_g", F.lit(True))
    fix = uncorrected.join(excused, "file", "left").where("sat = 'WV01' or _g is null").select("file", F.lit("wv_correct").alias("problem"))
    return wrong.union(twice).union(fix).distinct()


def invalid_pixels(df: DataFrame, band: str, value: str = "v") -> DataFrame:
    low, high, nodata = VALID[band]
    bad = ~F.col(value).between(low, high)
    return df.where(F.col(value).isNotNull() & (bad if nodata is None else bad & (F.col(value) != nodata)))


def group_version(scenes: DataFrame, group: str, version: str, declared: str) -> DataFrame:
    """(group, version, conflict): the declared group version if any, else the least version; conflict if several are declared."""
    parts = ids.version(F.col(version))
    per = scenes.groupBy(group).agg(F.min(F.struct(parts.alias("k"), F.col(version).alias("v"))).alias("_l"), F.collect_set(declared).alias("_d"))
    chosen = F.when(F.size("_d") > 0, F.array_min("_d")).otherwise(F.col("_l.v"))
    return per.select(group, chosen.alias("version"), (F.size("_d") > 1).alias("conflict"))


def newer(a: Column, b: Column) -> Column:
    return ids.version(a) > ids.version(b)
