"""Programs on the command line: python -m orogrid <program> --help."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orogrid.plans import check, masks, programs
from orogrid.ship import ship


def _pairs(text: str) -> tuple[str, str]:
    key, sep, value = text.partition("=")
    if not sep:
        raise argparse.ArgumentTypeError(f"{text}: NAME=VALUE is needed")
    return key, value


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="orogrid", description="Raster tables are folders of Parquet: rid, r, c and bands.")
    sub = p.add_subparsers(dest="program", required=True)
    a = sub.add_parser("mask", help="quality masks of scenes (z, m, o)")
    a.add_argument("src"), a.add_argument("dst")
    a.add_argument("--sun", type=float, required=True, help="mean sun elevation in degrees")
    a.add_argument("--res", type=float, default=8.0)
    a.add_argument("--version", choices=sorted(masks.VERSIONS), default="bitmask")
    a = sub.add_parser("apply-mask", help="fill masked pixels of bands")
    a.add_argument("src"), a.add_argument("mask"), a.add_argument("dst")
    a.add_argument("--parts", nargs="+", choices=sorted(programs.BITS), default=sorted(programs.BITS))
    a.add_argument("--fill", nargs="+", type=_pairs, required=True, help="BAND=VALUE; BAND=null")
    a = sub.add_parser("strips", help="merge the scenes of a strip into segments")
    a.add_argument("src"), a.add_argument("dst")
    a.add_argument("--cell", type=float, default=2.0)
    a.add_argument("--rmse-cutoff", type=float, default=3.5)
    a.add_argument("--least-new", type=int, default=50_000, help="unmasked pixels that a scene must add")
    a.add_argument("--least-overlap", type=int, default=1000, help="common pixels that a registration needs")
    a = sub.add_parser("diff", help="difference of two strips (z) after registration")
    a.add_argument("fixed"), a.add_argument("moving"), a.add_argument("dst")
    a.add_argument("--cell", type=float, default=2.0)
    a.add_argument("--guess", type=float, nargs=3, metavar=("DZ", "DX", "DY"))
    a.add_argument("--window", type=int, nargs=2, metavar=("ROWS", "COLS"))
    a = sub.add_parser("resample", help="bands at another resolution")
    a.add_argument("src"), a.add_argument("dst")
    a.add_argument("--factor", type=float, required=True)
    a.add_argument("--bands", nargs="+", type=_pairs, required=True, help="COLUMN=dem|matchtag|ortho|ortho2|bitmask")
    a = sub.add_parser("check", help="parts that file groups below a folder lack")
    a.add_argument("src")
    a.add_argument("--profile", choices=sorted(check.PROFILES), required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs a program; 1 if a check found something missing."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"orogrid {args.program}").getOrCreate()
    ship(spark)
    read = lambda path: spark.read.parquet(path)
    if args.program == "mask":
        programs.mask_scenes(read(args.src), args.sun, args.res, args.version).write.mode("overwrite").parquet(args.dst)
    elif args.program == "apply-mask":
        fills = {k: None if v == "null" else float(v) for k, v in args.fill}
        programs.mask_bands(read(args.src), read(args.mask), args.parts, fills).write.mode("overwrite").parquet(args.dst)
    elif args.program == "strips":
        for k, segment in enumerate(programs.build_strips(read(args.src), args.cell, rmse_cutoff=args.rmse_cutoff, least_new=args.least_new, least_overlap=args.least_overlap)):
            segment.pixels.write.mode("overwrite").parquet(f"{args.dst}/seg{k + 1}")
            for row in segment.alignment:
                print(k + 1, *row)
    elif args.program == "diff":
        out, found = programs.difference(read(args.fixed), read(args.moving), args.cell, tuple(args.guess) if args.guess else None, tuple(args.window) if args.window else None)
        out.write.mode("overwrite").parquet(args.dst)
        print("offset (z, x, y):", *found.offset, "rmse:", found.rmse)
    elif args.program == "resample":
        programs.resample_bands(read(args.src), dict(args.bands), args.factor).write.mode("overwrite").parquet(args.dst)
    else:
        lacking = programs.check_tree(spark, args.src, args.profile)
        rows = lacking.groupBy("part").agg(F.count("*").alias("groups"), F.min("grp").alias("first")).orderBy("part").collect()  # a row for each kind of part
        for r in rows:
            print(f"{r.part}: missing in {r.groups} groups, first {r.first}")
        return int(bool(rows))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())


