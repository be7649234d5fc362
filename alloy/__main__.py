"""Command line: run medallion stages as one Spark application.

    spark-submit --py-files alloy.zip -m alloy --root hdfs:///lab --rows 2000000 \\
        --run-id 2026-12-02 --stages extract,transform,model,load

``--keys-table`` (a parquet path) and ``--key`` generate one bronze row per key
of an existing table instead of ids 1..rows. Prints one JSON line with the
per-stage results. The session is the one spark-submit provides; its
``spark.checkpoint.dir`` is left as the cluster sets it.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from alloy.session import HUGE_METHOD_LIMIT


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="alloy")
    p.add_argument("--root", required=True, help="shared folder for layers, model registry, sinks, audit")
    p.add_argument("--rows", type=int, default=2_000_000, help="generate ids 1..rows (ignored with --keys-table)")
    p.add_argument("--keys-table", help="parquet path whose key column seeds the bronze rows")
    p.add_argument("--key", default="sample_id", help="bigint key column of --keys-table")
    p.add_argument("--run-id", required=True, help="names the run: a repeated one replaces its own rows")
    p.add_argument("--stages", default="extract,transform,model,load")
    p.add_argument("--partitions", type=int, default=None, help="fixed file count per layer (default: follow upstream)")
    p.add_argument("--trees", type=int, default=100)
    p.add_argument("--depth", type=int, default=6)
    p.add_argument("--dedup", choices=("rows", "measurements"), default="rows")
    p.add_argument("--sink-format", default="parquet")
    for name in ("sink", "report", "audit"):
        p.add_argument(f"--{name}-option", action="append", default=[], metavar="KEY=VALUE",
                       help=f"option of the {name} sink; with any, the sink is named by its options alone")
    p.add_argument("--report-format", default="json")
    p.add_argument("--audit-format", default="parquet")
    p.add_argument("--gold-mode", choices=("copy", "view"), default="copy",
                   help="copy: write gold partitioned by condition; view: read gold from flag-sorted silver")
    return p.parse_args(argv)


def options(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from alloy.plans import medallion

    args = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName("alloy").config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_LIMIT).getOrCreate()
    if args.keys_table:
        keys, key = spark.read.parquet(args.keys_table), args.key
    else:
        keys, key = spark.range(1, args.rows + 1).withColumnRenamed("id", "sample_id"), "sample_id"
    cfg = medallion.RunConfig(
        run_id=args.run_id,
        partitions=args.partitions,
        trees=args.trees,
        depth=args.depth,
        dedup=args.dedup,
        sink_format=args.sink_format,
        sink_options=options(args.sink_option),
        sink_path="" if args.sink_option else None,
        report_format=args.report_format,
        report_options=options(args.report_option),
        audit_format=args.audit_format,
        audit_options=options(args.audit_option),
        gold_mode=args.gold_mode,
    )
    stages = [s.strip() for s in args.stages.split(",") if s.strip()]
    unknown = set(stages) - set(medallion.STAGES)
    if unknown:
        raise SystemExit(f"unknown stages: {sorted(unknown)}")
    out = medallion.run(spark, keys, key, medallion.Paths(args.root.rstrip("/")), cfg, stages)
    result = {}
    for name, value in out.items():
        if hasattr(value, "first"):
            value = value.first().asDict()
        result[name] = value
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
