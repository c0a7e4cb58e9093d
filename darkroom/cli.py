"""Command line for the jobs: `python -m darkroom.cli <command> ...`
(or `spark-submit darkroom/cli.py <command> ...`).

The session comes from the environment (`spark-submit` / the cluster);
nothing here sets a master. Plans are written as Parquet; `--dry-run`, or no
`--plan-out`, prints every row instead. The results of uploads and deletes are
Parquet folders: (file_path, s3_key, source_type, file_size, md5_checksum,
status) and (file_path, outcome). Jobs number their versions themselves.

    catalogue --dir IMAGES --exif-dir JSON --catalogue BASE [--version N] [--limit N] [--batch-size 50]
    backup    --root TAG=DIR ... --ledger BASE --bucket B --plan-out DIR [--dry-run]
    uploaded  --ledger BASE --results DIR
    deletions --root TAG=DIR ... --ledger BASE --bucket B --plan-out DIR [--available TAG ...] [--dry-run]
    deleted   --root TAG=DIR ... --ledger BASE --audit BASE --bucket B --results DIR --run-id ID [--available TAG ...]
    card      --source CARD --internal DIR --external DIR --free-gb TEXT [--internal-missing] --plan-out DIR
    stack     --pages DIR --plan-out DIR [--dry-run]
    libraries --libraries DIR [--external-only]
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession


def _roots(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs:
        tag, _, path = p.partition("=")
        if not path:
            raise SystemExit(f"--root expects TAG=DIR, got {p!r}")
        out[tag] = path
    return out


def _now() -> str:
    return _dt.datetime.now().replace(microsecond=0).isoformat(sep=" ")


def _emit(df, out: str | None, dry_run: bool) -> None:
    """Write a plan, or print every row of it, a partition at a time."""
    if not dry_run and out:
        df.write.mode("overwrite").parquet(out)
        return
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> int:
    from darkroom.plans import jobs
    from darkroom.sources.json_records import libraries_to_scan, read_libraries

    ap = argparse.ArgumentParser(prog="darkroom")
    sub = ap.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("catalogue")
    c.add_argument("--dir", required=True)
    c.add_argument("--exif-dir", required=True)
    c.add_argument("--catalogue", required=True)
    c.add_argument("--version", type=int)
    c.add_argument("--limit", type=int, default=0)
    c.add_argument("--batch-size", type=int, default=50)

    b = sub.add_parser("backup")
    b.add_argument("--root", action="append", required=True)
    b.add_argument("--ledger", required=True)
    b.add_argument("--bucket", required=True)
    b.add_argument("--plan-out")
    b.add_argument("--dry-run", action="store_true")
    b.add_argument("--storage-class", help="storage class to request (the scripts send none)")

    u = sub.add_parser("uploaded")
    u.add_argument("--ledger", required=True)
    u.add_argument("--results", required=True)

    for name in ("deletions", "deleted"):
        d = sub.add_parser(name)
        d.add_argument("--root", action="append", required=True)
        d.add_argument("--ledger", required=True)
        d.add_argument("--bucket", required=True)
        d.add_argument("--available", action="append")
        if name == "deletions":
            d.add_argument("--plan-out")
            d.add_argument("--dry-run", action="store_true")
        else:
            d.add_argument("--audit", required=True)
            d.add_argument("--results", required=True)
            d.add_argument("--run-id", required=True, help="names the results: the same ones are applied once")

    k = sub.add_parser("card")
    k.add_argument("--source", required=True)
    k.add_argument("--internal", required=True)
    k.add_argument("--external", required=True)
    k.add_argument("--free-gb", default="0")
    k.add_argument("--internal-missing", action="store_true")
    k.add_argument("--plan-out")
    k.add_argument("--dry-run", action="store_true")
    k.add_argument("--validate-dates", action="store_true", help="digits that are no date go to the run date")

    s = sub.add_parser("stack")
    s.add_argument("--pages", required=True)
    s.add_argument("--plan-out")
    s.add_argument("--dry-run", action="store_true")

    lib = sub.add_parser("libraries")
    lib.add_argument("--libraries", required=True)
    lib.add_argument("--external-only", action="store_true")

    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"darkroom-{args.cmd}").getOrCreate()
    run_ts = _now()

    if args.cmd == "catalogue":
        counts = jobs.run_catalogue(spark, args.dir, args.exif_dir, args.catalogue, args.version, run_ts,
                                    args.limit, args.batch_size)
        print(f"processed {counts['processed']} images")
    elif args.cmd == "backup":
        plan = jobs.plan_backup(spark, _roots(args.root), args.ledger, args.bucket, run_ts, args.storage_class)
        _emit(plan, args.plan_out, args.dry_run)
    elif args.cmd == "uploaded":
        jobs.record_uploads(spark, args.ledger, spark.read.parquet(args.results), None, run_ts)
    elif args.cmd == "deletions":
        plan = jobs.plan_deletions(spark, _roots(args.root), args.ledger, args.bucket, run_ts, args.available)
        _emit(plan, args.plan_out, args.dry_run)
    elif args.cmd == "deleted":
        counts = jobs.record_deletions(spark, _roots(args.root), args.ledger, args.audit, spark.read.parquet(args.results),
                                       args.bucket, run_ts, args.run_id, args.available)
        _emit(counts, None, False)
    elif args.cmd == "card":
        volumes = spark.createDataFrame(
            [("internal", args.internal, not args.internal_missing, args.free_gb), ("external", args.external, True, "0")],
            "volume string, path string, exists boolean, free_gb string",
        )
        run_date = _dt.date.today().strftime("%Y/%m/%d")
        plan = jobs.plan_card_import(spark, args.source, volumes, run_date, args.validate_dates)
        _emit(plan, args.plan_out, args.dry_run)
    elif args.cmd == "stack":
        groups, requests = jobs.plan_stacks(spark, args.pages)
        _emit(requests, args.plan_out, args.dry_run)
    elif args.cmd == "libraries":
        _emit(libraries_to_scan(read_libraries(spark, args.libraries), args.external_only), None, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
