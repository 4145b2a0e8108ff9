"""Command line: ``python -m tablesync <job> ...``.

Jobs: ``copy-postgresql``, ``copy-oracle`` (schema copies over JDBC),
``copy-folder`` (a folder of tables, e.g. an export), ``sync-tracker``
(full or incremental document sync from a tracker's REST search).  Lists
take ``a,b`` or ``'a','b'``.  Prints the job's result frame.
"""

from __future__ import annotations

import argparse
import sys


def _lists(value: str | None) -> list[str]:
    from .sources.catalog import _as_list

    return _as_list(value)


def _sink(args):
    from .plans.sinks import Sink

    return Sink(
        format=args.sink_format, root=args.sink_root, dataset=args.dataset, bucket=args.bucket, versioned=args.versioned
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tablesync")
    sub = p.add_subparsers(dest="job", required=True)

    def copy_args(sp):
        sp.add_argument("--schema", required=True, help="schema (PostgreSQL) / owner (Oracle) / folder name")
        where = sp.add_mutually_exclusive_group(required=True)
        where.add_argument("--sink-root", help="folder the tables are written to")
        where.add_argument("--dataset", help="dataset of a connector that saves by name (--sink-format names it)")
        sp.add_argument("--bucket", default=None, help="connector: stage the loads in this bucket")
        sp.add_argument("--sink-format", default="parquet")
        sp.add_argument("--versioned", action="store_true", help="overwrite as a new committed version")
        sp.add_argument("--mode", default="overwrite", choices=["overwrite", "append", "ignore", "error"])
        sp.add_argument("--exclude", default="")
        sp.add_argument("--decimals", default="float", choices=["float", "double", "keep"])
        sp.add_argument("--parallelism", type=int, default=4)

    pg = sub.add_parser("copy-postgresql")
    copy_args(pg)
    pg.add_argument("--url", required=True)
    pg.add_argument("--only", default="")
    pg.add_argument("--partition-key", default=None, help="integer key that all copied tables have")
    pg.add_argument("--partition-hash", default=None, help="non-negative hash expression, e.g. abs(hashtext(code))")

    ora = sub.add_parser("copy-oracle")
    copy_args(ora)
    ora.add_argument("--url", required=True)
    ora.add_argument("--drop-unsupported", action="store_true", help="drop binary/map/array columns")
    ora.add_argument("--fetchsize", type=int, default=None)
    ora.add_argument("--partition-key", default=None, help="integer key that all copied tables have")
    ora.add_argument("--partition-hash", default=None, help="non-negative hash expression, e.g. ORA_HASH(code)")

    fo = sub.add_parser("copy-folder")
    copy_args(fo)
    fo.add_argument("--source-root", required=True)
    fo.add_argument("--source-format", default="parquet")
    fo.add_argument("--only", default="")
    fo.add_argument("--drop-unsupported", action="store_true")

    tr = sub.add_parser("sync-tracker")
    tr.add_argument("--url", required=True)
    tr.add_argument("--token", required=True)
    tr.add_argument("--project", required=True)
    tr.add_argument("--root", required=True, help="folder of the table family")
    tr.add_argument("--exclusion-fields", default="")
    tr.add_argument("--exclusion-types", default="")
    tr.add_argument("--full", action="store_true", help="force a full refresh")

    args = p.parse_args(argv)

    from .session import job_session

    spark = job_session(app_name=f"tablesync {args.job}")
    if args.job == "copy-postgresql":
        from .plans.jobs import copy_postgresql_schema

        out = copy_postgresql_schema(
            spark, args.url, args.schema, _sink(args), mode=args.mode, exclude=_lists(args.exclude),
            only=_lists(args.only), partition_key=args.partition_key, partition_hash=args.partition_hash, decimals=args.decimals, parallelism=args.parallelism,
        )
    elif args.job == "copy-oracle":
        from .plans.jobs import copy_oracle_schema

        out = copy_oracle_schema(
            spark, args.url, args.schema, _sink(args), mode=args.mode, exclude=_lists(args.exclude),
            drop_unsupported=args.drop_unsupported, fetchsize=args.fetchsize, partition_key=args.partition_key,
            partition_hash=args.partition_hash,
            decimals=args.decimals, parallelism=args.parallelism,
        )
    elif args.job == "copy-folder":
        from .plans.jobs import copy_catalog
        from .sources.catalog import folder_catalog
        from .sources.relational import TableSource

        source = TableSource(format=args.source_format, root=args.source_root, suffix=f".{args.source_format}")
        out = copy_catalog(
            spark, source, folder_catalog(spark, args.source_root, suffix=f".{args.source_format}"), args.schema,
            _sink(args), exclude=_lists(args.exclude), only=_lists(args.only), mode=args.mode,
            drop_unsupported=args.drop_unsupported, decimals=args.decimals, parallelism=args.parallelism,
        )
    else:
        from .operators.documents import field_map_of
        from .plans.jobs import sync_documents
        from .plans.sinks import TableFamily
        from .sources import documents as paged
        from .sources.tracker import fetch_for_sync

        paged.register(spark, paged.rest_fetcher)
        opts = {"url": args.url, "token": args.token, "project": args.project}
        fields = spark.read.format("paged_documents").options(resource="fields", **opts).load()
        types = spark.read.format("paged_documents").options(resource="types", **opts).load()
        out = sync_documents(
            spark, fetch_for_sync(spark, paged.rest_fetcher, **opts), TableFamily(spark, args.root), field_map=field_map_of(fields),
            exclude_fields=_lists(args.exclusion_fields), exclude_types=_lists(args.exclusion_types),
            types=types, force_full=args.full,
        )
    out.show(truncate=False)
    failed = "status" in out.columns and out.where("status <> 'ok'").limit(1).count() > 0
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
