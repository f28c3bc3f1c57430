"""Command line.

``service`` follows a feed and exits 1 if one of its queries fails. ``once``
updates given ids and exits 0 or 1. ``catch-up`` runs the changes of a table since
each wiki's resume point, which it keeps with the store. ``requeue`` runs the
pending batches of a stopped service again, and ``compact`` writes new bases of a
store and deletes what they cover.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from ebbsync.config import DEFAULT_DAYS_BACK, DEFAULT_NAMESPACES, DEFAULT_SCHEME, UpdaterConfig
from ebbsync.plans.update import Sources, catch_up, one_run, run_once
from ebbsync.session import configure
from ebbsync.sources.store import Store
from ebbsync.streaming.updater import Updater, run_until_one_stops


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--tables", required=True, help="folder with the tables wikis, snapshot, current")
    common.add_argument("--facts", action="store_true", help="read terms, statements, links instead of current")
    common.add_argument("--langs", default="", help="with --facts: languages of terms to keep, joined by commas")
    common.add_argument("--single-label", action="store_true", help="with --langs: one term per entity")
    common.add_argument("--skip-links", action="store_true", help="with --facts: leave out site links")
    common.add_argument("--types", action="store_true", help="also read the table entity_types and filter by it")
    common.add_argument("--store", required=True, help="folder of the store")
    common.add_argument("--namespaces", default=DEFAULT_NAMESPACES)
    common.add_argument("--scheme", default=DEFAULT_SCHEME)
    common.add_argument("--ingress")
    common.add_argument("--verify", action="store_true")
    common.add_argument("--dump-dir")
    root = argparse.ArgumentParser(prog="ebbsync", description=__doc__)
    commands = root.add_subparsers(dest="command", required=True)
    for name in ("service", "requeue"):
        command = commands.add_parser(name, parents=[common])
        command.add_argument("--feed", required=name == "service", default="", help="folder that poll files arrive in")
        command.add_argument("--feed-format", choices=("files", "parquet"), default="files")
        command.add_argument("--state", required=True, help="folder of checkpoints and landed batches")
        command.add_argument("--interval", type=int, default=0, help="seconds between passes")
        command.add_argument("--pass-limit", type=int, default=-1, help="passes of this run; -1 runs without a limit")
        command.add_argument("--max-files", type=int, help="most files a pass takes up")
        command.add_argument("--compact-every", type=int, default=8, help="parts of one size to merge into one")
        command.add_argument("--keep-epochs", type=int, default=100, help="merged epochs to leave")
        command.add_argument("--max-tries", type=int, default=0, help="answers after which a batch is set aside")
    catching = commands.add_parser("catch-up", parents=[common])
    catching.add_argument("--changes", default="changes", help="table of changes in the folder of tables")
    catching.add_argument("--start", type=datetime.fromisoformat, help="run all changes since this time")
    catching.add_argument("--days-back", type=int, default=DEFAULT_DAYS_BACK, help="for wikis without a resume point")
    compact = commands.add_parser("compact")
    compact.add_argument("--store", required=True, help="folder of the store")
    compact.add_argument("--keep-epochs", type=int, default=0, help="merged epochs to leave")
    once = commands.add_parser("once", parents=[common])
    for name in ("domain", "backend", "namespace"):
        once.add_argument(f"--{name}", required=True)
    once.add_argument("--ids", required=True, help="entity ids, joined by commas")
    return root


def read_sources(spark: SparkSession, folder: str, cfg: UpdaterConfig, facts: bool, types: bool) -> Sources:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    entity_types = table("entity_types") if types else None
    if not facts:
        return Sources(table("wikis"), table("snapshot"), table("current"), entity_types)
    names = ("wikis", "snapshot", "terms", "statements", "links")
    return Sources.from_facts(*[table(name) for name in names], cfg, entity_types)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command != "compact" and not args.facts and (args.langs or args.single_label or args.skip_links):
        parser().error("--langs, --single-label and --skip-links clean facts: they need --facts")
    spark = configure(SparkSession.builder.appName("ebbsync").getOrCreate())
    if args.command == "compact":
        store = Store(spark, args.store)
        epoch = store.next_epoch() - 1
        if epoch >= 0:
            store.compact(epoch)
            store.expire(args.keep_epochs)
        return 0
    cfg = UpdaterConfig(
        namespaces=args.namespaces,
        scheme=args.scheme,
        ingress=args.ingress,
        langs=tuple(lang for lang in args.langs.split(",") if lang),
        single_label=args.single_label,
        skip_links=args.skip_links,
        verify=args.verify,
        dump_dir=args.dump_dir,
        feed_format=getattr(args, "feed_format", "files"),
        interval_s=getattr(args, "interval", 0),
        pass_limit=getattr(args, "pass_limit", -1),
        max_files_per_trigger=getattr(args, "max_files", None),
        compact_every=getattr(args, "compact_every", 8),
        keep_epochs=getattr(args, "keep_epochs", 100),
        max_tries=getattr(args, "max_tries", 0),
        days_back=getattr(args, "days_back", DEFAULT_DAYS_BACK),
    )

    def sources() -> Sources:
        return read_sources(spark, args.tables, cfg, args.facts, args.types)

    store = Store(spark, args.store, cfg.max_records_per_file)
    if args.command == "once":
        requests = one_run(spark, args.domain, args.backend, args.namespace, args.ids)
        return 0 if run_once(requests, sources(), store, cfg) else 1
    if args.command == "catch-up":
        changes = spark.read.parquet(f"{args.tables}/{args.changes}")
        return 0 if catch_up(changes, None, sources(), store, cfg, args.start) else 1

    def report(counts: dict) -> None:
        print("ebbsync: " + ", ".join(f"{name} {value}" for name, value in counts.items()), flush=True)

    updater = Updater(spark, args.feed, args.state, sources, store, cfg, report)
    try:
        if args.command == "requeue":
            updater.requeue()
        elif cfg.pass_limit != -1:
            updater.run_passes(cfg.pass_limit)
        else:
            run_until_one_stops([updater.start_landing(), updater.start_update()])
    except StreamingQueryException as failure:
        print(f"ebbsync: {failure}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
