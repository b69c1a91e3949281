"""Questions to a catalog folder, answered as JSON lines, and work on it:

    python -m ark FOLDER stats | audit | verify | full-audit | digests | names | achievements
    python -m ark FOLDER view NAME
    python -m ark FOLDER import --path FILES --platform CODE --at TIME
    python -m ark FOLDER edition --path COPY
    python -m ark FOLDER regroup --path COPY --cap BYTES
    python -m ark FOLDER export --path SET [--archives]
    python -m ark FOLDER report --path CSV

``audit``, ``verify`` and ``full-audit`` exit with 1 if they find anything.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from .catalog import Catalog
from .operators import exporting, importing, release, reports, storage, upkeep
from .plans.views import VIEWS
from .session import session
from .sources import files

FINDINGS = ("audit", "verify", "full-audit")
WORK = ("import", "edition", "regroup", "export", "report")


def listed_members(catalog: Catalog):
    """(game, name, object_id) of the files that came into the catalog, games by their families."""
    families = catalog.object_families.groupBy("object_id").agg(F.min("family_key").alias("game"))
    return catalog.files.where("kind = 'rom'").join(families, "object_id").select("game", F.col("original_name").alias("name"), "object_id")


def work(catalog: Catalog, args: argparse.Namespace) -> dict:
    """What was done, as counts."""
    if args.what == "import":
        return importing.import_files(catalog, files.members(catalog.spark, args.path), args.platform, args.at)
    if args.what == "edition":
        return {r.name: r.n for r in catalog.without_payload(args.path).stats().where("n > 0").collect()}  # one row for each table
    if args.what == "regroup":
        return {"groups": storage.regroup(catalog, args.path, args.cap).compression_groups.count()}
    if args.what == "export":
        done = exporting.export_set(catalog, listed_members(catalog), args.path, archives=args.archives)
        return {r.status: r["count"] for r in done.groupBy("status").count().collect()}  # one row for each status
    release.write_report(reports.achievement_games(catalog), args.path, ["category", "title", "ra_game_id"])
    return {"report": args.path}


def main(given: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("folder")
    parser.add_argument("what", choices=("stats", "digests", "names", "achievements", "view", *FINDINGS, *WORK))
    parser.add_argument("name", nargs="?", choices=sorted(VIEWS))
    for option in ("--path", "--platform", "--at", "--master"):
        parser.add_argument(option)
    parser.add_argument("--cap", type=int, default=storage.CAP)
    parser.add_argument("--archives", action="store_true")
    args = parser.parse_args(given)
    if args.what == "view" and not args.name or args.what in WORK and not args.path or args.what == "import" and not (args.platform and args.at):
        parser.error(f"{args.what} needs more: see the help")
    catalog = Catalog(session(args.master), args.folder)
    if args.what in WORK:
        print(json.dumps(work(catalog, args)))
        return 0
    asked = {
        "stats": catalog.stats, "audit": catalog.audit, "digests": catalog.digests, "verify": lambda: storage.verify(catalog), "full-audit": lambda: upkeep.full_audit(catalog),
        "names": lambda: upkeep.import_counts(catalog), "achievements": lambda: reports.achievement_summary(reports.achievement_games(catalog)), "view": lambda: VIEWS[args.name](catalog),
    }
    n = 0
    for line in asked[args.what]().toJSON().toLocalIterator():
        print(line)
        n += 1
    return int(n > 0 and args.what in FINDINGS)


if __name__ == "__main__":
    raise SystemExit(main())
