"""Command line: python -m tintwell.cli GROUP COMMAND ...; results are sorted JSON, errors redacted JSON and exit code 1."""

from __future__ import annotations

import argparse
import json
import re
import sys
from typing import Any

from pyspark.sql import SparkSession

from tintwell.functions.text import SECRET_RULES
from tintwell.operators import similarity
from tintwell.plans import catalog, manifest_build, similarity_run
from tintwell.plans.runs import Run, Workspace
from tintwell.sources import writers


def session() -> SparkSession:
    return SparkSession.builder.appName("tintwell").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def query_list(_: argparse.Namespace) -> Any:
    return {"queries": sorted(catalog.QUERIES), "with_sql": sorted(catalog.ORACLE_SQL)}


def query_run(a: argparse.Namespace) -> Any:
    catalog.QUERIES[a.name](session(), a.data).write.mode("errorifexists").parquet(a.output)
    return {"query": a.name, "rows": session().read.parquet(a.output).count()}


def manifest(a: argparse.Namespace) -> Any:
    spark = session()
    ws, run = Workspace(spark, a.workspace), Run(a.run_id, "manifest", {"catalog": a.catalog, "images": a.images, "snapshot": a.snapshot})
    if a.dry_run:
        return {"run_id": a.run_id, "dry_run": True}
    ws.begin(run)
    tables = {k: ws.write(run, k, v) for k, v in manifest_build.build(spark, a.catalog, a.images, a.snapshot).items()}
    broken = {r.rule: r.violations for r in manifest_build.validate(tables).collect() if r.violations}
    counts = {k: v.count() for k, v in tables.items()}
    ws.finish(run, "failed" if broken else "completed", counts=counts, violations=broken)
    return {"counts": counts, "violations": broken}


def _options(a: argparse.Namespace) -> similarity_run.Options:
    return similarity_run.Options(top_k=a.top_k, max_delta_e00=a.max_delta_e00)


def _chain(a: argparse.Namespace):
    read = session().read.parquet
    seen = similarity_run.observations(read(a.regions), read(a.texts), read(a.records), _options(a))
    made = similarity_run.profiles(seen)
    return seen, made, similarity_run.pairs(made)


def similarity_plan(a: argparse.Namespace) -> Any:
    """Counts alone; nothing is written."""
    seen, made, found = _chain(a)
    return similarity_run.summary(seen, seen, made, found, _options(a)).first().asDict()


def similarity_command(a: argparse.Namespace) -> Any:
    ws, run = Workspace(session(), a.workspace), Run(a.run_id, "shade-similarity", {"top_k": a.top_k, "max_delta_e00": a.max_delta_e00, "regions": a.regions})
    if not ws.begin(run, a.resume) and (done := ws.finished(a.run_id)):
        return done
    seen, made, _ = _chain(a)
    seen, made = ws.write(run, "observations", seen), ws.write(run, "profiles", made)
    found = ws.write(run, "pairs", similarity_run.pairs(made))
    near = ws.write(run, "topk", similarity_run.topk(found, _options(a)))
    counts = {"observations": seen.count(), "profiles": made.count(), "pairs": found.count(), "topk": near.count()}
    ws.finish(run, similarity.run_status(counts["profiles"]), **counts)
    return counts


def similarity_export(a: argparse.Namespace) -> Any:
    ws = Workspace(session(), a.workspace)
    profiles = ws.read("profiles", a.run_id)
    wide = writers.similarity_export(ws.read("pairs", a.run_id), profiles, "shade_id", ["shade_code", "color_hex"])
    writers.csv(wide, f"{a.output}/pairs", wide.columns, ["left_id", "right_id"])
    writers.csv(profiles, f"{a.output}/profiles", profiles.columns, ["shade_id"])
    topk = ws.read("topk", a.run_id)
    writers.csv(topk, f"{a.output}/topk", topk.columns, ["query_id", "rank"])
    return {"files": {r.path.rsplit(a.output, 1)[-1]: r.sha256 for r in writers.manifest(session(), a.output).collect() if r.path.endswith(".csv")}}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tintwell")
    groups = top.add_subparsers(dest="group", required=True)

    def command(group: Any, name: str, run: Any, *required: str) -> argparse.ArgumentParser:
        p = group.add_parser(name)
        p.set_defaults(run=run)
        for r in required:
            p.add_argument(f"--{r}", required=True)
        return p

    query = groups.add_parser("query").add_subparsers(required=True)
    command(query, "list", query_list)
    command(query, "run", query_run, "name", "data", "output")
    lineage = groups.add_parser("manifest").add_subparsers(required=True)
    command(lineage, "build", manifest, "workspace", "run-id", "catalog", "images", "snapshot").add_argument("--dry-run", action="store_true")
    shade = groups.add_parser("shade-similarity").add_subparsers(required=True)
    for name, run, needs in (("plan", similarity_plan, ("regions", "texts", "records")), ("run", similarity_command, ("regions", "texts", "records", "workspace", "run-id"))):
        p = command(shade, name, run, *needs)
        p.add_argument("--top-k", type=int, default=10)
        p.add_argument("--max-delta-e00", type=float)
        p.add_argument("--resume", action="store_true")
    command(shade, "export", similarity_export, "workspace", "run-id", "output")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        print(json.dumps(args.run(args), sort_keys=True, ensure_ascii=False, default=str))
        return 0
    except Exception as e:  # noqa: BLE001  whatever went wrong is told without secrets
        message = str(e)
        for _, pattern, _ in SECRET_RULES:
            message = re.sub(pattern, "[REDACTED]", message)
        print(json.dumps({"error": type(e).__name__, "message": message[:500]}, sort_keys=True), file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
