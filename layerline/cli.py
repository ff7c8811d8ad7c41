"""Command line: python -m layerline.cli COMMAND [options]. Each command is one stage of plans.pipeline."""

from __future__ import annotations

import argparse
import json
import sys

from .errors import EngineError
from .operators import builds, validate
from .plans import pipeline
from .schemas import VIEWS
from .sources import fetch, raw, registry

COMMANDS = ("fetch", "import-baseline", "parse-overlay", "reconcile", "parse-profile", "validate", "export", "build", "diff", "show", "render-embeddings", "import-workbook")
#: Other names that the commands answer to.
ALIASES = {"import-nist": "import-baseline", "parse-canada": "parse-overlay", "import-profile-spreadsheet": "import-workbook"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="layerline")
    p.add_argument("command", choices=(*COMMANDS, *ALIASES))
    p.add_argument("what", nargs="*", help="record id (show), workbook (import-workbook), two data roots (diff)")
    p.add_argument("--output", default="data", help="data root")
    p.add_argument("--registry", default="config/sources.yaml")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--json", action="store_true")
    p.add_argument("--publication")
    p.add_argument("--family")
    p.add_argument("--offline", action="store_true")
    p.add_argument("--force-fetch", action="store_true")
    p.add_argument("--baseline-ref", "--nist-ref", dest="baseline_ref")
    p.add_argument("--allow-newer", "--allow-newer-oscal", dest="allow_newer", action="store_true")
    p.add_argument("--upstream", action="store_true")
    p.add_argument("--view", default=VIEWS[0])
    return p


def run(spark, args: argparse.Namespace) -> tuple[int, str]:
    """(exit code, text) of one command."""
    known = registry.load_registry(args.registry) if args.command not in ("diff", "show") else {}
    c = pipeline.Config(args.output, known, strict=args.strict, run_at=raw.now_text())
    text = lambda x: json.dumps(x, indent=2, ensure_ascii=False, default=str)
    match ALIASES.get(args.command, args.command):
        case "fetch":
            got = fetch.fetch_all(spark, known, c.root, c.run_at[:10], offline=args.offline, force=args.force_fetch, ref=args.baseline_ref, publication=args.publication, strict=args.strict)
            return 0, text({k: [str(p) for p in v] for k, v in got.items()})
        case "import-baseline":
            return 0, text(pipeline.import_baseline(spark, c, args.allow_newer))
        case "parse-overlay":
            return 0, f"{pipeline.parse_overlay(spark, c, args.family).count()} records"
        case "reconcile":
            return 0, text(pipeline.run_reconciliation(spark, c, args.family))
        case "parse-profile":
            lost = pipeline.parse_profile(spark, c)
            return 0, text({"unresolved": [r["control_id"] for r in lost.orderBy("ord").toLocalIterator()]})
        case "validate":
            found = pipeline.validate_all(spark, c)
            total = validate.summary(found).first().asDict()
            rows = [r.asDict() for r in found.orderBy("severity", "check_id", "record_id").toLocalIterator()]
            return int(args.strict and not total["passed"]), text(total | {"findings": rows})
        case "export":
            pipeline.export_all(spark, c)
            return 0, "exported"
        case "build":
            if not args.offline:
                fetch.fetch_all(spark, known, c.root, c.run_at[:10], force=args.force_fetch, ref=args.baseline_ref, strict=args.strict)
            return 0, text(pipeline.build(spark, c, args.allow_newer))
        case "diff":
            report, changes = pipeline.diff_roots(spark, *args.what)
            return 0, "".join((builds.diff_json if args.json else builds.diff_markdown)(report, changes))
        case "show":
            return 0, pipeline.show(spark, c, args.what[0], args.upstream)
        case "render-embeddings":
            return 0, f"{pipeline.render_view(spark, c, args.view).count()} records"
        case "import-workbook":
            rows, apart = pipeline.import_workbook(spark, c, args.what[0])
            return 0, text({"rows": rows.count(), "differences": [r.asDict() for r in apart.orderBy("control_id").toLocalIterator()]})
    raise EngineError(f"unknown command {args.command}")


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("layerline").getOrCreate()
    try:
        code, out = run(spark, args)
    except EngineError as e:
        code, out = 1, f"{type(e).__name__}: {e}"
    print(out)
    return code


if __name__ == "__main__":
    sys.exit(main())
