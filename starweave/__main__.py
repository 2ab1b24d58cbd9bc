"""Command line: ``python -m starweave raw-match|audit|report|review ...``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import PySparkException

from starweave.operators.match_audit import LIMITS, AuditLimits
from starweave.plans import pipelines
from starweave.session import build_session, discard_all


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="starweave", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    raw = sub.add_parser("raw-match", help="match raw catalogues by place")
    raw.add_argument("--neighbourhood")
    defaults = pipelines.RawMatch()
    for name, kind in (("max_sep", float), ("max_mag_delta", float), ("auto_sep", float), ("max_3d_pc", float)):
        raw.add_argument("--" + name.replace("_", "-"), type=kind, default=getattr(defaults, name))
    audit = sub.add_parser("audit", help="match processed catalogues and diagnose distances")
    audit.add_argument("--overrides")
    for name in vars(LIMITS):
        audit.add_argument("--" + name.replace("_", "-"), type=float, default=getattr(LIMITS, name))
    report = sub.add_parser("report", help="review table, manual queue and report")
    report.add_argument("--healpix-order", type=int, default=3)
    review = sub.add_parser("review", help="cohorts of both catalogues with priority scores")
    review.add_argument("--size", type=int, default=pipelines.co.COHORT_SIZE)
    for command, inputs in ((review, ("gaia", "hip", "official", "supplemental", "neighbourhood")), (raw, ("hip", "gaia", "official")), (audit, ("gaia", "hip", "official")), (report, ("evidence", "issues"))):
        for name in (*inputs, "out"):
            command.add_argument(name)
        command.add_argument("--force", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = build_session()
    try:
        if a.command == "raw-match":
            found = pipelines.run_raw_match(spark, a.hip, a.gaia, a.official, a.out, a.neighbourhood, pipelines.RawMatch(a.max_sep, a.max_mag_delta, a.auto_sep, a.max_3d_pc), a.force)
        elif a.command == "audit":
            limits = AuditLimits(**{n: getattr(a, n) for n in vars(LIMITS)})
            found = pipelines.run_match_audit(spark, a.gaia, a.hip, a.official, a.overrides, a.out, a.force, limits)
        elif a.command == "review":
            found = pipelines.run_review_files(spark, a.gaia, a.hip, a.official, a.supplemental, a.neighbourhood, a.out, a.size, a.force)
        else:
            found = pipelines.run_audit_report(spark, a.evidence, a.issues, a.out, a.healpix_order, a.force)
    except (OSError, ValueError, PySparkException) as e:
        print(f"starweave: {e}", file=sys.stderr)
        return 1
    finally:
        discard_all(spark)
    print(json.dumps(found, indent=2, sort_keys=True, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
