"""Command line: run a sweep, build the next manifest, report failures.

    python -m concord run      --manifest m.csv --ledger LEDGER [--profile final] [--history]
                               [--concurrency 8] [--resume-on YYYY-MM-DD] [--method digest]
    python -m concord sweep    --ledger LEDGER --second-ledger LEDGER2 --out next.csv [--rules literal]
    python -m concord failures --ledger LEDGER --out failed.csv [--equal-sizes]
    python -m concord retry    --ledger LEDGER --out retry.csv

Manifests are comma-separated text without header
(``env,dag_id,gen1_path,gen2_path[,gen1_hist_path,gen2_hist_path]``).
Outputs are written by Spark as CSV directories. The session comes from
``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from concord.plans import sweep
from concord.plans.profiles import PROFILES
from concord.plans.reconcile import reconcile
from concord.sources import ledger
from concord.sources.manifest import read_manifest


def _session() -> SparkSession:
    return SparkSession.builder.appName("concord").getOrCreate()


def _write(df, out: str) -> None:
    df.write.mode("overwrite").csv(out)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="concord")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--manifest", required=True)
    r.add_argument("--ledger", required=True)
    r.add_argument("--profile", default="final", choices=sorted(PROFILES))
    r.add_argument("--history", action="store_true")
    r.add_argument("--concurrency", type=int, default=4)
    r.add_argument("--resume-on")
    r.add_argument("--method", default="exact", choices=["exact", "digest"])
    s = sub.add_parser("sweep")
    s.add_argument("--ledger", required=True)
    s.add_argument("--second-ledger", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--rules", default="corrected", choices=["corrected", "literal"])
    f = sub.add_parser("failures")
    f.add_argument("--ledger", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--equal-sizes", action="store_true")
    t = sub.add_parser("retry")
    t.add_argument("--ledger", required=True)
    t.add_argument("--out", required=True)
    a = ap.parse_args(argv)

    spark = _session()
    if a.cmd == "run":
        manifest = read_manifest(spark, a.manifest, history=a.history)
        profile = PROFILES[a.profile].with_(method=a.method)
        out = reconcile(
            spark, manifest, profile, ledger_path=a.ledger, history=a.history,
            concurrency=a.concurrency, resume_on=a.resume_on,
        )
        checks = [c for c in out.columns if c.endswith("_validation")]
        failed = out.where(" or ".join(f"{c} = 'Failed'" for c in checks)).count()
        print(f"checked {out.count()} scopes, {failed} with a failed check; ledger: {a.ledger}")
    elif a.cmd == "sweep":
        first = ledger.read(spark, a.ledger)
        second = ledger.read(spark, a.second_ledger)
        _write(sweep.sweep_manifest(first, second, a.rules), a.out)
    elif a.cmd == "failures":
        _write(sweep.failure_report(ledger.read(spark, a.ledger), a.equal_sizes), a.out)
    elif a.cmd == "retry":
        _write(sweep.retry_manifest(ledger.read(spark, a.ledger)), a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
