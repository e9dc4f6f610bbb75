"""The whole job on documents: JSON-lines files in, landed tables and marts out.

    python -m marginlib.plans.job --store DIR --orders FILES --catalog FILES --returns FILES \\
        --until 2024-09-01 --backfill-days 30 --as-of 2024-09-01 \\
        --channel-map map.csv --fee-rules rules.csv --aliases aliases.csv

Each kind of documents that is named is landed as one batch (with ``--stream``, as a
stream of new files whose progress is kept under the store); then all marts are built
from the landed tables and published as one version of the store.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta, timezone

from ..session import build_session
from ..sources import landing, seeds
from ..sources.store import Store
from ..streaming.documents import run_document_stream
from . import land, pipeline

BACKFILL_DAYS = 30
LOOKBACK_DAYS = 30


def windows(a: argparse.Namespace, now: datetime) -> dict[str, dict]:
    """Bounds of the creation time for each kind: orders from ``since`` (or
    ``backfill_days`` before ``until``) to ``until``; returns after ``lookback_days``
    ago, unless all are asked for; the catalog is always whole."""
    until = datetime.fromisoformat(a.until) if a.until else now
    since = datetime.fromisoformat(a.since) if a.since else until - timedelta(days=a.backfill_days)
    if a.until and len(a.until) == 10:                  # a day: all of it
        until += timedelta(days=1) - timedelta(microseconds=1)
    orders = {} if a.all else {"since": str(since), "until": str(until)}
    return {"orders": orders, "catalog": {},
            "returns": {} if a.all else {"after": str(now - timedelta(days=a.lookback_days))}}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--store", required=True)
    for kind in land.KINDS:
        ap.add_argument(f"--{kind}", help="JSON-lines files (a path that Spark reads)")
    ap.add_argument("--stream", action="store_true", help="land only files that are new in the folders")
    ap.add_argument("--since")
    ap.add_argument("--until")
    ap.add_argument("--backfill-days", type=int, default=BACKFILL_DAYS)
    ap.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
    ap.add_argument("--all", action="store_true", help="no bounds on creation times")
    ap.add_argument("--now", help="load time (default: the clock)")
    ap.add_argument("--as-of", help="day of the cost watch (default: that of the load time)")
    ap.add_argument("--window-days", type=int, default=90)
    ap.add_argument("--excluded-status", type=int, nargs="*", default=[])
    for seed in ("channel-map", "fee-rules", "aliases"):
        ap.add_argument(f"--{seed}", help="CSV file (default: the fixed rows)")
    ap.add_argument("--no-marts", action="store_true")
    ap.add_argument("--master")
    ap.add_argument("--cluster", action="store_true", help="use the cluster-scale settings")
    return ap


def run(spark, a: argparse.Namespace) -> dict[str, dict]:
    """Land what is named and publish the marts; returns the counts of each kind."""
    store = Store(spark, a.store)
    now = datetime.fromisoformat(a.now) if a.now else datetime.now(timezone.utc).replace(tzinfo=None)
    bounds, counts = windows(a, now), {}
    for kind in land.KINDS:
        path = getattr(a, kind)
        if not path:
            continue
        if a.stream:
            run_document_stream(store, kind, path, f"{store.path}/checkpoints/{kind}", lambda _: str(now), **bounds[kind])
        else:
            counts[kind] = land.land_batch(store, kind, landing.read_documents(spark, path), str(now), **bounds[kind])
    if not a.no_marts:
        pipeline.run(spark, *(land.raw(store, k) for k in land.KINDS), store, a.as_of or str(now.date()), a.window_days,
                     a.excluded_status, seeds.sku_aliases(spark, a.aliases), seeds.channel_map(spark, a.channel_map),
                     seeds.fee_rules(spark, a.fee_rules))
    return counts


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    spark = build_session(a.master, cluster=a.cluster)
    for kind, n in run(spark, a).items():
        print(kind, *(f"{k}={v}" for k, v in n.items()))
    print("version", Store(spark, a.store).manifest()["version"])


if __name__ == "__main__":
    main()
