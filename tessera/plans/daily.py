"""The daily run of one dataset: ingest → gate → clean → gate → features → gate → drift and
fairness → mitigation → watermark and lineage, over the layer store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import clean as cleaning
from tessera.operators import drift, fairness, mitigation, quality
from tessera.operators.joining import settle
from tessera.plans import datasets
from tessera.sources import state
from tessera.sources.layers import LayerStore
from tessera.sources.versions import VersionLog


@dataclass
class DailyRun:
    """What one run leaves behind; the store keeps all of it under the run's date."""

    dataset: str
    date: str
    findings: dict[str, DataFrame] = field(default_factory=dict)
    drift: DataFrame | None = None
    violations: DataFrame | None = None
    mitigated: bool = False
    watermark: DataFrame | None = None
    lineage: DataFrame | None = None
    #: Rows, newest time and columns of what came in, and rows by reason of what was dropped, as the writes counted them.
    ingested: dict = field(default_factory=dict)
    drops: dict[str, int] = field(default_factory=dict)


def _gate(run: DailyRun, name: str, findings: DataFrame, strict: bool) -> None:
    run.findings[name] = quality.enforce(settle(findings), strict)


def _contract(plan: datasets.DatasetPlan, layer: str, df: DataFrame, otherwise) -> DataFrame:
    own = plan.contracts.get(layer)
    return own.findings(df) if own is not None else quality.contract_findings(df, otherwise)


def _drops(counts: cleaning.DropCounts, plan: datasets.DatasetPlan, raw: DataFrame, as_of, rows: int) -> dict[str, int]:
    """What the write has counted. If tasks of it ran twice, after an executor was lost, their rows count twice; then the first
    filter has seen more rows than came in, and the rows are cleaned again to be counted."""
    seen = counts.rows()
    if seen and seen[0] > rows:
        with cleaning.DropCounts() as counts:
            again = datasets.clean(plan, raw, as_of)
        again.write.format("noop").mode("overwrite").save()
    return counts.counts()


def stored_watermark(store: LayerStore, dataset: str, before: str | None = None):
    """The newest watermark that runs of earlier dates have stored, or None."""
    dates = [d for d in store.stored_dates(dataset, "watermarks") if before is None or d < before]
    if not dates:
        return None
    rows = store.scan(dataset, "watermarks").where(F.col("dt") <= F.lit(dates[-1]).cast("date"))
    return state.current_watermarks(rows.drop("dt")).first().value


def run_daily(
    store: LayerStore, plan: datasets.DatasetPlan, raw: DataFrame, date: str, history_days: int = 90, min_rows: int = 1,
    strict: bool = True, dimensions: Sequence[str] | None = None, since: str | None = None,
) -> DailyRun:
    """Process one day. Each layer is written before it is read again, so a failed or repeated run
    restarts from stored data and replaces only its own date. With ``since``, a time column of the raw
    rows, only rows from the stored watermark of earlier runs on are taken in."""
    run, name = DailyRun(plan.name, date), plan.name
    as_of = F.lit(date).cast("timestamp") + F.expr("INTERVAL 1 DAY")

    mark = stored_watermark(store, name, date) if since else None
    if mark is not None:
        raw = raw.where(F.col(since).cast("timestamp") >= F.lit(mark).cast("timestamp"))
    times = {"watermark_end": F.max(F.col(since).try_cast("timestamp"))} if since else {}
    run.ingested = {**store.write_counted(raw, name, "raw", date, **times), "columns": len(raw.columns)}
    raw = store.partition(name, "raw", date).drop("dt")
    _gate(run, "raw", _contract(plan, "raw", raw, plan.raw_contract).unionByName(quality.min_rows(raw, min_rows)), strict)

    with cleaning.DropCounts() as counts:
        processed = datasets.clean(plan, raw, as_of)
    store.write(processed, name, "processed", date)
    run.drops = _drops(counts, plan, raw, as_of, run.ingested["rows"])
    today = store.partition(name, "processed", date).drop("dt")
    _gate(run, "processed", _contract(plan, "processed", today, plan.processed_contract).unionByName(quality.min_rows(today, min_rows)), strict)

    run.findings["anomalies"] = settle(quality.suppress_expected(quality.anomalies(today, as_of), name))

    past = store.trailing(name, "processed", date, history_days).drop("dt")
    if plan.keys:  # overlapping pulls may repeat a record
        from tessera.operators.clean import dedup

        past = dedup(past, plan.keys, plan.order or plan.keys)
    if plan.features is not None:
        store.write(datasets.build(plan, past, as_of), name, "features", date)
        built = store.partition(name, "features", date).drop("dt")
        _gate(run, "features", _contract(plan, "features", built, {}).unionByName(quality.infinities(built)).unionByName(quality.min_rows(built, 1)), strict)

    earlier = (dt.date.fromisoformat(date) - dt.timedelta(days=plan.drift_offset_days)).isoformat()
    reference = store.partition(name, "processed", earlier).drop("dt")
    if reference.limit(1).count():
        run.drift = settle(drift.detect(today, reference, ignore=plan.drift_ignore))
    dims = list(dimensions or ([plan.fairness_dimension] if plan.fairness_dimension else []))
    if dims:
        run.violations = settle(fairness.evaluate(today, dims))
        real = run.violations.where("metric <> 'dimension_missing'")
        if dims[0] in today.columns and real.limit(1).count():
            store.write(mitigation.mitigate(today, dims[0]), name, "mitigated", date)
            run.mitigated = True

    if plan.time:
        run.watermark = state.batch_watermark(today, name, plan.time, F.lit(date).cast("date"))
    manifest = state.lineage_rows(today.withColumn("_run", F.lit(date).cast("date")), name, "processed", "_run", F.lit("1"))
    run.lineage = manifest
    ledger = store.spark.createDataFrame([*run.drops.items(), ("ingested", run.ingested["rows"])], "drop_reason string, rows bigint")
    told = [f.select(F.lit(stage).alias("stage"), *quality.FINDING) for stage, f in run.findings.items()]
    kept = {"watermarks": run.watermark, "lineage": run.lineage, "drift": run.drift, "violations": run.violations, "findings": quality.union(told), "drops": ledger}
    for layer, df in kept.items():
        if df is not None:
            store.write(df, name, layer, date)
    log = VersionLog(store)
    for layer in ("raw", "processed", "features"):
        log.record(name, layer)
    return run
