"""Layer contracts from JSON schema files, one per dataset and layer (``folder/dataset/layer_schema.json``)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality

LAYERS = ("raw", "processed", "features")


@dataclass(frozen=True)
class Contract:
    """Columns with their type names, nullability, limits and enums, and what else a schema states."""

    columns: Mapping[str, Mapping]
    required: tuple[str, ...] = ()
    allow_extra: bool = True
    patterns: Mapping[str, str] = field(default_factory=dict)
    null_limits: Mapping[str, float] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    watermark: str | None = None

    def findings(self, df: DataFrame) -> DataFrame:
        """What a table breaks: columns, types, NULLs, limits, enums, patterns and NULL shares."""
        found = quality.contract_findings(df, self.columns, self.allow_extra, self.required)
        checks = [("pattern_mismatch", "warning", c, ~F.col(c).cast("string").rlike(p)) for c, p in self.patterns.items() if c in df.columns]
        if checks:
            found = found.unionByName(quality.counted(df, checks))
        limits = {c: x for c, x in self.null_limits.items() if c in df.columns}
        if limits:
            over = quality.counted(df, [("null_ratio", "warning", c, F.col(c).isNull()) for c in limits])
            limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])[F.col("feature")]
            found = found.unionByName(over.where(F.col("ratio") > limit))
        return found


def parse(schema: Mapping) -> Contract:
    """A contract from a JSON schema. A column is nullable if its types hold "null" or it is not required."""
    required = tuple(schema.get("required", ()))
    columns: dict[str, dict] = {}
    for name, spec in schema.get("properties", {}).items():
        kinds = [spec.get("type", "string")] if isinstance(spec.get("type", "string"), str) else list(spec["type"])
        own = [k for k in kinds if k != "null"]
        if str(spec.get("format", "")).startswith("date") and "datetime" not in own:
            own.append("datetime")
        columns[name] = {"type": own, "nullable": "null" in kinds or name not in required}
        columns[name] |= {k: spec[k] for k in ("minimum", "maximum", "enum") if k in spec}
    props = schema.get("properties", {})
    return Contract(
        columns, required, bool(schema.get("additionalProperties", True)),
        {c: s["pattern"] for c, s in props.items() if "pattern" in s},
        {c: float(s["null_ratio_threshold"]) for c, s in props.items() if "null_ratio_threshold" in s},
        tuple(c for c, s in props.items() if s.get("primary_key")),
        next((c for c, s in props.items() if s.get("watermark_field")), None),
    )


def load(spark: SparkSession, folder: str) -> dict[tuple[str, str], Contract]:
    """All contracts below a folder by (dataset, layer); there is one small file for each."""
    rows = spark.read.text(f"{folder}/*/*_schema.json", wholetext=True).select("value", F.input_file_name().alias("path")).collect()
    found = {}
    for r in rows:
        *_, dataset, name = r.path.split("/")
        found[dataset, name.removesuffix("_schema.json")] = parse(json.loads(r.value))
    return found


def with_contracts(plan, found: Mapping[tuple[str, str], Contract]):
    """A dataset plan whose gates use the contracts found for its name; layers without one keep theirs."""
    return replace(plan, contracts={layer: found[plan.name, layer] for layer in LAYERS if (plan.name, layer) in found})


def layer_findings(found: Mapping[tuple[str, str], Contract], tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """(dataset, layer, rule, severity, feature, n, ratio): what each stored table breaks of the contract for its dataset and
    layer. A contract without a table is ``missing_table``, a table without a contract ``no_contract``."""
    parts, rows = [], []
    for (dataset, layer), df in tables.items():
        if (dataset, layer) not in found:
            rows.append((dataset, layer, "no_contract", "warning", "__all__", 0, 0.0))
            continue
        own = found[dataset, layer].findings(df)
        parts.append(own.select(F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), *quality.FINDING))
    rows += [(d, x, "missing_table", "error", "__all__", 0, 0.0) for d, x in found if (d, x) not in tables]
    if rows:
        spark = next(iter(tables.values())).sparkSession if tables else SparkSession.getActiveSession()
        parts.append(spark.createDataFrame(rows, "dataset string, layer string, rule string, severity string, feature string, n bigint, ratio double"))
    return quality.union(parts)
