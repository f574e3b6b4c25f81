"""Platform table metadata: keys, foreign keys and regionality.

The declarations drive the consolidation (regionality) and the key checks (DQ-*).
Keys are *declared*, not enforced: a history table keyed by an entity id holds one
row per change, so its uniqueness check should use ``(key, change time)`` (D-17).
"""

from __future__ import annotations

from dataclasses import dataclass, field

@dataclass(frozen=True)
class ForeignKey:
    column: str          # may be a dotted path into a struct (D-18)
    table: str
    target_column: str


@dataclass(frozen=True)
class TableDef:
    path: str            # schema.table
    status: str
    regionality: str
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default_factory=tuple)


# The platform's tables with release status, regionality and declared keys.
_DEFINITIONS = (
    TableDef("access.audit", "PUBLIC_PREVIEW", "MIXED", ("event_id",), (
        ForeignKey("workspace_id", "access.workspaces_latest", "workspace_id"),
    )),
    TableDef("billing.usage", "GA", "GLOBAL", ("record_id",), (
        ForeignKey("workspace_id", "access.workspaces_latest", "workspace_id"),
        ForeignKey("sku_name", "billing.list_prices", "sku_name"),
        ForeignKey("job_id", "lakeflow.jobs", "job_id"),
        ForeignKey("warehouse_id", "compute.warehouses", "warehouse_id"),
        ForeignKey("cluster_id", "compute.clusters", "cluster_id"),
        ForeignKey("node_type", "compute.node_types", "node_type"),
        ForeignKey("endpoint_id", "serving.served_entities", "endpoint_id"),
    )),
    TableDef("access.clean_room_events", "PUBLIC_PREVIEW", "REGIONAL", ("event_id",)),
    TableDef("compute.clusters", "GA", "REGIONAL", ("cluster_id",)),
    TableDef("access.column_lineage", "GA", "REGIONAL", (), (
        ForeignKey("entity_id", "access.table_lineage", "entity_id"),
    )),
    TableDef("data_classification.results", "BETA", "REGIONAL"),
    TableDef("data_quality_monitoring.table_results", "BETA", "REGIONAL"),
    TableDef("access.assistant_events", "PUBLIC_PREVIEW", "REGIONAL", ("event_id",), (
        ForeignKey("workspace_id", "access.workspaces_latest", "workspace_id"),
    )),
    TableDef("sharing.materialization_history", "GA", "MIXED"),
    TableDef("lakeflow.job_run_timeline", "GA", "REGIONAL", ("run_id",), (
        ForeignKey("job_id", "lakeflow.jobs", "job_id"),
    )),
    TableDef("lakeflow.job_task_run_timeline", "GA", "REGIONAL", (), (
        ForeignKey("job_id", "lakeflow.jobs", "job_id"),
        ForeignKey("task_key", "lakeflow.job_tasks", "task_key"),
        ForeignKey("job_run_id", "lakeflow.job_run_timeline", "run_id"),
    )),
    TableDef("lakeflow.job_tasks", "GA", "REGIONAL", ("task_key",), (
        ForeignKey("job_id", "lakeflow.jobs", "job_id"),
    )),
    TableDef("lakeflow.jobs", "GA", "REGIONAL", ("job_id",)),
    TableDef("marketplace.listing_funnel_events", "PUBLIC_PREVIEW", "REGIONAL", ("provider_id", "listing_id")),
    TableDef("marketplace.listing_access_events", "PUBLIC_PREVIEW", "REGIONAL", (), (
        ForeignKey("provider_id", "marketplace.listing_funnel_events", "provider_id"),
        ForeignKey("listing_id", "marketplace.listing_funnel_events", "listing_id"),
    )),
    TableDef("mlflow.experiments_latest", "PUBLIC_PREVIEW", "REGIONAL", ("experiment_id",)),
    TableDef("mlflow.runs_latest", "PUBLIC_PREVIEW", "REGIONAL", ("run_id",), (
        ForeignKey("experiment_id", "mlflow.experiments_latest", "experiment_id"),
    )),
    TableDef("mlflow.run_metrics_history", "PUBLIC_PREVIEW", "REGIONAL", ("record_id",), (
        ForeignKey("run_id", "mlflow.runs_latest", "run_id"),
    )),
    TableDef("serving.served_entities", "PUBLIC_PREVIEW", "REGIONAL", ("served_entity_id", "endpoint_id")),
    TableDef("serving.endpoint_usage", "PUBLIC_PREVIEW", "REGIONAL", ("databricks_request_id",), (
        ForeignKey("served_entity_id", "serving.served_entities", "served_entity_id"),
    )),
    TableDef("access.inbound_network", "PUBLIC_PREVIEW", "REGIONAL", ("event_id",)),
    TableDef("access.outbound_network", "PUBLIC_PREVIEW", "REGIONAL", ("event_id",)),
    TableDef("compute.node_timeline", "GA", "REGIONAL", (), (
        ForeignKey("cluster_id", "compute.clusters", "cluster_id"),
        ForeignKey("node_type", "compute.node_types", "node_type"),
    )),
    TableDef("compute.node_types", "GA", "REGIONAL", ("node_type",)),
    TableDef("lakeflow.pipeline_update_timeline", "PUBLIC_PREVIEW", "REGIONAL", (), (
        ForeignKey("pipeline_id", "lakeflow.pipelines", "pipeline_id"),
    )),
    TableDef("lakeflow.pipelines", "PUBLIC_PREVIEW", "REGIONAL", ("pipeline_id",)),
    TableDef("storage.predictive_optimization_operations_history", "PUBLIC_PREVIEW", "REGIONAL"),
    TableDef("billing.list_prices", "GA", "GLOBAL", ("sku_name",)),
    TableDef("query.history", "PUBLIC_PREVIEW", "REGIONAL", ("statement_id",), (
        ForeignKey("warehouse_id", "compute.warehouses", "warehouse_id"),
    )),
    TableDef("compute.warehouse_events", "PUBLIC_PREVIEW", "REGIONAL", (), (
        ForeignKey("warehouse_id", "compute.warehouses", "warehouse_id"),
    )),
    TableDef("compute.warehouses", "PUBLIC_PREVIEW", "REGIONAL", ("warehouse_id",)),
    TableDef("access.table_lineage", "GA", "REGIONAL", ("entity_id",)),
    TableDef("access.workspaces_latest", "PUBLIC_PREVIEW", "GLOBAL", ("workspace_id",)),
    TableDef("lakeflow.zerobus_stream", "BETA", "REGIONAL"),
    TableDef("lakeflow.zerobus_ingest", "BETA", "REGIONAL"),
)

TABLES: dict[str, TableDef] = {t.path: t for t in _DEFINITIONS}


def get(path: str) -> TableDef | None:
    """Definition by ``schema.table`` (a leading catalog name is ignored)."""
    parts = path.split(".")
    return TABLES.get(".".join(parts[-2:]))


def regionality(path: str) -> str:
    """REGIONAL unless declared otherwise (unknown tables are treated as regional)."""
    d = get(path)
    return d.regionality if d else "REGIONAL"


# Tables that keep one row per change of an entity (D-17), with the column that orders
# the versions. Their declared key names an entity, so uniqueness is (key, version time).
HISTORY = {
    "compute.clusters": "change_time",
    "compute.warehouses": "change_time",
    "serving.served_entities": "change_time",
    "billing.list_prices": "price_start_time",
    "access.table_lineage": "event_time",
}


def rule(path: str) -> tuple[str, list[str] | None]:
    """Consolidation rule for a table: its regionality and, for MIXED tables, the key that
    identifies repeated account-level rows (None when no key is declared)."""
    d = get(path)
    if d is None:
        return "REGIONAL", None
    key = list(d.primary_key) if d.regionality == "MIXED" and d.primary_key else None
    return d.regionality, key


def key_decls(paths: list[str]):
    """Key declarations (``quality.KeyDecl``) for the given ``schema.table`` paths.

    Foreign keys are kept only when the parent table is among ``paths``; history
    tables get their version column added to the primary key.
    """
    from meterlake.operators.quality import KeyDecl
    wanted = {".".join(p.split(".")[-2:]) for p in paths}
    out = {}
    for p in sorted(wanted):
        d = get(p)
        if d is None:
            continue
        pk = tuple(d.primary_key) + ((HISTORY[p],) if p in HISTORY and d.primary_key else ())
        fks = tuple((fk.column, fk.table, fk.target_column) for fk in d.foreign_keys if fk.table in wanted)
        out[p] = KeyDecl(pk, fks)
    return out
