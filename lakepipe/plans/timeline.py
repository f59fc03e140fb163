"""The canonical event timeline.

A declaration lists, per source table, the events one row can give rise to.
All events of a source come from a single scan: each row is copied once per
declared event and a copy stays where the event's condition holds.  The same
function serves batch frames and streams, and involves no shuffle; a reader
that needs few of the columns pays only for those.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions import case
from lakepipe.functions.dialect import spark_expr
from lakepipe.functions.jsons import map_json
from lakepipe.functions.templates import render, stable_id
from lakepipe.functions.times import as_of as run_time
from lakepipe.operators import checks as q
from lakepipe.operators.dedupe import replacing_merge
from lakepipe.operators.filters import for_tenant
from lakepipe.sources.writers import merge_partitions, write_partitions

# Columns of the timeline.
SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("org_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("event_timestamp_source", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("minio_path", T.StringType()),
        T.StructField("rec_add", T.TimestampType()),
        T.StructField("rec_edit", T.TimestampType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("processing_date", T.DateType()),
        T.StructField("_loaded_at", T.TimestampType()),
        T.StructField("_version", T.IntegerType()),
    ]
)

# Event type, timestamp source (None: the time column's name) and
# description of the events inferred from positions.
POSITION_EVENTS = [
    ("holding_established", "derived_from_transactions", "Position established in account"),
    ("transaction_buy", "derived", "Purchase units in account"),
    ("transaction_sell", "derived", "Sold units from account"),
    ("transaction_deposit", None, "Cash deposit - ${{{value}}}"),
    ("transaction_withdrawal", None, "Cash withdrawal - ${{abs({value})}}"),
    ("holding_closed", None, "Position closed in account"),
]

# sort key of the table; the highest version per key wins
KEYS = ("org_id", "entity_type", "entity_id", "timestamp", "event_type")
REQUIRED = ("event_id", "org_id", "event_type", "timestamp")


@dataclass(frozen=True)
class EventSpec:
    type: str
    timestamp_field: str
    condition: str
    description_template: str = ""
    timestamp_source: str | None = None
    metadata: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class TimelineSpec:
    """One source of events.  ``key`` and ``tenant`` name source columns."""

    source: str
    entity_type: str
    key: str
    events: Sequence[EventSpec]
    system: str = ""
    tenant: str = "organization_id"
    processing_date: str = "processing_date"

    @staticmethod
    def from_dict(d: dict, system: str | None = None) -> "TimelineSpec":
        """From the mapping of a source declaration."""
        src, line = d["source"], d["timeline"]
        database = src["database"]
        fields = set(EventSpec.__dataclass_fields__)
        return TimelineSpec(
            source=f"{database}.{src['table']}",
            entity_type=line["entity_type"],
            key=src["primary_key"],
            events=[EventSpec(**{k: v for k, v in e.items() if k in fields}) for e in line["events"]],
            system=system or database.removesuffix("_silver"),
            tenant=src.get("org_filter_column", "organization_id"),
        )


def entity_events(
    created: str, updated: str, entity: str, business: tuple[str, str] | None = None, label: str = ""
) -> list[EventSpec]:
    """Created, an optional business event and updated, the latter two only where they differ from created."""
    out = [EventSpec(f"{entity}_created", created, f"{created} IS NOT NULL", f"{label or entity} created")]
    if business:
        name, ts = business
        cond = f"{ts} IS NOT NULL AND ({created} IS NULL OR {ts} != {created})"
        out.append(EventSpec(f"{entity}_{name}", ts, cond, f"{label or entity} {name}"))
    cond = f"{updated} IS NOT NULL AND {created} IS NOT NULL AND {updated} != {created}"
    out.append(EventSpec(f"{entity}_updated", updated, cond, f"{label or entity} updated"))
    return out


def position_events(
    units: str, value: str, cash: str, ts: str, metadata: dict[str, str] | None = None
) -> list[EventSpec]:
    """Events inferred from position snapshots by the sign of units, value and the cash flag."""
    held, known = f"{units} IS NOT NULL", f"{value} IS NOT NULL"
    conditions = {
        "holding_established": f"{held} AND {units} != 0",
        "transaction_buy": f"{held} AND {units} > 0 AND {cash} != true",
        "transaction_sell": f"{held} AND {units} < 0",
        "transaction_deposit": f"{cash} = true AND {known} AND {value} > 0",
        "transaction_withdrawal": f"{cash} = true AND {known} AND {value} < 0",
        "holding_closed": f"{held} AND {units} = 0",
    }
    return [
        EventSpec(kind, ts, conditions[kind], text.format(value=value), source or ts, dict(metadata or {}))
        for kind, source, text in POSITION_EVENTS
    ]


def build_timeline(df: DataFrame, spec: TimelineSpec, tenant: str | Sequence[str] | None = None, as_of=None) -> DataFrame:
    """Fan each row out into its events.  Without ``tenant`` all tenants are kept, as a column."""
    if tenant is not None:
        df = for_tenant(df, spec.tenant, tenant)
    df = df.filter(F.col(spec.key).isNotNull())
    org = F.col(spec.tenant).cast("string")
    source_id = F.col(spec.key).cast("string")
    entity_id = F.concat(F.lit(spec.entity_type + "_"), source_id)
    has = lambda c, kind: F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind)

    def of_event(value) -> Column:
        """The field of the row's event, by its number in the declaration."""
        return case([(F.col("_event") == i, value(e)) for i, e in enumerate(spec.events)], None)

    def metadata(e: EventSpec) -> Column:
        meta = {k: spark_expr(v) for k, v in e.metadata.items()}
        return map_json(meta) if meta else F.lit(None).cast("string")

    at = lambda e: F.col(e.timestamp_field).cast("timestamp")
    # one copy of the row per declared event, kept where its condition holds
    copies = F.explode(F.array(*[F.lit(i) for i in range(len(spec.events))]))
    rows = df.withColumn("_event", copies).filter(of_event(lambda e: spark_expr(e.condition) & at(e).isNotNull()))
    event_type, ts = of_event(lambda e: F.lit(e.type)), of_event(at)
    return rows.select(
        stable_id(org, entity_id, event_type, F.unix_micros(ts)).alias("event_id"),
        org.alias("org_id"),
        event_type.alias("event_type"),
        ts.alias("timestamp"),
        of_event(lambda e: F.lit(e.timestamp_source or e.timestamp_field)).alias("event_timestamp_source"),
        F.lit(spec.entity_type).alias("entity_type"),
        entity_id.alias("entity_id"),
        of_event(lambda e: render(e.description_template)).alias("description"),
        F.lit(spec.system).alias("source_system"),
        F.lit(spec.source).alias("source_table"),
        source_id.alias("source_id"),
        has("minio_path", "string").alias("minio_path"),
        has("rec_add", "timestamp").alias("rec_add"),
        has("rec_edit", "timestamp").alias("rec_edit"),
        of_event(metadata).alias("metadata"),
        has(spec.processing_date, "date").alias("processing_date"),
        run_time(as_of).alias("_loaded_at"),
        F.lit(1).alias("_version"),
    )


@dataclass(frozen=True)
class SourceEntry:
    """A registry entry: a source, whether it is on, and how many events it should give at least."""

    spec: TimelineSpec
    enabled: bool = True
    expected_min_events: int = 1


def enabled_sources(providers: Iterable[dict], load) -> list[SourceEntry]:
    """Entries of a provider registry; ``load(path)`` returns a source declaration."""
    out = []
    for p in providers:
        if not p.get("enabled", True):
            continue
        for s in p["sources"]:
            if s.get("enabled", True):
                spec = TimelineSpec.from_dict(load(s["config_path"]), p["name"])
                out.append(SourceEntry(spec, True, s.get("expected_min_events", 1)))
    return out


def assemble(tables: dict[str, DataFrame], entries: Sequence[SourceEntry], tenant=None, as_of=None) -> DataFrame:
    """Union of all enabled sources whose table is given."""
    parts = [
        build_timeline(tables[e.spec.source], e.spec, tenant, as_of)
        for e in entries
        if e.enabled and e.spec.source in tables
    ]
    if not parts:
        raise ValueError("no enabled source has a table")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_timeline(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new events; the highest version per sort key wins."""
    return replacing_merge(old, new, KEYS, "_version")


def store_timeline(events: DataFrame, path: str, merge: bool = False) -> None:
    """Write events in folders by tenant and month, or merge them into the stored ones.

    Rows are sorted by entity inside files, so readers skip most of them.
    """
    month = F.coalesce(F.date_format("processing_date", "yyyyMM"), F.lit("none"))
    events, by = events.withColumn("month", month), ["org_id", "month"]
    if merge:
        merge_partitions(events, path, [*KEYS, "month"], "_version", by, KEYS[1:3])
    else:
        write_partitions(events, path, by, mode="overwrite", sort=KEYS[1:3])


def timeline_checks(
    name: str, entries: Sequence[SourceEntry] = (), as_of: str | None = None, max_lag_days: int = 1, max_lag_seconds: int = 300
):
    """Rows present, required fields set, enough events per source, newest event recent, in days and in seconds."""
    suite = [q.row_count(name, 1, "warning")]
    suite += [q.not_null(name, c) for c in REQUIRED]
    for e in entries:
        hits = lambda df, source=e.spec.source: F.count_if(F.col("source_table") == source)
        low = e.expected_min_events
        suite.append(
            q.Check(
                name,
                f"min_events:{e.spec.source}",
                "warning",
                lambda n, low=low: n >= low,
                hits,
                label="events",
            )
        )
    if as_of:
        suite.append(q.fresh(name, "timestamp", as_of, max_lag_days))
        suite.append(q.lag_at_most(name, "timestamp", as_of, max_lag_seconds))
    return suite
