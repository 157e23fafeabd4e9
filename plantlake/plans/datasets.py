"""Catalogue of the plant datasets and how each is refreshed.

Bronze and silver tables are append-only streams with a checkpoint each; gold
views are recomputed from the silver tables, or kept up to date from what is new in them.
A refresh is one commit: readers see the view before or after it. Functions are called in order by
the user; nothing here schedules anything.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from plantlake.operators.enrich import union_feeds
from plantlake.plans import gold, incremental, silver
from plantlake.schema import PLANT_TABLES, column_names
from plantlake.sources.files import RESCUED, parquet_stream
from plantlake.sources.records import decode_json
from plantlake.sources.schemas import SchemaLog, read_as, source_schema
from plantlake.sources.snapshots import Snapshots
from plantlake.streaming.ingest import append_apart, append_stream, ingest_stream, run_to_end
from plantlake.streaming.live import dedup_stream
from plantlake.streaming.merge import merge_stream
from plantlake.streaming.pending import BATCH, enrich_when_known

LIVE_FIELDS = """
    reading_id string, sensor_id string, unit_id string, refinery_id string,
    reading_timestamp timestamp, reading_value double, reading_quality string,
    is_interpolated boolean, event_time timestamp, processing_time timestamp"""


@dataclass(frozen=True)
class Dataset:
    name: str
    layer: str
    comment: str = ""
    properties: dict[str, str] = field(default_factory=dict)
    build: Callable[..., DataFrame] | None = None
    inputs: tuple[str, ...] = ()  # streamed first input, then batch inputs
    partition_ts: str | None = None  # stored in one folder per period of this column
    period: str = "day"  # or month, for tables with far fewer rows a day than readings
    increment: Callable[..., incremental.Increment] | None = None  # how a view is kept from what is new


def _bronze(table: str) -> Dataset:
    return Dataset(f"bronze_{table}", "bronze", f"Rows of {table} as they arrive", {"quality": "bronze"},
                   inputs=(table,))


HISTORY = "bronze_fact_sensor_readings"
LIVE = "bronze_fact_sensor_readings_stream"
TENANT = "bronze_fact_sensor_readings_tenant"
DATASETS: dict[str, Dataset] = {d.name: d for d in [
    *[_bronze(t) for t in PLANT_TABLES],
    Dataset(LIVE, "bronze", "Decoded live readings", {"quality": "bronze"}),
    Dataset(TENANT, "bronze", "Readings of a second tenant", {"quality": "bronze"}),
    Dataset("silver_sensor_readings", "silver", "Readings of active sensors, classified", {"quality": "silver"},
            lambda history, live, sensors: silver.silver_readings([history, live], sensors),
            (HISTORY, LIVE, "bronze_dim_sensors"), "reading_timestamp"),
    Dataset("silver_shipments", "silver", "Shipments with variance, delay and cost", {"quality": "silver"},
            lambda s, sites, crudes: silver.silver_shipments(s, sites, crudes),
            ("bronze_fact_crude_shipments", "bronze_dim_refineries", "bronze_dim_crude_types"), "shipment_date", "month"),
    Dataset("silver_production", "silver", "Production with dimensions and ratios", {"quality": "silver"},
            lambda p, u, r, pr, c: silver.silver_production(p, u, r, pr, c),
            ("bronze_fact_production_output", "bronze_dim_processing_units", "bronze_dim_refineries",
             "bronze_dim_products", "bronze_dim_crude_types"), "production_hour", "month"),
    Dataset("silver_tank_inventory", "silver", "Valid tank snapshots with status", {"quality": "silver"},
            silver.silver_tank_inventory, ("bronze_fact_tank_inventory",), "measurement_timestamp", "month"),
    Dataset("gold_anomaly_alerts", "gold", "Five-minute alert groups", {"quality": "gold"},
            gold.anomaly_alerts, ("silver_sensor_readings",), increment=incremental.alerts),
    Dataset("gold_equipment_health", "gold", "Health and maintenance per unit and day", {"quality": "gold"},
            gold.equipment_health,
            ("silver_sensor_readings", "bronze_dim_processing_units", "bronze_dim_refineries"), increment=incremental.health),
    Dataset("gold_refinery_kpis", "gold", "Daily figures per site", {"quality": "gold"},
            gold.daily_kpis, ("silver_production", "bronze_dim_refineries"), increment=incremental.kpis),
    Dataset("gold_product_yield", "gold", "Yield per feed grade and product", {"quality": "gold"},
            gold.product_yield, ("silver_production", "bronze_dim_crude_types", "bronze_dim_products"), increment=incremental.yields),
    Dataset("gold_inventory_status", "gold", "Current status of every tank", {"quality": "gold"},
            gold.inventory_status_view, ("silver_tank_inventory", "bronze_dim_storage_tanks"), increment=incremental.newest_snapshots),
    Dataset("gold_inventory_by_tank", "gold", "Active tanks by their own limits", {"quality": "gold"},
            gold.inventory_status_view, ("silver_tank_inventory", "bronze_dim_storage_tanks", "bronze_dim_refineries"), increment=incremental.newest_snapshots),
]}


class Lake:
    """Datasets of one storage root: ``root/<name>``, checkpoints in ``root/_checkpoints``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def store(self, name: str) -> Snapshots:
        return Snapshots(self.spark, self.path(name))

    def table(self, name: str) -> DataFrame:
        """A dataset as it is now. Of a gold view the newest commit, also while it is refreshed."""
        if name in DATASETS and DATASETS[name].layer == "gold":
            return self.store(name).read()
        return read_as(self.spark, self.path(name), self.schemas(name).current()).drop(BATCH)

    def schemas(self, name: str) -> SchemaLog:
        """How the schema of a bronze dataset has grown."""
        return SchemaLog(self.spark, f"{self.root}/_schemas/{name}")

    def stream(self, name: str) -> DataFrame:
        return parquet_stream(self.spark, self.path(name), self.schemas(name).current()).drop(BATCH)

    def ingest(self, name: str, src: str, columns: list[str] | None = None, tenant: str | None = None) -> None:
        """Bring what is new in a parquet source into a bronze dataset. The reading
        history takes its declared columns only. Columns that the source has gained since the last call are
        taken from then on, and wider types; another change of a type raises ``SchemaChange``."""
        if name == HISTORY and columns is None:
            columns = column_names("fact_sensor_readings")
        known = [f for f in self.schemas(name).current() or [] if tenant is None or f.name != "tenant"]
        came = source_schema(self.spark, src, T.StructType(known))
        kept = T.StructType([f for f in came.fields if columns is None or f.name in columns])
        extra = [T.StructField("tenant", T.StringType())] if tenant is not None else []
        full = self.schemas(name).grow(T.StructType(kept.fields + extra))
        shape = T.StructType([f for f in full.fields if not extra or f.name != "tenant"])
        run_to_end(ingest_stream(parquet_stream(self.spark, src, shape), self.path(name), self.checkpoint(name), columns, tenant))

    def ingest_live(self, records: DataFrame, value: str = "value", name: str = LIVE, unique_within: str | None = None,
                    continuous: str | None = None, quarantine: bool = False) -> StreamingQuery:
        """Decode a stream of JSON records, from a broker or from files, into a bronze dataset.
        ``unique_within`` drops redelivered ids that arrive within that time of each other, and
        with them rows later than that. ``continuous`` is the interval of a query that keeps
        running; otherwise what is there is taken and the query has ended on return. ``quarantine`` puts the text of records that are
        broken or don't fit their types into the dataset of the same name with ``_quarantine``, not into this one."""
        if quarantine and unique_within:
            raise ValueError("records are set apart before they are made unique: use one of the two here")
        if quarantine:
            rows = decode_json(records, value, LIVE_FIELDS, lenient=True, rescued=RESCUED)
            queries = append_apart(rows, RESCUED, self.path(name), self.path(f"{name}_quarantine"), self.checkpoint(name), continuous=continuous)
            return [self._run(q, continuous) for q in queries][0]
        rows = decode_json(records, value, LIVE_FIELDS, lenient=True)
        if unique_within:
            rows = dedup_stream(rows, ["reading_id"], "reading_timestamp", unique_within)
        return self._run(append_stream(rows, self.path(name), self.checkpoint(name), continuous=continuous), continuous)

    @staticmethod
    def _run(query: StreamingQuery, continuous: str | None) -> StreamingQuery:
        return query if continuous else run_to_end(query)

    def update(self, name: str, files_per_partition: int | None = None, continuous: str | None = None) -> StreamingQuery:
        """Process what is new in the streamed inputs of a silver dataset, once or (``continuous``)
        at an interval."""
        d = DATASETS[name]
        facts = [i for i in d.inputs if "_fact_" in i]
        frames = [self.stream(i) if i in facts else self.table(i) for i in d.inputs]
        rows, by = d.build(*frames), None
        if d.partition_ts:
            by = [gold.PARTITION_DATE]
            rows = rows.withColumn(by[0], F.to_date(d.partition_ts) if d.period == "day" else F.trunc(F.to_date(d.partition_ts), d.period))
        return self._run(append_stream(rows, self.path(name), self.checkpoint(name), by, files_per_partition, continuous),
                         continuous)

    def update_when_known(self, continuous: str | None = None, files_per_trigger: int | None = None) -> StreamingQuery:
        """As ``update`` of the silver readings, but with the sensors as they are at each micro-batch, and readings of sensors
        that are not known yet wait until they are. A table is brought up to date by this call only, or only by ``update``."""
        name = "silver_sensor_readings"
        d = DATASETS[name]
        options = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
        feeds = [parquet_stream(self.spark, self.path(i), self.schemas(i).current(), **options) for i in d.inputs if "_fact_" in i]
        columns = [c for c in silver.READING_COLUMNS if c in feeds[0].columns]

        def build(rows: DataFrame, sensors: DataFrame) -> DataFrame:
            return silver.silver_readings([rows], sensors).withColumn(gold.PARTITION_DATE, F.to_date(d.partition_ts))

        query = enrich_when_known(union_feeds(*[f.select(*columns) for f in feeds]), lambda: self.table(d.inputs[-1]), "sensor_id", build, self.path(name),
                                  Snapshots(self.spark, f"{self.root}/_waiting/{name}"), self.checkpoint(name), [gold.PARTITION_DATE], continuous=continuous)
        return self._run(query, continuous)

    def publish(self, schema: str, names: list[str]) -> None:
        """Make stored datasets known by name, as views with their comment and properties. A view
        reads the folder as it is, with the commits of its stream and all partitions; that of a gold view
        reads its newest commit and is to be published again after a refresh."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        for name in names:
            d = DATASETS[name]
            pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in {"layer": d.layer, **d.properties}.items())
            place = self.path(name)
            if d.layer == "gold":
                place += "/{" + ",".join(sorted(self.store(name).commit().parts.values())) + "}"
            self.spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} COMMENT {quoted(d.comment)} TBLPROPERTIES ({pairs}) "
                           f"AS SELECT * FROM parquet.`{place}`")

    def refresh(self, name: str, **options) -> None:
        """Recompute a gold view from its inputs and replace it in one commit."""
        d = DATASETS[name]
        rows = d.build(*[self.table(i) for i in d.inputs], **options)
        view_part = d.increment().view_part
        self.store(name).replace(rows, view_part(rows) if view_part else F.lit("all"))

    def refresh_new(self, name: str, settings: dict | None = None, continuous: str | None = None, **options) -> StreamingQuery:
        """Bring a gold view up to date with the silver rows that came since the last call. Only the days that these rows belong to
        are rewritten. ``settings`` go to the view's increment and must stay the same, ``options`` to its last step."""
        d = DATASETS[name]
        inc, view = d.increment(**(settings or {})), self.store(name)
        kept = Snapshots(self.spark, f"{self.root}/_partials/{name}")

        def finish(touched: list[str], query: str, batch: int) -> None:
            if view.holds(query, batch):
                return
            stored = kept.read(touched if inc.view_part else None)
            rows = inc.finish(stored, *[self.table(i) for i in d.inputs[1:]], **options)
            view.replace(rows, inc.view_part(rows) if inc.view_part else F.lit("all"), touched if inc.view_part else None, query, batch)
            view.vacuum()

        return self._run(merge_stream(self.stream(d.inputs[0]), kept, inc.reduce, inc.combine, inc.part, self.checkpoint(name), finish,
                                      inc.owned, continuous=continuous), continuous)
