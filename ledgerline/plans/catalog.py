"""Named queries over a directory of driver tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables
through the star adapter (``ledgerline.sources.tables``); nothing is sampled
or capped except where a top-k is the feature itself.

The adapter output is landed once per session as medallion layers in the
shared folder (``spark.checkpoint.dir``): silver sales (cleaned, partitioned
by store), the two dimensions, and the gold enriched fact. The driver tables
themselves are the raw (bronze) landing: the two audits over raw rows
(``bronze_profile``, ``rejected_rows``) read them directly rather than a
second full copy of the fact. Queries read those written tables, so the
lineitem/orders join and the star join run once instead of once per query,
lineage is cut at each layer, and the planner sees real file sizes when it
decides whether a dimension is small enough to broadcast.

``QUERY_PARAMS`` holds the parameter values used by the registered checks:
the reference defaults, except thresholds that select nothing on the driver
data (see FIXTURES.md): high-value 3,000,000, daily alert 10,000,000, a price
floor of 5,000 for the reject report, and 1-hour demand windows.
"""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ledgerline import schemas
from ledgerline.functions import money, timecols
from ledgerline.functions.money import money_out
from ledgerline.operators import marts, measures, quality, star, visuals
from ledgerline.params import RetailParams
from ledgerline.plans import lakehouse
from ledgerline.plans.sql_views import register_retail_views
from ledgerline.schemas import ENRICHED_COLUMNS, FACT_COLUMNS, LAYER_CODEC, SALES_KEYS, SALES_SCHEMA
from ledgerline.session import completed, fingerprint, shared_dir, shared_root, stored_bytes, wide_shuffles
from ledgerline.sources import read_customers_csv, read_products_csv, read_raw_csv, read_sales_csv, sales_csv_stream, tables
from ledgerline.streaming import batch_sink
from ledgerline.streaming.demand import WINDOW_COLUMNS, demand_spikes, late_demand, windowed_demand
from ledgerline.streaming.runner import run_demand_stream

QUERY_PARAMS = RetailParams(
    high_value_threshold=Decimal("3000000.00"),
    sales_alert_threshold=Decimal("10000000.00"),
    window_duration="1 hour",
)
REJECT_PARAMS = QUERY_PARAMS.with_(price_floor=Decimal("5000.00"))
SILVER_STORE = "S3"
STORE_ALERT = Decimal("100000.00")
CSV_TIME = "yyyy-MM-dd HH:mm:ss"

Query = Callable[[SparkSession, str], DataFrame]


@lru_cache(maxsize=1)
def layer_code() -> str:
    """A hash of the code that decides what the layers hold: other code, other folders."""
    seen = hashlib.sha256()
    for module in (quality, marts, star, tables, lakehouse, money, timecols, schemas):
        seen.update(inspect.getsource(module).encode())
    return seen.hexdigest()


# Frames over stored layers by (application, layers' folder); the oldest are dropped.
_FRAMES: dict[tuple[str, str], dict] = {}
KEPT_ROOTS = 16


class Retail:
    """Retail frames over one table directory.

    With ``materialize=True`` (default) each layer is written once, below a
    folder named by a fingerprint of the source files, the parameters and the
    code of the layers, and read back under a declared schema; a layer that is
    complete there (from any session that shares the folder) is read as it is,
    without planning what made it, and changed sources get a new folder. Each
    build writes to a folder of its own, so sessions that build at once don't
    disturb each other. With ``False`` the frames are the direct lazy plans over
    the driver tables.
    """

    SOURCES = ("lineitem", "orders", "customer", "nation", "part", "events")

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        params: RetailParams = QUERY_PARAMS,
        materialize: bool = True,
    ):
        self.spark, self.sf_dir, self.params = spark, sf_dir.rstrip("/"), params
        self.materialize = materialize
        self._own: dict | None = None if materialize else {}
        self._root: str | None = None

    @property
    def _frames(self) -> dict:
        if self._own is None:
            key = (self.spark.sparkContext.applicationId, self.root)
            while len(_FRAMES) > KEPT_ROOTS:
                _FRAMES.pop(next(iter(_FRAMES)))
            self._own = _FRAMES.setdefault(key, {})
        return self._own

    def _frame(self, name, build):
        df = self._frames.get(name)
        if df is None:
            df = self._frames[name] = build()
        return df

    @property
    def source_paths(self) -> list[str]:
        return [f"{self.sf_dir}/{t}.parquet" for t in self.SOURCES]

    @property
    def root(self) -> str:
        if self._root is None:
            mark = fingerprint(self.spark, self.source_paths, self.params, layer_code())
            self._root = f"{shared_root(self.spark)}/ledgerline/retail/{mark}"
        return self._root

    def stored(self, table: str, write) -> str:
        """The folder of a complete ``table``; ``write(build folder)`` makes it where there is none."""

        def find():
            where = completed(self.spark, self.root, table)
            if where is None:
                build = f"{self.root}/{uuid.uuid4().hex}"
                with wide_shuffles(self.spark, stored_bytes(self.spark, self.source_paths)):
                    write(build)
                where = f"{build}/{table}"
            return where

        return self._frame(f"folder {table}", find)

    def _landed(self, layer: str, build) -> DataFrame:
        """The layer as stored; ``build()`` gives its rows where it is not there yet."""
        path = self.stored(layer, lambda root: build().write.parquet(f"{root}/{layer}", compression=LAYER_CODEC))
        return self.spark.read.schema(schemas.LAYER_SCHEMAS[layer]).parquet(path)

    def mart(self, name: str, build) -> DataFrame:
        """A gold mart: written once, read back (direct plan without layers)."""
        return self._frame(
            f"mart {name}", lambda: self._landed(f"gold/{name}", build) if self.materialize else build()
        )

    # -- raw: the adapter rows as they come from the driver tables
    def raw_sales(self) -> DataFrame:
        return self._frame("raw_sales", lambda: tables.sales_from_tables(self.spark, self.sf_dir))

    # -- silver: cleaned sales, partitioned by store
    def silver_root(self) -> str:
        """The folder that holds ``silver/sales``."""
        clean = lambda: quality.clean_sales(self.raw_sales(), self.params)
        path = self.stored("silver/sales", lambda root: lakehouse.write_silver_sales(clean(), root))
        return path.removesuffix("/silver/sales")

    def sales(self) -> DataFrame:
        def build():
            if not self.materialize:
                return quality.clean_sales(self.raw_sales(), self.params)
            stored = lakehouse.read_silver_sales(self.spark, self.silver_root(), timestamp_type=TimestampNTZType())
            return stored.select(*FACT_COLUMNS)

        return self._frame("sales", build)

    def customers(self) -> DataFrame:
        def rows():
            return quality.dimension(tables.customers_from_tables(self.spark, self.sf_dir), "customer_id")

        return self._frame(
            "customers", lambda: self._landed("silver/customers", rows) if self.materialize else rows()
        )

    def products(self) -> DataFrame:
        def rows():
            return quality.dimension(tables.products_from_tables(self.spark, self.sf_dir), "product_id")

        return self._frame("products", lambda: self._landed("silver/products", rows) if self.materialize else rows())

    # -- gold: the enriched star join
    def enriched(self) -> DataFrame:
        def rows():
            return marts.enrich(self.sales(), self.customers(), self.products())

        return self._frame(
            "enriched", lambda: self._landed("gold/enriched_sales", rows) if self.materialize else rows()
        )

    # -- typed events (JSON quantity parsed and price cast once) for the batch twin
    def events(self) -> DataFrame:
        def rows():
            return tables.events_from_tables(self.spark, self.sf_dir)

        return self._frame("events", lambda: self._landed("events/typed", rows) if self.materialize else rows())

    # -- the raw rows as CSV files, as a source system would deliver them
    def csv(self, name: str) -> str:
        """The folder of CSV files of ``sales``, ``customers``, ``products`` or ``events``."""

        def write(root):
            raw = {
                "sales": self.raw_sales,
                "customers": lambda: tables.customers_from_tables(self.spark, self.sf_dir),
                "products": lambda: tables.products_from_tables(self.spark, self.sf_dir),
                "events": lambda: tables.events_from_tables(self.spark, self.sf_dir),
            }[name]()
            if "timestamp" in raw.columns:
                raw = raw.withColumn("timestamp", F.date_format("timestamp", CSV_TIME))
            raw.write.option("header", True).csv(f"{root}/csv/{name}")

        return self.stored(f"csv/{name}", write)

    def csv_corrupt_sales(self) -> DataFrame:
        """Sales read from CSV files some of whose lines are damaged (see ``damaged_lines``)."""

        def write(root):
            # The column's name is the header, which the writer puts first in every file; no field is quoted.
            plain = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            lines = damaged_lines(self.raw_sales()).withColumnRenamed("line", ",".join(SALES_SCHEMA.names))
            lines.write.options(**plain).csv(f"{root}/csv/corrupt_sales")

        return self._frame(
            "csv_corrupt", lambda: read_sales_csv(self.spark, self.stored("csv/corrupt_sales", write))
        )

    def csv_sales(self) -> DataFrame:
        return self._frame("csv_sales", lambda: read_sales_csv(self.spark, self.csv("sales")))

    def prepare(self) -> "Retail":
        """Build every layer now (otherwise each is built on first use)."""
        self.enriched()
        self.events()
        return self


def damaged_lines(raw: DataFrame) -> DataFrame:
    """(line): sales rows as CSV lines, damaged by the transaction id modulo 20.

    1: the line stops after the store; 2: a field too many; 3: a quantity that is
    no number; 4: no customer; 5: no price; 6: quantity 0; 7: a timestamp that is
    none; others are whole.
    """
    kind = F.pmod(F.col("transaction_id").try_cast("long"), F.lit(20))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    swap = lambda c, k, new: F.when(kind == k, F.lit(new)).otherwise(c)
    ids = [
        text(F.col("transaction_id")),
        swap(text(F.col("customer_id")), 4, ""),
        text(F.col("product_id")),
        text(F.col("store_id")),
    ]
    quantity = swap(swap(text(F.col("quantity")), 3, "many"), 6, "0")
    price = swap(text(F.col("price")), 5, "")
    time = swap(text(F.date_format("timestamp", CSV_TIME)), 7, "not a time")
    full = F.concat_ws(",", *ids, quantity, price, time)
    line = F.when(kind == 1, F.concat_ws(",", *ids)).when(kind == 2, F.concat(full, F.lit(",more"))).otherwise(full)
    return raw.select(line.alias("line"))


def _fact_out(df: DataFrame) -> DataFrame:
    return df.select(
        *[money_out(c).alias(c) if c in ("price", "revenue") else F.col(c) for c in FACT_COLUMNS]
    )


# ------------------------------------------------------------------ phase 1/2

def q_clean_sales(spark, sf_dir):
    return _fact_out(Retail(spark, sf_dir).sales())


def q_high_value_sales(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return _fact_out(marts.high_value_sales(r.sales(), r.params.high_value_threshold))


def q_rejected_rows(spark, sf_dir):
    return quality.rejected_rows(Retail(spark, sf_dir).raw_sales(), REJECT_PARAMS)


def q_product_revenue(spark, sf_dir):
    return marts.with_money_out(marts.product_revenue(Retail(spark, sf_dir).sales()), "revenue")


def q_top10_products(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return marts.with_money_out(marts.top_products(r.sales(), r.params.top_k_products), "revenue")


def q_revenue_by_city(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return marts.with_money_out(marts.revenue_by_city(r.sales(), r.customers()), "total_revenue")


def q_enriched_sales(spark, sf_dir):
    e = Retail(spark, sf_dir).enriched()
    return e.select(
        *[money_out(c).alias(c) if c in ("price", "revenue") else F.col(c) for c in ENRICHED_COLUMNS]
    )


def q_top5_products(spark, sf_dir):
    r = Retail(spark, sf_dir)
    top = marts.top_products_with_attributes(
        r.sales(), r.products(), r.params.top_k_products_with_attrs
    )
    return marts.with_money_out(top, "total_revenue")


def q_monthly_trend(spark, sf_dir):
    return marts.with_money_out(marts.monthly_trend(Retail(spark, sf_dir).sales()), "monthly_revenue")


# ------------------------------------------------------------------ gold

def q_gold_revenue_by_city(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return r.mart("revenue_by_city", lambda: marts.gold_revenue_by_city(r.enriched()))


def q_gold_revenue_by_category(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return r.mart("revenue_by_category", lambda: marts.gold_revenue_by_category(r.enriched()))


def q_gold_customer_segments(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return r.mart("customer_segments", lambda: marts.gold_customer_segments(r.enriched()))


def q_gold_monthly_trend(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return r.mart("monthly_trend", lambda: marts.gold_monthly_trend(r.enriched()))


def q_fact_sales(spark, sf_dir):
    """The published gold fact, as written and read back."""
    r = Retail(spark, sf_dir)
    return _fact_out(r.mart("fact_sales", lambda: star.fact_sales(r.sales())))


def q_dim_customer(spark, sf_dir):
    return star.dim_customer(Retail(spark, sf_dir).customers())


def q_dim_product(spark, sf_dir):
    return star.dim_product(Retail(spark, sf_dir).products())


def q_dim_date(spark, sf_dir):
    return star.dim_date(Retail(spark, sf_dir).sales())


def q_fact_sample(spark, sf_dir):
    sample = star.fact_sample(Retail(spark, sf_dir).enriched())
    return marts.with_money_out(sample, "revenue")


# ------------------------------------------------------------------ CSV, bronze, views

def q_csv_clean_sales(spark, sf_dir):
    """Cleaned sales read from CSV files (text timestamps parsed)."""
    r = Retail(spark, sf_dir)
    clean = quality.clean_sales(r.csv_sales(), r.params)
    return _fact_out(clean).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_csv_rejected_rows(spark, sf_dir):
    return quality.rejected_rows(Retail(spark, sf_dir).csv_sales(), REJECT_PARAMS)


def q_csv_profile(spark, sf_dir):
    """Row and null-key counts of the three CSV inputs, after their frame checks."""
    r = Retail(spark, sf_dir)
    frames = {
        "sales": (r.csv_sales(), SALES_KEYS),
        "customers": (read_customers_csv(spark, r.csv("customers")), ("customer_id",)),
        "products": (read_products_csv(spark, r.csv("products")), ("product_id",)),
    }
    for name, (df, keys) in frames.items():
        quality.check_frame(df, name, keys)
    return quality.table_profile(frames)


def q_bronze_sales(spark, sf_dir):
    """Raw sales landed as bronze (every field a string) and read back."""
    r = Retail(spark, sf_dir)

    def land(root):
        lakehouse.land_bronze(spark, {"sales": read_raw_csv(spark, r.csv("sales"))}, root)

    return spark.read.parquet(r.stored("bronze/sales", land))


def _bronze_dimension(spark, sf_dir, name):
    r = Retail(spark, sf_dir)

    def land(root):
        lakehouse.land_bronze(spark, {name: read_raw_csv(spark, r.csv(name))}, root)

    return spark.read.parquet(r.stored(f"bronze/{name}", land))


def q_bronze_customers(spark, sf_dir):
    """Raw customers landed as bronze (every field a string) and read back."""
    return _bronze_dimension(spark, sf_dir, "customers")


def q_bronze_products(spark, sf_dir):
    """Raw products landed as bronze (every field a string) and read back."""
    return _bronze_dimension(spark, sf_dir, "products")


def q_csv_corrupt_rejects(spark, sf_dir):
    """Rows accepted, and rejected by reason, of CSV files with damaged lines: (reason, n)."""
    r = Retail(spark, sf_dir)
    raw = r.csv_corrupt_sales()
    reason = F.coalesce(quality.reject_reason(raw, r.params), F.lit("accepted"))
    return raw.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def q_csv_corrupt_trend(spark, sf_dir):
    """Both monthly trends where timestamps are damaged: gold keeps the null month, SQL leaves it out."""
    r = Retail(spark, sf_dir)
    clean = quality.clean_sales(r.csv_corrupt_sales(), r.params)
    gold = marts.gold_monthly_trend(clean).select(F.lit("gold").alias("trend"), "*")
    plain = marts.with_money_out(marts.monthly_trend(clean), "monthly_revenue").select(F.lit("sql").alias("trend"), "*")
    return gold.unionByName(plain)


def q_layer_audit(spark, sf_dir):
    """Rows of silver and of the rejects table by reason, counted from committed files: (layer, n)."""
    r = Retail(spark, sf_dir)

    def write(root):
        raw = r.csv_corrupt_sales()
        lakehouse.write_silver_sales(quality.clean_sales(raw, r.params), f"{root}/audit")
        lakehouse.write_rejects(raw, f"{root}/audit", r.params)

    return lakehouse.sales_audit(spark, r.stored("audit/silver/rejects", write).removesuffix("/silver/rejects"))


def q_view_store_revenue(spark, sf_dir):
    """Revenue per store in Spark SQL over the registered views."""
    r = Retail(spark, sf_dir)
    register_retail_views(spark, r.sales(), r.customers(), r.products())
    return spark.sql(
        "SELECT store_id, CAST(SUM(revenue) AS DOUBLE) AS revenue, COUNT(*) AS n FROM sales GROUP BY store_id"
    )

# ------------------------------------------------------------------ alerts and quality

def q_daily_revenue(spark, sf_dir):
    return marts.with_money_out(marts.daily_revenue(Retail(spark, sf_dir).enriched()), "daily_revenue")


def q_low_sales_days(spark, sf_dir):
    r = Retail(spark, sf_dir)
    alerts = marts.low_sales_days(marts.daily_revenue(r.enriched()), r.params.sales_alert_threshold)
    return marts.with_money_out(alerts, "daily_revenue")


def q_low_sales_alerts(spark, sf_dir):
    """The alert table as the job writes it, read back."""
    r = Retail(spark, sf_dir)
    path = r.stored(
        "gold/low_sales_alerts", lambda root: lakehouse.write_low_sales_alerts(r.enriched(), r.params, root)
    )
    alerts = spark.read.schema("date date, daily_revenue decimal(33,2)").parquet(path)
    return marts.with_money_out(alerts, "daily_revenue")


def q_store_low_sales_days(spark, sf_dir):
    """Days on which one store sold little, days without any sale among them."""
    r = Retail(spark, sf_dir)
    store = r.sales().filter(F.col("store_id") == SILVER_STORE)
    calendar = star.dim_date(r.sales())
    alerts = marts.low_sales_days(marts.daily_revenue(store), STORE_ALERT, calendar)
    return marts.with_money_out(alerts, "daily_revenue")


def q_bronze_profile(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return quality.table_profile(
        {
            "sales": (r.raw_sales(), SALES_KEYS),
            "customers": (r.customers(), ("customer_id",)),
            "products": (r.products(), ("product_id",)),
        }
    )


def q_orphan_customers(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return quality.orphan_keys(r.sales(), r.customers(), "customer_id")


def q_orphan_products(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return quality.orphan_keys(r.sales(), r.products(), "product_id")


def q_duplicate_customers(spark, sf_dir):
    return quality.duplicate_keys(Retail(spark, sf_dir).customers(), "customer_id")


def q_duplicate_products(spark, sf_dir):
    return quality.duplicate_keys(Retail(spark, sf_dir).products(), "product_id")


def q_orphan_orders(spark, sf_dir):
    """Orders without any line: (transaction_id, n_sales)."""
    orders = tables.read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("transaction_id"))
    lines = tables.read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("transaction_id"))
    return quality.orphan_keys(orders, lines.distinct(), "transaction_id")


def q_duplicate_lines(spark, sf_dir):
    lines = tables.read_table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lines, "l_orderkey", "l_linenumber")


# ------------------------------------------------------------------ lakehouse

def q_silver_store_sales(spark, sf_dir):
    """One store read back from the store-partitioned silver layer.

    The store filter becomes a partition filter: only that store's
    directory is listed and read.
    """
    r = Retail(spark, sf_dir)
    return _fact_out(lakehouse.read_silver_sales(spark, r.silver_root(), SILVER_STORE, TimestampNTZType()))


# ------------------------------------------------------------------ measures

def q_total_sales(spark, sf_dir):
    return measures.total_sales(Retail(spark, sf_dir).sales())


def q_average_order_value(spark, sf_dir):
    return measures.average_order_value(Retail(spark, sf_dir).sales())


def q_customer_count(spark, sf_dir):
    return measures.customer_count(Retail(spark, sf_dir).sales())


def q_top_category(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return measures.top_category(r.sales(), r.products())


def q_sales_growth_mtd(spark, sf_dir):
    return measures.sales_growth_mtd(Retail(spark, sf_dir).sales())


def q_sales_growth_by_month(spark, sf_dir):
    return measures.sales_growth_by_month(Retail(spark, sf_dir).sales())


def q_sales_growth_by_day(spark, sf_dir):
    sales = Retail(spark, sf_dir).sales()
    return measures.growth_by_day(sales, star.dim_date(sales))


def q_revenue_by_segment(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return measures.revenue_by_segment(r.sales(), r.customers())


# ------------------------------------------------------------------ visuals

def q_executive_overview(spark, sf_dir):
    return visuals.executive_overview(Retail(spark, sf_dir).sales())


def q_sales_by_city(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return visuals.sales_by_city(r.sales(), r.customers())


def q_sales_trend(spark, sf_dir):
    return visuals.sales_trend(Retail(spark, sf_dir).sales())


def q_sales_by_brand(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return visuals.sales_by_brand(r.sales(), r.products())


def q_sales_by_category(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return visuals.sales_by_category(r.sales(), r.products())


def q_segment_summary(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return visuals.segment_summary(r.sales(), r.customers())


# ------------------------------------------------------------------ streaming

def q_windowed_demand(spark, sf_dir):
    r = Retail(spark, sf_dir)
    return windowed_demand(r.events(), window=r.params.window_duration, params=r.params)


def q_demand_spikes(spark, sf_dir):
    r = Retail(spark, sf_dir)
    windows = windowed_demand(r.events(), window=r.params.window_duration, params=r.params)
    return demand_spikes(windows, r.params.spike_factor)


def _run_stream(spark, sf_dir, stream: DataFrame | None = None) -> str:
    p = QUERY_PARAMS
    root = shared_dir(spark, "stream")
    if stream is None:
        stream = tables.events_stream_from_tables(spark, sf_dir, p.max_bytes_per_trigger)
    run_demand_stream(
        stream,
        sink_path=f"{root}/output",
        checkpoint_path=f"{root}/checkpoint",
        window=p.window_duration,
        watermark=p.watermark_delay,
        params=p,
    )
    return f"{root}/output"


WINDOW_SCHEMA = (
    "window_start timestamp_ntz, window_end timestamp_ntz, product_id string, total_qty bigint, window_revenue double"
)


def _read_sink(spark, path) -> DataFrame:
    return spark.read.schema(WINDOW_SCHEMA).parquet(path).select(*WINDOW_COLUMNS)


def q_stream_windowed_demand(spark, sf_dir):
    """Structured Streaming run (availableNow, append, watermark) read back."""
    return _read_sink(spark, _run_stream(spark, sf_dir))


def q_stream_demand_spikes(spark, sf_dir):
    """Spike detection over the streaming sink, as in the original job."""
    return demand_spikes(_read_sink(spark, _run_stream(spark, sf_dir)), QUERY_PARAMS.spike_factor)


def q_csv_stream_windowed_demand(spark, sf_dir):
    """The stream over a directory of CSV files (text timestamps)."""
    stream = sales_csv_stream(spark, Retail(spark, sf_dir).csv("events"))
    return _read_sink(spark, _run_stream(spark, sf_dir, stream))


class Feed:
    """A folder that ``events`` are delivered to, drained into one sink on one checkpoint."""

    def __init__(self, spark, sf_dir):
        self.spark, self.root = spark, shared_dir(spark, "feed")
        self.events = tables.read_table(spark, sf_dir, "events")
        self.micros, self.middle = tables.event_halves(self.events)
        self.early = F.coalesce(self.micros < self.middle, F.lit(True))  # before the middle of the span

    def deliver(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.root}/in")

    def stream(self, max_files: int | None = None) -> DataFrame:
        return tables.events_stream_from_folder(self.spark, f"{self.root}/in", max_files)

    def drain(self, **more):
        p = QUERY_PARAMS
        return run_demand_stream(
            self.stream(),
            f"{self.root}/out",
            f"{self.root}/checkpoint",
            p.window_duration,
            p.watermark_delay,
            p,
            **more,
        )

    def sink(self) -> DataFrame:
        return _read_sink(self.spark, f"{self.root}/out")


def q_stream_resumed_demand(spark, sf_dir):
    """Half of the events drained, the query ended, the rest drained on the same checkpoint (state recovered)."""
    feed = Feed(spark, sf_dir)
    for part in (feed.early, ~feed.early):
        feed.deliver(feed.events.filter(part))
        feed.drain()
    return feed.sink()


def _late_feed(spark, sf_dir) -> Feed:
    """A tenth of the early events arrives with the later half, after the watermark has moved."""
    feed = Feed(spark, sf_dir)
    late = feed.early & (F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(10)) == 3)
    for part in (feed.early & ~late, ~feed.early | late):
        feed.deliver(feed.events.filter(part))
        feed.drain()
    return feed


def q_stream_late_demand(spark, sf_dir):
    """Windows of a stream some of whose events come too late and are dropped."""
    return _late_feed(spark, sf_dir).sink()


def q_stream_late_report(spark, sf_dir):
    """By window and product the quantity that came too late for the stream."""
    p = QUERY_PARAMS
    complete = windowed_demand(Retail(spark, sf_dir).events(), window=p.window_duration, params=p)
    sink = _late_feed(spark, sf_dir).sink()
    closed = sink.agg(F.max("window_end")).scalar()  # the last window that the watermark has closed
    return late_demand(complete.filter(F.col("window_end") <= closed), sink)


def q_stream_spikes_by_drain(spark, sf_dir):
    """Spikes over all windows so far, asked after each of two drains; every batch stored by its id, twice."""
    p, feed = QUERY_PARAMS, Feed(spark, sf_dir)
    root, shape = f"{feed.root}/batches", WINDOW_SCHEMA
    asked = []
    for number, part in enumerate((feed.early, ~feed.early), 1):
        feed.deliver(feed.events.filter(part))
        windows = windowed_demand(feed.stream(), p.window_duration, p.watermark_delay, p)
        replay = lambda batch, i: batch_sink.write_batch(batch, i, root)  # noqa: E731  as after a lost commit
        batch_sink.drain_batches(windows, root, f"{feed.root}/checkpoint", after=replay)
        spikes = demand_spikes(batch_sink.read_batches(spark, root, shape), p.spike_factor)
        spikes.select(F.lit(number).alias("drain"), "*").write.parquet(f"{feed.root}/spikes/{number}")
        asked.append(f"{feed.root}/spikes/{number}")
    return spark.read.schema(f"drain int, {shape}").parquet(*asked)


def q_stream_rate_limited(spark, sf_dir):
    """All windows by a stream that admits a quarter of its files at a time; whether it took several batches."""
    p, feed = QUERY_PARAMS, Feed(spark, sf_dir)
    files = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    feed.deliver(feed.events.repartition(files, "event_id"))
    windows = windowed_demand(feed.stream(-(-files // 4)), p.window_duration, None, p)
    root = f"{feed.root}/batches"
    batches = batch_sink.drain_batches(windows, root, f"{feed.root}/checkpoint", mode="complete")
    rows = batch_sink.latest_batch(spark, root, WINDOW_SCHEMA)
    return rows.select(*WINDOW_COLUMNS, F.lit(batches > 1).alias("several_batches"))


def q_stream_bounded_wait(spark, sf_dir):
    """A drain stopped by its time limit, taken up again once more events are there: nothing lost, nothing twice."""
    feed = Feed(spark, sf_dir)
    feed.deliver(feed.events.filter(feed.early))
    first = feed.drain(timeout_s=0.0, on_timeout="return")
    feed.deliver(feed.events.filter(~feed.early))
    feed.drain()
    return feed.sink().withColumn("stopped_first", F.lit(not first.finished))


QUERIES: dict[str, Query] = {
    "revenue_by_city": q_revenue_by_city,
    "clean_sales": q_clean_sales,
    "high_value_sales": q_high_value_sales,
    "rejected_rows": q_rejected_rows,
    "product_revenue": q_product_revenue,
    "top10_products": q_top10_products,
    "enriched_sales": q_enriched_sales,
    "top5_products": q_top5_products,
    "monthly_trend": q_monthly_trend,
    "gold_revenue_by_city": q_gold_revenue_by_city,
    "gold_revenue_by_category": q_gold_revenue_by_category,
    "gold_customer_segments": q_gold_customer_segments,
    "gold_monthly_trend": q_gold_monthly_trend,
    "fact_sales": q_fact_sales,
    "daily_revenue": q_daily_revenue,
    "low_sales_days": q_low_sales_days,
    "bronze_profile": q_bronze_profile,
    "orphan_customers": q_orphan_customers,
    "orphan_products": q_orphan_products,
    "duplicate_customers": q_duplicate_customers,
    "duplicate_products": q_duplicate_products,
    "silver_store_sales": q_silver_store_sales,
    "total_sales": q_total_sales,
    "average_order_value": q_average_order_value,
    "customer_count": q_customer_count,
    "top_category": q_top_category,
    "sales_growth_mtd": q_sales_growth_mtd,
    "sales_growth_by_month": q_sales_growth_by_month,
    "revenue_by_segment": q_revenue_by_segment,
    "executive_overview": q_executive_overview,
    "sales_by_city": q_sales_by_city,
    "sales_trend": q_sales_trend,
    "sales_by_brand": q_sales_by_brand,
    "sales_by_category": q_sales_by_category,
    "segment_summary": q_segment_summary,
    "windowed_demand": q_windowed_demand,
    "demand_spikes": q_demand_spikes,
    "stream_windowed_demand": q_stream_windowed_demand,
    "stream_demand_spikes": q_stream_demand_spikes,
    "csv_stream_windowed_demand": q_csv_stream_windowed_demand,
    "csv_clean_sales": q_csv_clean_sales,
    "csv_rejected_rows": q_csv_rejected_rows,
    "csv_profile": q_csv_profile,
    "bronze_sales": q_bronze_sales,
    "view_store_revenue": q_view_store_revenue,
    "orphan_orders": q_orphan_orders,
    "duplicate_lines": q_duplicate_lines,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "dim_date": q_dim_date,
    "fact_sample": q_fact_sample,
    "bronze_customers": q_bronze_customers,
    "bronze_products": q_bronze_products,
    "csv_corrupt_rejects": q_csv_corrupt_rejects,
    "csv_corrupt_trend": q_csv_corrupt_trend,
    "layer_audit": q_layer_audit,
    "low_sales_alerts": q_low_sales_alerts,
    "store_low_sales_days": q_store_low_sales_days,
    "sales_growth_by_day": q_sales_growth_by_day,
    "stream_resumed_demand": q_stream_resumed_demand,
    "stream_late_demand": q_stream_late_demand,
    "stream_late_report": q_stream_late_report,
    "stream_spikes_by_drain": q_stream_spikes_by_drain,
    "stream_rate_limited": q_stream_rate_limited,
    "stream_bounded_wait": q_stream_bounded_wait,
}
