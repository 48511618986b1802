"""Whole-layer chains (C4 batch, C5 incremental).

``run_batch`` wires raw tables -> cleaned tables -> star tables -> reports ->
masked customer view. Without a store the outputs are lazy DataFrames; with
one (``table_store`` / ``folder_store``) every layer is written as it is
built, its independent tables concurrently, and the next layer reads the
written tables, so a lost executor only recomputes the current layer.
``publish_all`` writes lazily built outputs; ``run_increment`` appends new
landing files through file streams, then recomputes the layers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.operators.governance import CUSTOMER_COLUMN_METADATA, classify_columns, mask_columns
from layercake.plans.catalog import RAW_SCHEMAS, SPECS, raw_table_name
from layercake.plans.checks import Overlap, Reference, Suite, VersionMatch, assert_no_failures, quality_report
from layercake.plans.reports import LayerPair, layer_report, profile_report
from layercake.plans.spec import clean
from layercake.plans.star import build_fact, customer_dimension, product_dimension
from layercake.session import materialize
from layercake.streaming.ingest import ingest_increment, read_sink

# Checks of the three star tables.
STAR_SUITES = {
    "gold_dim_customers": Suite(
        keys=("customer_id",),
        secondary_keys=(("customer_key",),),
        required=("customer_id", "customer_key", "firstname", "lastname", "marital_status", "gender", "country",
                  "birth_date", "creation_date"),
        rules={"future_birth_date": lambda as_of: F.col("birth_date") > as_of},
    ),
    "gold_dim_product": Suite(
        keys=("product_id",),
        secondary_keys=(("product_key", "start_date"),),
        required=("product_id", "product_key", "product_name", "cost", "product_line", "start_date", "category_id",
                  "category", "subcategory", "maintenance"),
        rules={
            "negative_cost": "cost < 0",
            "invalid_date_range": "end_date IS NOT NULL AND end_date < start_date",
        },
        overlaps=(Overlap("product_key", "start_date", "end_date", name="product_validity_overlap", tie=("product_id",)),),
    ),
    "gold_fact_sales": Suite(
        keys=("order_number", "product_key"),
        required=("order_number", "product_key", "customer_id", "order_date", "ship_date", "due_date",
                  "sales_amount", "quantity", "price"),
        rules={
            "negative_sales_amount": "sales_amount < 0",
            "non_positive_quantity": "quantity <= 0",
            "negative_price": "price < 0",
            "ship_before_order": "ship_date IS NOT NULL AND order_date IS NOT NULL AND ship_date < order_date",
            "due_before_order": "due_date IS NOT NULL AND order_date IS NOT NULL AND due_date < order_date",
        },
        references=(
            Reference("customer_id", "gold_dim_customers", name="customer_referential_integrity"),
            Reference("product_key", "gold_dim_product", name="product_referential_integrity"),
        ),
        versions=(
            VersionMatch("product_key", "order_date", "gold_dim_product", "start_date", "end_date",
                         name="historical_product_version_match"),
        ),
    ),
}


Store = Callable[[str, DataFrame], DataFrame]


#: A step: name, names of the tables it needs, and a function of them.
Step = tuple[str, tuple[str, ...], Callable[..., DataFrame]]


def _run_steps(steps: Sequence[Step], keep: Store, workers: int) -> dict[str, DataFrame]:
    """Build and store each step's table. With ``workers > 1`` a table is built
    and written from a driver thread as soon as its own inputs are stored
    (no barrier between layers). Steps come after those they need, so a
    waiting thread only ever waits for earlier ones."""
    out: dict[str, DataFrame] = {}
    if workers <= 1:
        for name, needs, build in steps:
            out[name] = keep(name, build(*[out[n] for n in needs]))
        return out
    from concurrent.futures import ThreadPoolExecutor

    futures: dict = {}

    def run(name, needs, build):
        return keep(name, build(*[futures[n].result() for n in needs]))

    with ThreadPoolExecutor(max_workers=workers) as pool:
        for name, needs, build in steps:
            futures[name] = pool.submit(run, name, needs, build)
        return {name: f.result() for name, f in futures.items()}


REPORTS = ("diagnostics_bronze", "silver_diagnostics", "diagnostic_gold")


def run_batch(
    raw: Mapping[str, DataFrame],
    as_of=None,
    owners: Sequence[str] = (),
    principal=None,
    store: Store | None = None,
    workers: int = 4,
    reports: Sequence[str] = REPORTS,
    fail_on_failure: bool = False,
) -> dict[str, DataFrame]:
    """All layers from raw source DataFrames keyed by source name (C4).

    Without ``store`` every output is a lazy DataFrame. With ``store`` (see
    ``table_store`` / ``folder_store``) this function writes: each table as soon
    as its own inputs are stored, and later layers and reports read the
    written table, so no upstream plan is recomputed per consumer and a lost
    executor only redoes the current table; tables that do not need each other are
    written concurrently. Only the ``reports`` asked for are built. Failed
    checks are recorded, not raised, unless ``fail_on_failure`` (then the star
    report is computed and a ``RuntimeError`` names the number of failed checks).
    """
    unknown = set(reports) - set(REPORTS)
    if unknown:
        raise ValueError(f"Unknown reports: {sorted(unknown)}")
    steps: list[Step] = []
    for source, df in raw.items():
        spec, name = SPECS[source], raw_table_name(source)
        steps.append((name, (), lambda df=df: df))
        steps.append((spec.target, (name,), lambda t, spec=spec: clean(t, spec, as_of)))
    have = {n for n, _, _ in steps}
    for name, needs, build in (
        ("gold_dim_customers", ("silver_customer_info", "silver_customer_demographics", "silver_customer_location"), customer_dimension),
        ("gold_dim_product", ("silver_product_info", "silver_product_category"), product_dimension),
        ("gold_fact_sales", ("silver_sales_details",), build_fact),
    ):
        if have.issuperset(needs):
            steps.append((name, needs, build))
    have = {n for n, _, _ in steps}
    raw_names = tuple(raw_table_name(s) for s in raw)
    targets = tuple(SPECS[s].target for s in raw)
    stars = tuple(n for n in STAR_SUITES if n in have)

    def layer(*tables):
        n = len(raw_names)
        return layer_report([
            LayerPair(r, tables[i], SPECS[s].target, tables[n + i], SPECS[s].renamed_keys())
            for i, (s, r) in enumerate(zip(raw, raw_names))
        ])

    def star(*tables):
        found = dict(zip(stars, tables))
        return quality_report({n: found.get(n) for n in STAR_SUITES}, STAR_SUITES, as_of=as_of)

    built = {
        "diagnostics_bronze": (raw_names, lambda *tables: profile_report(dict(zip(raw_names, tables)), prefix="bronze_")),
        "silver_diagnostics": ((*raw_names, *targets), layer),
        "diagnostic_gold": (stars, star),
    }
    steps += [(name, *built[name]) for name in REPORTS if name in reports]
    out = _run_steps(steps, store or (lambda name, df: df), workers if store is not None else 1)
    if "gold_dim_customers" in out:
        out["gold_dim_customers"] = classify_columns(out["gold_dim_customers"], CUSTOMER_COLUMN_METADATA)
        # a view: masking is evaluated when it is read, so it is never stored
        out["gold_dim_customers_secure"] = mask_columns(out["gold_dim_customers"], owners=owners, principal=principal)
    if fail_on_failure:
        assert_no_failures(out["diagnostic_gold"] if "diagnostic_gold" in out else star(*[out[n] for n in stars]))
    return out


def table_store(database: str | None = None) -> Store:
    """Store each layer as a catalog table (overwrite) and read it back."""
    from layercake.sources.sinks import publish_table

    def store(name: str, df: DataFrame) -> DataFrame:
        target = f"{database}.{name}" if database else name
        publish_table(df, target)
        return df.sparkSession.table(target)

    return store


def folder_store() -> Store:
    """Store each layer as parquet under the session's checkpoint folder."""

    def store(name: str, df: DataFrame) -> DataFrame:
        return materialize(df, name)

    return store


VIEWS = frozenset({"gold_dim_customers_secure"})


def publish_all(
    outputs: Mapping[str, DataFrame], database: str | None = None, views: frozenset[str] = VIEWS
) -> list[str]:
    """Write every output as a table (for lazily built outputs). Outputs named
    in ``views`` (the masked customer view) are registered as temporary views
    instead, so their owner check keeps running at query time."""
    from layercake.sources.sinks import publish_table

    written = []
    for name, df in outputs.items():
        if name in views:
            df.createOrReplaceTempView(name)
            written.append(name)
            continue
        target = f"{database}.{name}" if database else name
        written.append(publish_table(df, target))
    return written


def run_increment(
    spark: SparkSession,
    landing: Mapping[str, str],
    sinks: Mapping[str, str],
    as_of=None,
    owners: Sequence[str] = (),
    store: Store | None = None,
    options: Mapping[str, str] | None = None,
    reports: Sequence[str] = REPORTS,
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Append new landing files per source, then recompute every layer over
    the full appended raw tables (C5). Returns new-row counts and outputs.
    ``options`` are CSV read options of the landing files."""
    counts = {}
    raw = {}
    for source, folder in landing.items():
        counts[source] = ingest_increment(spark, folder, RAW_SCHEMAS[source], sinks[source], options=options)
        raw[source] = read_sink(spark, sinks[source], RAW_SCHEMAS[source])
    return counts, run_batch(raw, as_of=as_of, owners=owners, store=store, reports=reports)
