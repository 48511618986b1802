"""Keyed incremental recompute of the star chain.

New raw rows name the keys they touch. Only rows of those keys go through
the windows (deduplication, validity ends) and joins again, and only the key
buckets that hold them are read and rewritten; all other buckets keep their
folders. All tables of one increment are published by one manifest (see
``sources.versioned``), together with the names of the intake files they
contain, so a job that dies and is run again neither loses nor repeats rows.

Tables of the store, each dealt into buckets by a key:

* ``raw_<source>``: every raw row after the row-wise cleaning rules, by the
  first window's key (history; increments append);
* ``versions``: product rows with validity ends, by product id;
* ``silver_*``: cleaned tables, by their deduplication key;
* ``gold_dim_customers`` by customer key, ``gold_dim_product`` by category.
  They hold every column of the cleaned table they start from, so a changed
  lookup finds the rows to join again in the dimension itself.

The fact is a projection of the cleaned sales and is not stored twice.

Every row is shuffled only where its key occurs again: 64-bit hashes of the keys tell which do (``Meeting``). Rows that
are kept go from folder to folder in their buckets, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layercake.functions.columns import c
from layercake.operators import rules
from layercake.operators.integrity import BROADCAST_KEYS, _bits
from layercake.operators.versions import derive_end_date
from layercake.plans.catalog import SPECS
from layercake.plans.spec import TableSpec, _apply, _dedupe
from layercake.plans.star import CUSTOMER_DIM_COLUMNS, PRODUCT_DIM_COLUMNS, build_fact, customer_dimension, product_dimension
from layercake.session import materialize
from layercake.sources.versioned import Snapshot, Transaction, VersionedStore, bucket_of, exists

#: Validity ends are computed by this key before products are deduplicated by their id.
_VERSION_KEY = "prd_key"


def prepare(df: DataFrame, spec: TableSpec, as_of=None) -> DataFrame:
    """The cleaning rules that look at one row only (C1 up to the casts)."""
    df = rules.trim_nullify(df)
    df = rules.regex_rules(df, spec.regex)
    df = _apply(df, spec.transforms_before, as_of)
    df = rules.value_map(df, spec.value_maps)
    df = rules.safe_date(df, spec.dates)
    return rules.safe_cast(df, spec.casts)


def finish(df: DataFrame, spec: TableSpec, as_of=None, windows: bool = True) -> DataFrame:
    """What follows on prepared rows; ``windows=False`` if validity ends are there already."""
    if windows:
        df = _apply(df, spec.transforms_after, as_of)
    df = rules.fill_nulls(df, spec.fill)
    df = _dedupe(df, spec)
    df = rules.require_not_null(df, spec.required)
    return rules.rename_strict(df, spec.rename)


def same_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on key columns, NULL equal to NULL; adaptive execution picks the join."""
    marked = keys.select(*[c(k).alias(f"__k{i}") for i, k in enumerate(keys.columns)])
    on = F.lit(True)
    for i, k in enumerate(keys.columns):
        on = on & c(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(marked, on, how)


def _key_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.coalesce(c(k).cast("string"), F.lit("\u0000")) for k in df.columns])


class Meeting:
    """The keys of new rows that occur more than once in old and new rows, as a Bloom filter, so that other rows are neither shuffled nor joined.

    Only 64-bit hashes of the keys are shuffled to find them; the filter is made of those that occur again, with at most
    ``BROADCAST_KEYS`` words (with more keys it lets more rows through; those that pass are compared key by key in any case).
    """

    def __init__(self, old: DataFrame | None, new: DataFrame, bits_per_key: int = 16):
        every = new.select(_key_hash(new).alias("__h"), F.lit(True).alias("__new"))
        if old is not None:
            every = every.unionByName(old.select(_key_hash(old).alias("__h"), F.lit(False).alias("__new")))
        again = every.groupBy("__h").agg(F.count(F.lit(1)).alias("__n"), F.max("__new").alias("__new")).where("__n > 1 AND __new")
        both = materialize(again.select("__h"), "met-keys")
        self.words = max(1, min(BROADCAST_KEYS, both.count() * bits_per_key // 64))
        word, mask = _bits(F.col("__h"), self.words)
        bloom = both.select(word.alias("__word"), mask.alias("__mask")).groupBy("__word").agg(F.bit_or("__mask").alias("__bits"))
        self.bloom = materialize(bloom, "met-bits")
        self.new = self.split(new, new.columns)[0].distinct()

    def split(self, df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """Rows that may have a shared key, and rows that have none."""
        word, mask = _bits(_key_hash(df.select(*[c(k) for k in keys])), self.words)
        rows = df.select(F.struct(*[c(n) for n in df.columns]).alias("__row"), word.alias("__word"), mask.alias("__mask"))
        rows = rows.join(F.broadcast(self.bloom), "__word", "left")  # at most ``words`` rows of two numbers
        passed = F.coalesce(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
        return rows.where(passed).select("__row.*"), rows.where(~passed).select("__row.*")

    def semi(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return same_keys(self.split(df, keys)[0], self.new.toDF(*keys), "left_semi")

    def anti(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        passed, rest = self.split(df, keys)
        return rest.unionByName(same_keys(passed, self.new.toDF(*keys), "left_anti"))


@dataclass
class Increment:
    """What one increment read and rewrote: bucket numbers by table."""

    snapshot: Snapshot
    touched: dict[str, list[int]] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


class IncrementalStar:
    """The star tables under ``root``, kept up to date by ``apply``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, as_of=None, workers: int = 4):
        self.spark, self.store, self.n, self.as_of, self.workers = spark, VersionedStore(spark, root), buckets, as_of, workers

    # --- one table ---------------------------------------------------------------------------------------------

    def _update(self, work: Transaction, name: str, keys: Sequence[str], fresh: DataFrame, changed: DataFrame, log: Increment,
                met: Meeting | None = None) -> tuple[DataFrame, DataFrame | None]:
        """Replace the rows of ``changed`` keys by ``fresh``; returns the fresh rows as stored and those that were there before (None: a new table).

        ``changed`` names the key columns of the table; the buckets of both are the ones rewritten. ``met``: the changed keys
        that the table may have, if they are known.
        """
        old = work.base.tables.get(name)
        if old is None:
            stored = work.replace(name, fresh, keys, self.n)
            log.touched[name] = sorted(int(b) for b in work.tables[name]["parts"])
            return stored, None
        changed = changed.select(*[c(k) for k in keys])
        touched = work.base.touched(name, changed)
        before = work.base.read(name, touched)
        met = met or Meeting(before.select(*[c(k) for k in keys]), changed)
        stored = work.replace(name, fresh.select(*before.columns), keys, self.n, touched, kept=met.anti(before, keys))
        log.touched[name] = touched
        return stored, met.semi(before, keys)

    def _history(self, work: Transaction, source: str, new: DataFrame, keys: Sequence[str], log: Increment) -> tuple[DataFrame, DataFrame | None, Meeting]:
        """Append prepared rows; returns them as stored, the old rows of their keys (None: a new table) and which of their keys occur again."""
        name = f"raw_{source}"
        new, touched = work.append(name, new, keys, self.n)
        log.rows[source] = new.count()
        log.touched[name] = touched
        changed = new.select(*[c(k) for k in keys])
        if name not in work.base.tables:
            return new, None, Meeting(None, changed)
        every = work.base.read(name, touched)
        met = Meeting(every.select(*[c(k) for k in keys]), changed)
        return new, met.semi(every, keys).select(*new.columns), met

    def _source(self, work: Transaction, source: str, raw: DataFrame, log: Increment) -> tuple[DataFrame, DataFrame | None]:
        """Bring one cleaned table up to date; returns its fresh rows and the rows they replace."""
        spec = SPECS[source]
        new = prepare(raw, spec, self.as_of)
        if source != "prd_info":
            new, old, met = self._history(work, source, new, spec.keys, log)
            changed = new.select(*[c(k) for k in spec.keys])
            again, alone = met.split(new, spec.keys)  # a row alone under its key is its survivor and needs no window
            fresh = finish(again if old is None else old.unionByName(again), spec, self.as_of)
            fresh = fresh.unionByName(finish(alone, replace(spec, keys=()), self.as_of))
        else:
            new, old, _ = self._history(work, source, new, [_VERSION_KEY], log)
            met, keys = None, new.select(c(_VERSION_KEY))
            rows = new if old is None else old.unionByName(new)
            dated = materialize(derive_end_date(rows, "prd_key", "prd_start_dt", "prd_end_dt", tie=["prd_id"]), "validity-ends")
            self._update_versions(work, dated, keys, log)
            changed = materialize(dated.select("prd_id").distinct(), "product-ids")
            fresh = finish(self._with_versions(work, dated, keys, changed), spec, self.as_of, windows=False)
        renamed = changed.toDF(*[spec.rename.get(k, k) for k in changed.columns])
        return self._update(work, spec.target, spec.renamed_keys(), fresh, renamed, log, met)

    def _update_versions(self, work: Transaction, dated: DataFrame, keys: DataFrame, log: Increment) -> None:
        """Rows of the touched product keys lie in the buckets of their ids: history only grows, so the fresh rows name them all."""
        old = work.base.tables.get("versions")
        if old is None:
            work.replace("versions", dated, ["prd_id"], self.n)
            log.touched["versions"] = sorted(int(b) for b in work.tables["versions"]["parts"])
            return
        touched = work.base.touched("versions", dated.select("prd_id"))
        kept = same_keys(work.base.read("versions", touched), keys, "left_anti")
        work.replace("versions", dated.select(*kept.columns), ["prd_id"], self.n, touched, kept=kept)
        log.touched["versions"] = touched

    def _with_versions(self, work: Transaction, dated: DataFrame, keys: DataFrame, ids: DataFrame) -> DataFrame:
        """All product rows of the touched ids: the fresh ones and those under product keys that did not change."""
        if "versions" not in work.base.tables:
            return dated
        others = work.base.read("versions", work.base.touched("versions", ids))
        others = same_keys(same_keys(others, ids, "left_semi"), keys, "left_anti")
        return dated.unionByName(others.select(*dated.columns))

    # --- dimensions --------------------------------------------------------------------------------------------

    def _dimension(self, work: Transaction, name: str, key: str, own_id: str, base: str, lookups: Mapping[str, DataFrame | None],
                   fresh: DataFrame | None, before: DataFrame | None, build, columns: Sequence[str], log: Increment) -> None:
        """Join again the base rows under every ``key`` that a base row or a lookup changed."""
        parts = [df.select(c(key)) for df in (fresh, before, *lookups.values()) if df is not None]
        if not parts or base not in work.tables:
            return
        changed = parts[0]
        for p in parts[1:]:
            changed = changed.unionByName(p)
        changed = materialize(changed.distinct(), f"{name}-keys")
        now = Snapshot(self.spark, self.store.root, -1, work.tables, work.meta)  # what this increment has written so far
        own = [n for n in columns if n in now.schema(base).fieldNames()]
        if name in work.base.tables:
            rows = same_keys(work.base.read(name, work.base.touched(name, changed)), changed, "left_semi").select(*[c(n) for n in own])
            if fresh is not None:
                ids = fresh.select(c(own_id)) if before is None else fresh.select(c(own_id)).unionByName(before.select(c(own_id)))
                rows = same_keys(rows, ids.distinct(), "left_anti").unionByName(fresh.select(*[c(n) for n in own]))
        else:  # the first time: every base row
            rows = now.read(base).select(*[c(n) for n in own])
            changed = rows.select(c(key)).distinct()
        buckets = sorted({r[0] for r in changed.select(bucket_of([c(key)], self.n)).distinct().collect()})
        found = [now.read(t, buckets) if t in now.tables else self.spark.createDataFrame([], _renamed_schema(t)) for t in lookups]
        self._update(work, name, [key], build(rows, *found), changed, log)

    # --- an increment ------------------------------------------------------------------------------------------

    def new_files(self, source: str, sink: str, schema) -> list[str]:
        """Committed files of an intake sink that no published version contains yet (the driver lists a sink's files in any case)."""
        if not exists(self.spark, sink):
            return []
        now = self.spark.read.schema(schema).parquet(sink).inputFiles()
        snap, name = self.store.snapshot(), f"files_{source}"
        known = {r["file"] for r in snap.read(name).collect()} if name in snap.tables else set()
        return sorted(set(now) - known)

    def apply(self, raw: Mapping[str, DataFrame], files: Mapping[str, Sequence[str]] | None = None) -> Increment:
        """Add raw rows by source name and publish all tables they change.

        ``files``: the intake files that hold these rows, published with them. A
        changed ``as_of`` is refused: rows that depend on it lie in buckets that an increment would not read.
        """
        work = self.store.begin()
        log = Increment(work.base)
        stated = str(self.as_of)
        if work.base.version and work.base.meta.get("as_of") != stated:
            raise ValueError(f"The store was built as of {work.base.meta.get('as_of')}; build a new one for {stated}")
        raw = {s: df for s, df in raw.items() if not df.isEmpty()}
        pool = ThreadPoolExecutor(max_workers=max(1, self.workers))  # sources, and then dimensions, do not need each other
        for source, names in (files or {}).items():
            if names:
                work.append(f"files_{source}", self.spark.createDataFrame([(n,) for n in names], "file string"))
        with pool:
            made = {source: pool.submit(self._source, work, source, df, log) for source, df in raw.items()}
        done = {source: f.result() for source, f in made.items()}
        fresh = {SPECS[s].target: f for s, (f, _) in done.items()}
        before = {SPECS[s].target: b for s, (_, b) in done.items()}

        def both(target):
            f, b = fresh.get(target), before.get(target)
            return f if b is None else f.unionByName(b.select(*f.columns))

        info, products = SPECS["cust_info"].target, SPECS["prd_info"].target
        demo, location, category = (SPECS[s].target for s in ("cust_az12", "loc_a101", "px_cat_g1v2"))
        dims = [
            ("gold_dim_customers", "customer_key", "customer_id", info, {demo: both(demo), location: both(location)},
             fresh.get(info), before.get(info), customer_dimension, CUSTOMER_DIM_COLUMNS),
            ("gold_dim_product", "category_id", "product_id", products, {category: both(category)},
             fresh.get(products), before.get(products), product_dimension, PRODUCT_DIM_COLUMNS),
        ]
        with ThreadPoolExecutor(max_workers=max(1, min(2, self.workers))) as pool:
            for f in [pool.submit(self._dimension, work, *d, log) for d in dims]:
                f.result()
        log.snapshot = work.commit({"as_of": stated})
        return log

    def tables(self, snapshot: Snapshot | None = None) -> dict[str, DataFrame]:
        """The star tables (those that have data) of the newest or a given version."""
        snap = snapshot or self.store.snapshot()
        out = {n: snap.read(n) for n in ("gold_dim_customers", "gold_dim_product") if n in snap.tables}
        sales = SPECS["sales_details"].target
        if sales in snap.tables:
            out["gold_fact_sales"] = build_fact(snap.read(sales))
        return out


def _renamed_schema(target: str) -> str:
    """Text columns of a cleaned table that has no rows yet."""
    spec = next(s for s in SPECS.values() if s.target == target)
    kinds = {**{k: "date" for k in spec.dates}, **spec.casts}
    return ", ".join(f"`{new}` {kinds.get(old, 'string')}" for old, new in spec.rename.items())


def run_keyed_increment(star: IncrementalStar, jobs: Sequence) -> tuple[list, Increment]:
    """Take in the new files of every source at once (``streaming.intake``), then bring the star tables up to date.

    Returns the outcome of each source and what was touched. If the intake of a source failed, ``IntakeError`` is raised and
    nothing is published: the tables stay as they were, and the next run takes in the new files of all sources.
    """
    from layercake.streaming.intake import run_streams

    outcomes = run_streams(star.spark, jobs, strict=True)
    raw, files = {}, {}
    for job in jobs:
        if job.rejects:
            raise ValueError(f"{job.name}: new rows are taken from whole files, without a part for rejected lines")
        files[job.name] = star.new_files(job.name, job.sink, job.schema)
        if files[job.name]:
            raw[job.name] = star.spark.read.schema(job.schema).parquet(*files[job.name])
    return outcomes, star.apply(raw, files)
