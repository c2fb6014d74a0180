"""Batch refresh: bronze -> silver -> gold fact -> marts, written as Parquet.

Each layer is written once and later steps read the *written* table, which
cuts lineage (a lost executor recomputes from the last written layer, not from
the raw landing files) and lets dashboards read a year-partitioned fact whose
date filters prune partitions.

``layers(spark, sf_dir, step)`` is the query catalogue's entry: for one input folder
it runs a step of the batch (bronze, the fact, a mart, silver, landing files, area
dimension) and those that it reads, under the shared folder named by
``spark.checkpoint.dir``, and again whenever the input files have changed.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import clean, marts, model, quality
from ..session import SETTINGS, app_id, rebalanced, released, shared_dir, sliced, slices_of
from ..sources import adapter, files, geojson, landing, schemas, snapshots
from ..sources.snapshots import Snapshot, Transaction
from . import upsert

FACT_PARTITIONS = ["year"]
DIM_AREA = "dim_area_geo"


#: lines of a landing file at most
LANDED_LINES = 250_000

BRONZE, SILVER, FACT = "bronze/crime", "silver/crime", "gold/fact_crime_incidents"


@dataclass(frozen=True)
class Layers:
    """The tables under a root, as of the newest commit; or, once ``pinned``, of one commit
    whatever is written later."""

    root: str
    snapshot: Snapshot | None = None

    def pinned(self, spark: SparkSession) -> Layers:
        return Layers(self.root, snapshots.newest(spark, self.root))

    def now(self, spark: SparkSession) -> Snapshot:
        return self.snapshot or snapshots.newest(spark, self.root)

    def read(self, spark: SparkSession, table: str, schema=None) -> DataFrame:
        return self.now(spark).read(spark, table, schema)

    def fact(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, FACT, schemas.GOLD)

    def dim_area_geo(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, f"gold/{DIM_AREA}", schemas.DIM_AREA_GEO)

    def mart_daily_area(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "gold/mart_crime_daily_area")

    def mart(self, spark: SparkSession, name: str) -> DataFrame:
        """A mart written by ``refresh`` (one of ``marts.MARTS``)."""
        if name not in marts.MARTS:
            raise KeyError(f"unknown mart {name!r}; one of {sorted(marts.MARTS)}")
        return self.read(spark, f"gold/{name}")

    def bronze(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, BRONZE, schemas.BRONZE)

    def silver(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, SILVER, schemas.SILVER)

    @property
    def landing_dir(self) -> str:
        return f"{self.root}/landing/crime"

    @property
    def landing_index(self) -> str:
        return f"{self.root}/landing/crime_index"

    @property
    def areas_dir(self) -> str:
        return f"{self.root}/landing/areas"


def write_fact(t: Transaction, *slices: DataFrame) -> dict[str, int]:
    """Gold fact, partitioned by year and date-ordered inside each file.

    The ``rebalance`` hint lets AQE cut each year into files of the advisory size
    (splitting a hot year across tasks, merging small ones) instead of every
    post-dedup task writing one small file per year: at scale that is millions of
    small files less for every dashboard query to list and open. The fact may come in slices
    that share no id. Returns the quality counts, taken as the rows are written.
    """
    observed = [quality.observed_fact(rebalanced(s, *FACT_PARTITIONS)) for s in slices]
    t.write_each([out for out, _ in observed], FACT, partition_by=FACT_PARTITIONS, sort_within=["occurrence_date"])
    counts = [seen.get for _, seen in observed]
    return {k: sum(c[k] for c in counts) for k in counts[0]}


def gold_slices(bronze: DataFrame, size: int) -> list[DataFrame]:
    """The de-duplicated fact of a bronze table of so many bytes, in slices of ids."""
    return [model.gold(clean.silver(b)) for b in sliced(bronze, slices_of(size), F.xxhash64(C.norm_text("dr_no")))]


class CheckFailed(RuntimeError):
    """The written fact breaks a rule of the refresh."""


def check_fact(fact: DataFrame) -> dict[str, int]:
    """The fact's quality checks in full: ids are unique; null and coordinate counts are
    reported. One pass for the counts, one for the ids."""
    counts = {**quality.gold_counts(fact).first().asDict(),
              **{f"null_{k}": v for k, v in quality.null_profile(fact).first().asDict().items()},
              **quality.geo_coverage(fact).first().asDict()}
    ids = counts["distinct_dr_no"] + (counts["null_dr_no"] > 0)
    if counts["rows"] != ids:
        raise CheckFailed(f"{counts['rows']} rows hold {ids} ids")
    return counts


def _write_silver(t: Transaction, bronze: DataFrame) -> dict[str, int]:
    """The silver table; returns its quality counts, taken as the rows are written."""
    typed, seen = quality.observed_silver(clean.typed(bronze))
    t.write(clean.silver_from_typed(typed), SILVER)
    return seen.get


def _checked_fact(t: Transaction, *slices: DataFrame, checks: bool = True) -> dict[str, int]:
    """Writes the fact; where the counts taken on the way leave it open, its ids are counted in full."""
    counts = write_fact(t, *slices)
    if checks and quality.sketch_doubts(counts):
        with released(t.spark):
            t.notes["checks"] = check_fact(t.read(FACT, schemas.GOLD))
    return counts


def write_dim_area(t: Transaction, areas: str | list[str], multi_line: bool = True) -> None:
    """The area dimension from GeoJSON files."""
    feats = geojson.read_area_features(t.spark, areas, multi_line)
    t.write(geojson.dim_area_geo(feats), f"gold/{DIM_AREA}")


def refresh(spark: SparkSession, bronze: DataFrame, root: str, write_bronze: bool = True,
            areas: str | list[str] | None = None, checks: bool = True, grace: float = snapshots.GRACE,
            areas_multi_line: bool = True) -> Layers:
    """The full batch: every layer, all five marts and, given polygon files, the area
    dimension are written under ``root`` and committed together once the fact has passed its
    checks. Readers see the tables of the commit before until then, and if a step fails."""
    with Transaction(spark, root) as t:
        if write_bronze:
            t.write(bronze, BRONZE, evolve=True)
            bronze = t.read(BRONZE, schemas.BRONZE)
        t.notes.update(silver=_write_silver(t, bronze))
        t.notes.update(fact=_checked_fact(t, model.gold(t.read(SILVER, schemas.SILVER)), checks=checks))
        fact = t.read(FACT, schemas.GOLD)
        for name, build in marts.MARTS.items():
            t.write(build(fact), f"gold/{name}")
        if areas is not None:
            write_dim_area(t, areas, areas_multi_line)
    snapshots.vacuum(spark, root, grace=grace)
    return Layers(root.rstrip("/"))


# (application, input folder) -> (state of the input files, steps of ``STEPS`` that are done)
_BUILT: dict[tuple[str, str], tuple[str, set[str]]] = {}
_LOCK = threading.Lock()


def _source_state(spark: SparkSession, sf_dir: str) -> str:
    return files.state(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in adapter.TABLES])


def layers_root(spark: SparkSession, sf_dir: str) -> str:
    tag = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    return f"{shared_dir(spark)}/blotter-layers/{app_id(spark)}/{tag}"


def layers(spark: SparkSession, sf_dir: str, step: str = "refresh") -> Layers:
    """The layers of the star-schema folder ``sf_dir`` as far as ``step`` (one of ``STEPS``) and
    the steps that it reads; each is run when first asked for and again after the folder's
    files have changed."""
    key, state = (app_id(spark), sf_dir.rstrip("/")), _source_state(spark, sf_dir)
    out = Layers(layers_root(spark, sf_dir))
    with _LOCK:
        if _BUILT.get(key, ("",))[0] != state:
            _BUILT[key] = state, set()
        _build(spark, sf_dir, out, step, _BUILT[key][1])
    return out


def _build(spark: SparkSession, sf_dir: str, out: Layers, step: str, done: set[str]) -> None:
    before, run = STEPS[step]
    for other in before:
        _build(spark, sf_dir, out, other, done)
    if step not in done:
        run(spark, sf_dir, out)
        done.add(step)


def remember(spark: SparkSession, sf_dir: str, out: Layers) -> None:
    """Record that the layers of ``sf_dir`` are already built whole (e.g. by a timed build)."""
    if out.root != layers_root(spark, sf_dir):
        raise ValueError(f"{out.root} is not the folder of the layers of {sf_dir}")
    with _LOCK:
        _BUILT[(app_id(spark), sf_dir.rstrip("/"))] = _source_state(spark, sf_dir), set(STEPS)


def build_core(spark: SparkSession, sf_dir: str, root: str) -> Layers:
    """Bronze, the gold fact and the daily mart: the shortest way to a dashboard."""
    with Transaction(spark, root) as t:
        t.write(adapter.bronze_from_star(spark, sf_dir), BRONZE)
        write_fact(t, model.gold(clean.silver(t.read(BRONZE, schemas.BRONZE))))
        t.write(marts.mart_daily_area(t.read(FACT, schemas.GOLD)), "gold/mart_crime_daily_area")
    snapshots.vacuum(spark, root, grace=0)
    return Layers(root)


def _bronze_step(spark: SparkSession, sf_dir: str, out: Layers) -> None:
    with Transaction(spark, out.root) as t:
        t.write_each(adapter.bronze_slices(spark, sf_dir), BRONZE)


def _fact_step(spark: SparkSession, sf_dir: str, out: Layers) -> None:
    """The fact and its checks, from bronze through silver's and gold's projections in one pass."""
    with Transaction(spark, out.root) as t:
        size = files.size(spark, out.now(spark).paths(BRONZE))
        t.notes.update(fact=_checked_fact(t, *gold_slices(t.read(BRONZE, schemas.BRONZE), size)))
    snapshots.vacuum(spark, out.root, grace=0)


def _mart_step(name: str):
    def run(spark: SparkSession, sf_dir: str, out: Layers) -> None:
        with Transaction(spark, out.root) as t:
            t.write(marts.MARTS[name](t.read(FACT, schemas.GOLD)), f"gold/{name}")
    return run


def _silver_step(spark: SparkSession, sf_dir: str, out: Layers) -> None:
    with Transaction(spark, out.root) as t:
        t.notes.update(silver=_write_silver(t, t.read(BRONZE, schemas.BRONZE)))


def _landing_step(spark: SparkSession, sf_dir: str, out: Layers) -> None:
    landing_files(spark, out)


def _areas_step(spark: SparkSession, sf_dir: str, out: Layers) -> None:
    area_files(spark, out)
    with Transaction(spark, out.root) as t:
        write_dim_area(t, out.areas_dir, multi_line=False)


#: steps of the whole batch in their order -> the steps that each reads, and its work
STEPS = {
    "bronze": ((), _bronze_step),                # raw records derived from the star schema
    "fact": (("bronze",), _fact_step),           # the de-duplicated fact and its checks
    **{name: (("fact",), _mart_step(name)) for name in marts.MARTS},
    "silver": (("bronze",), _silver_step),       # the silver table and its quality counts
    "refresh": (("silver", *marts.MARTS), lambda spark, sf_dir, out: None),  # every layer and mart
    "landing": (("bronze",), _landing_step),     # raw landing files and their skip index
    "areas": (("fact",), _areas_step),           # polygon files and the area dimension
}


def build_layers(spark: SparkSession, sf_dir: str, root: str) -> Layers:
    """The whole batch for one input folder: every layer and mart, raw landing files and
    polygon files derived from the star schema, the area dimension."""
    out, done = Layers(root), set()
    for step in STEPS:
        _build(spark, sf_dir, out, step, done)
    return out


# (application, input folder) -> (state of the input files, snapshot)
_UPSERTED: dict[tuple[str, str], tuple[str, Snapshot]] = {}


def upserted(spark: SparkSession, sf_dir: str) -> Snapshot:
    """The fact and marts after the bronze layer and the batches that follow it have been
    merged one by one; built when first asked for, and again after the inputs have changed."""
    built = layers(spark, sf_dir, "bronze")
    bronze, slices = built.bronze(spark), slices_of(files.size(spark, built.now(spark).paths(BRONZE)))
    key, state = (app_id(spark), sf_dir.rstrip("/")), _source_state(spark, sf_dir)
    with _LOCK:
        if _UPSERTED.get(key, ("",))[0] != state:
            root = f"{layers_root(spark, sf_dir)}-batches/{uuid.uuid4().hex}"
            batches = [bronze, *adapter.later_batches(bronze)]
            for i, batch in enumerate(batches, 1):
                # the marts are read after the last batch only; each batch counts in their state
                done = upsert.apply_batch(spark, batch, root, buckets=16, write_marts=i == len(batches), slices=slices)
                snapshots.vacuum(spark, root, keep=1, grace=0)  # no one reads the commits between
            _UPSERTED[key] = state, done
        return _UPSERTED[key][1]


def landing_files(spark: SparkSession, out: Layers) -> str:
    """Raw JSON page files of all layouts, derived from the bronze layer, and their skip index."""
    mode, size = "overwrite", files.size(spark, out.now(spark).paths(BRONZE))
    for texts, file_each in adapter.landing_files(out.bronze(spark), size):
        w = texts.write.mode(mode).option("compression", "gzip")
        with released(spark):  # a task reads a whole file: none of too many lines
            w.option("maxRecordsPerFile", 1 if file_each else LANDED_LINES).text(out.landing_dir)
        mode = "append"
    landing.update_index(spark, out.landing_dir, out.landing_index)
    return out.landing_dir


def area_files(spark: SparkSession, out: Layers) -> str:
    """GeoJSON collections (one per line) derived from the fact."""
    adapter.area_collections(out.fact(spark)).write.mode("overwrite").text(out.areas_dir)
    return out.areas_dir


def main(argv: list[str] | None = None) -> int:
    """``python -m blotter.plans.refresh --landing DIR --root DIR [--year-from Y]``."""
    import argparse

    ap = argparse.ArgumentParser(description="bronze -> silver -> gold -> marts refresh")
    ap.add_argument("--landing", required=True, help="folder of raw JSON record files")
    ap.add_argument("--root", required=True, help="lake root (shared storage)")
    ap.add_argument("--areas", default=None, help="folder of GeoJSON polygon files")
    ap.add_argument("--year-from", type=int, default=None, help="source-side lower bound")
    ap.add_argument("--run-ts", default=None, help="lineage timestamp (default: now)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("blotter-refresh").config(map=SETTINGS).getOrCreate()
    bronze = landing.ingest(spark, args.landing, year_from=args.year_from, run_ts=args.run_ts)
    refresh(spark, bronze, args.root, areas=args.areas)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
