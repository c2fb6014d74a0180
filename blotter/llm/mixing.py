"""Mixing sources to target weights with a time-varying curriculum.

Every source has a weight schedule over training time 0..1, given as pieces on
which the weight runs linearly from ``w0`` to ``w1``. A source's share of the
token budget is the integral of its schedule; a source never gets more than
``max_epochs`` times its own tokens, and what it cannot use goes to the others
by weight. The documents of a source stand in a fixed pseudo-random order,
epoch after epoch. The token offset at which a copy starts, as a share of the
source's target, is a cumulative demand; inverting the integral of the schedule
at that demand gives the copy's training position, and sorting all copies by
position gives the training order.

Only DataFrame expressions are used. A source may hold any share of the rows:
its running totals are taken in blocks of about ``rows_per_block`` rows, whose
own totals are added up per source.

Defined cases: a null text has 0 words; a null source is a source of its own,
after all others; empty documents take 0 words; repeated rows count as separate
documents, in either order; an empty table gives an empty result; further
columns of the documents, whatever their names, are carried untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import block_of, blocks_for, unit_hash, word_count

BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
WEIGHT_CYCLE = (5, 2, 1)
#: share of the weight by which a linear schedule starts above (and ends below) its mean
SLOPE_CYCLE = (0.5, 0.0, -0.5)
ROWS_PER_BLOCK = 10_000


def _source_key(source: Column) -> Column:
    """Injective text key that is never null; null sorts after every name."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def cycled_schedules(sources: DataFrame, weights=WEIGHT_CYCLE, slopes=SLOPE_CYCLE) -> DataFrame:
    """One linear schedule piece per source: weights repeat along the sorted sources.

    The sort of the source names runs in one task: it has one row per source.
    """
    n = F.row_number().over(Window.orderBy("skey")) - 1
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]),
                                       (F.col("_n") % len(values) + 1).cast("int"))
    piece = F.struct(F.lit(0.0).alias("t0"), F.lit(1.0).alias("t1"),
                     (F.col("_w") * (1 + F.col("_a"))).alias("w0"),
                     (F.col("_w") * (1 - F.col("_a"))).alias("w1"))
    return (sources.select("skey").withColumn("_n", n)
            .withColumns({"_w": pick(weights), "_a": pick(slopes)})
            .select("skey", F.array(piece).alias("pieces")))


def integrate(schedules: DataFrame) -> DataFrame:
    """Adds to every piece the integral up to its start (``c0``) and end (``c1``), and
    ``weight``, the integral over all pieces."""
    area = lambda p: (p["t1"] - p["t0"]) * (p["w0"] + p["w1"]) / 2
    upto = lambda i: F.aggregate(F.slice("pieces", 1, i), F.lit(0.0),
                                 lambda acc, p: acc + area(p))
    cumulated = F.transform("pieces", lambda p, i: F.struct(
        p["t0"].alias("t0"), p["t1"].alias("t1"), p["w0"].alias("w0"), p["w1"].alias("w1"),
        upto(i).alias("c0"), (upto(i) + area(p)).alias("c1")))
    return schedules.select("skey", cumulated.alias("pieces"),
                            F.aggregate("pieces", F.lit(0.0), lambda acc, p: acc + area(p))
                            .alias("weight"))


def invert(pieces: Column, demand: Column) -> Column:
    """Time at which the integral of the schedule reaches ``demand`` (1.0 beyond its end)."""
    p = F.get(F.filter(pieces, lambda q: demand < q["c1"]), F.lit(0))
    span = p["t1"] - p["t0"]
    y = F.try_divide(demand - p["c0"], span)
    root = F.sqrt(p["w0"] * p["w0"] + 2 * (p["w1"] - p["w0"]) * y)
    return F.when(p.isNull(), F.lit(1.0)).otherwise(
        p["t0"] + span * F.when(y > 0, F.try_divide(2 * y, p["w0"] + root)).otherwise(F.lit(0.0)))


def targets(sources: DataFrame, budget_share: float = BUDGET_SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``target`` of each source (columns skey, weight, source_size are read).

    Shares of ``budget_share`` x all tokens by weight, held at ``max_epochs`` x the
    source's tokens, the rest reshared by weight until no source is above. In the order
    of capacity per weight the held sources come first, so one running sum finds the
    common rate. One row per source: the windows run in one task.
    """
    everyone = Window.partitionBy()
    ratio = Window.orderBy(F.try_divide(F.col("_cap"), F.col("weight")).asc_nulls_last(), "skey")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = (sources.withColumn("_cap", F.col("source_size").cast("double") * max_epochs)
         .withColumn("_all", F.sum("source_size").over(everyone).cast("double") * budget_share)
         .withColumns({"_capped": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
                       "_open": F.sum("weight").over(everyone)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
         .withColumn("_rate", F.try_divide(F.col("_all") - F.col("_capped"), F.col("_open"))))
    # the first source whose own capacity is not reached sets the rate of all after it
    rate = F.min(F.when(F.col("_rate") * F.col("weight") <= F.col("_cap"), F.struct(
        F.col("_capped"), F.col("_rate")))).over(everyone)["_rate"]
    return (s.withColumn("_r", rate)
            .withColumn("target", F.when(F.col("_r").isNull(), F.col("_cap"))
                        .otherwise(F.least(F.col("_cap"), F.col("_r") * F.col("weight"))))
            .drop("_cap", "_all", "_capped", "_open", "_rate", "_r"))


def plan_mix(docs: DataFrame, schedules=cycled_schedules, budget_share: float = BUDGET_SHARE,
             max_epochs: int = MAX_EPOCHS, rows_per_block: int = ROWS_PER_BLOCK,
             carry: list[str] | None = None, whole: bool = False) -> DataFrame:
    """One row per document: ``doc`` (its columns, or those named in ``carry``, as a struct), ``size``,
    ``source_size``, ``target`` and ``copies``, an array of
    (epoch, take, position) of the copies that the mix takes.

    ``whole=False`` cuts the copy at which a source's demand ends, so that the words
    taken equal the target; ``whole=True`` takes that copy if at least half of it is
    within the demand. ``schedules`` maps a frame of ``skey`` to (skey, pieces).
    """
    blocks = blocks_for(docs.count(), rows_per_block)
    doc = F.struct(*[F.col(f"row.`{c}`") for c in carry or docs.columns]).alias("doc")
    d = docs.select(F.struct("*").alias("row")).select(
        doc, _source_key(F.col("row.source")).alias("skey"), F.col("row.doc_id").alias("id"),
        word_count(F.col("row.text")).alias("size"), F.xxhash64("row.text").alias("text_hash"),
        F.coalesce(unit_hash(F.col("row.doc_id")), F.lit(0)).alias("h"))
    d = d.withColumn("block", block_of(F.col("h"), blocks))

    per_block = d.groupBy("skey", "block").agg(F.sum("size").alias("block_size"))
    sources = per_block.groupBy("skey").agg(F.sum("block_size").alias("source_size"))
    plan = targets(sources.join(integrate(schedules(sources)), "skey"), budget_share, max_epochs)
    in_source = Window.partitionBy("skey").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = (per_block.withColumn("base", F.coalesce(F.sum("block_size").over(in_source), F.lit(0)))
             .join(plan, "skey").drop("block_size"))

    in_block = Window.partitionBy("skey", "block").orderBy("h", "id", "size", "text_hash").rowsBetween(
        Window.unboundedPreceding, -1)
    at = d.join(bases, ["skey", "block"]).withColumn(
        "offset", F.col("base") + F.coalesce(F.sum("size").over(in_block), F.lit(0)))

    def copy(epoch):
        start = F.col("offset") + epoch * F.col("source_size")
        left = F.floor(F.col("target")) - start
        if whole:
            take = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        else:
            take = F.greatest(F.least(left, F.col("size")), F.lit(0))
        demand = F.try_divide(start, F.col("target")) * F.col("weight")
        return F.struct(epoch.alias("epoch"), take.cast("long").alias("take"),
                        invert(F.col("pieces"), demand).alias("position"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(int(max_epochs) - 1)), copy),
                      lambda c: c["take"] > 0)
    return at.select("doc", "size", "source_size", "target", copies.alias("copies"))


def training_order(planned: DataFrame) -> DataFrame:
    """The mixed corpus: one row (the document's own columns) per whole copy, sorted by
    training position over all partitions."""
    return (planned.select("doc", F.explode("copies").alias("c"))
            .orderBy(F.col("c.position"), F.col("doc.doc_id"), F.col("c.epoch"))
            .select("doc.*"))


def document_mix(planned: DataFrame) -> DataFrame:
    """One row per document with the words taken and the first training position,
    in training order (documents the mix does not take come last)."""
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda acc, c: acc + c["take"])
    return planned.select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target",
        taken.alias("taken"),
        F.round(F.get("copies", F.lit(0))["position"], 9).alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")
