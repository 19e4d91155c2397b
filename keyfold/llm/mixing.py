"""Mixing sources to target weights (operator 9), in DataFrame operations alone.

Each source gets a share of the whole by its weight, at most ``max_epochs`` times its own size. It is read in
whole epochs, and the rest is a weighted sample without replacement in the manner of Efraimidis and Spirakis:
a document's key is an exponential variate divided by its quality, and the smallest keys are taken until their
sizes add up to what is left.

Adding up within a source does not bring the source together. Keys fall into buckets by their value, about
``BUCKET_ROWS`` documents each; sums per bucket, of which there are few, tell which bucket the budget
ends in; only that bucket's documents are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import WHITESPACE, row_number, stored

# Weights of the sources in their order, repeating.
SOURCE_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 20_000
# Tables of one row per source are broadcast up to so many rows; beyond, they are joined by shuffle.
BROADCAST_SOURCES = 10_000
# Fixed value: 13 hexadecimal digits of a digest make a number below this.
_DIGEST_RANGE = float(16**13)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def default_quality(text: Column, words: Column) -> Column:
    """Between 0 and 1, highest at five characters a word: a plain sign of prose."""
    chars = F.length(F.translate(F.coalesce(text, F.lit("")), WHITESPACE, ""))
    return 1.0 / (1.0 + F.abs(F.coalesce(F.try_divide(chars, words), F.lit(0.0)) - 5.0))


def uniform(doc_id: Column, seed: str = "mix") -> Column:
    """A number above 0 and below 1 for each ``doc_id``, the same in every run."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + 0.5) / _DIGEST_RANGE


def sampling_rows(
    docs: DataFrame, quality: Column | None = None, seed: str = "mix", keep: Column | None = None
) -> DataFrame:
    """``doc_id, source, size, quality, key, row`` of every document, and ``kept``, what ``keep`` gives."""
    keep = F.lit(None).cast("string") if keep is None else keep
    sized = docs.select(
        "doc_id", "source", "text", keep.alias("kept"), word_count(F.col("text")).alias("size"), row_number().alias("row")
    )
    quality = default_quality(F.col("text"), F.col("size")) if quality is None else quality
    weighed = sized.withColumn("quality", quality.cast("double"))
    key = -F.log(uniform(F.col("doc_id"), seed)) / F.col("quality")
    return weighed.select("doc_id", "source", "size", "quality", key.alias("key"), "row", "kept")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``target`` for every row of ``source, source_size``; there is one row per source.

    Shares go by weight; a target stops at ``max_epochs`` times its source's size, and what is over
    is shared again by weight until nothing is. That ends where every target is the smaller of its limit
    and one common factor times its weight, and the factor follows from the sources in order of limit to weight.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    limited = Window.orderBy("limit_by_weight", F.col("source").asc_nulls_last())
    before = limited.rowsBetween(Window.unboundedPreceding, -1)
    from_here = limited.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    turns = F.array(*(F.lit(float(w)) for w in weights))
    place = F.row_number().over(in_order) - 1
    return (
        sizes.withColumn("weight", F.element_at(turns, (place % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * float(max_epochs))
        .withColumn("limit_by_weight", F.col("limit") / F.col("weight"))
        # the factor if all sources before this one are at their limits, and no other
        .withColumn(
            "factor",
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / F.sum("weight").over(from_here),
        )
        .withColumn("common", F.max(F.when(F.col("factor") <= F.col("limit_by_weight"), F.col("factor"))).over(everything))
        .withColumn(
            "target",
            F.least(F.col("limit"), F.coalesce(F.col("common") * F.col("weight"), F.col("limit"))),
        )
        .select("source", "source_size", "target")
    )


def mixed(
    rows: DataFrame, weights: tuple[float, ...] = SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``rows`` (as from :func:`sampling_rows`, stored) with ``source_size``, ``target`` and ``copies``,
    the number of times the mix takes the document.

    A null or empty text has size 0 and adds nothing; a null source is a source; a null ``doc_id`` draws like
    any other value; rows with one ``doc_id`` draw alike and are told apart by quality, then by position;
    an empty table gives no rows.
    """
    plan = _checked(selection_plan(rows, weights, max_epochs))
    return rows.join(plan, rows["source"].eqNullSafe(plan["plan_source"])).withColumn("copies", _copies(_order(), F.col("last"))).select(
        "doc_id", "size", "source_size", "target", "copies"
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[float, ...] = SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns as they are. The texts are read twice
    and never shuffled; what joins them is one row per source. Rows that repeat as a whole are taken alike."""
    plan = _checked(selection_plan(stored(sampling_rows(docs).drop("kept"), "sampling"), weights, max_epochs))
    rows = sampling_rows(docs, keep=F.struct(*docs.columns))
    last = F.struct(F.col("last.key").alias("key"), F.col("last.tie").alias("tie"))
    taken = rows.join(plan, rows["source"].eqNullSafe(plan["plan_source"])).withColumn(
        "copies", _copies(F.struct("key", _tie().alias("tie")), last)
    )
    return taken.filter("copies > 0").select("kept", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("kept.*")


def _tie() -> Column:
    return F.coalesce(F.xxhash64("doc_id"), F.lit(0))


def _order() -> Column:
    """The order in which a source's documents are taken."""
    return F.struct("key", _tie().alias("tie"), "row")


def _copies(own: Column, last: Column) -> Column:
    """Whole epochs, and one more for documents up to the last that the rest of the budget takes."""
    return (F.col("epochs") + F.coalesce(own <= last, F.lit(False)).cast("bigint")).cast("bigint")


def selection_plan(
    rows: DataFrame, weights: tuple[float, ...] = SOURCE_WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: ``plan_source, source_size, target, epochs, last``; ``last`` is the order of
    the last document the fractional epoch takes, null when it takes none."""
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"), F.avg("quality").alias("mean")
    )
    targets = source_targets(sizes.select("source", "source_size"), weights, max_epochs)
    counts = sizes.select(F.col("source").alias("plan_source"), "rows", "mean")
    per_source = stored(
        targets.join(counts, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("epochs", F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("buckets", F.ceil(F.col("rows") / BUCKET_ROWS))
        .select("plan_source", "source_size", "target", "epochs", "budget", "buckets", "mean"),
        "sources",
    )
    # keys are near exponential, so this value spreads over 0 to 1
    spread = 1.0 - F.exp(-F.col("key") * F.col("mean"))
    sources = _checked(per_source)
    bucketed = rows.join(sources, rows["source"].eqNullSafe(sources["plan_source"])).select(
        "plan_source",
        "budget",
        "size",
        _order().alias("order"),
        F.least(F.floor(spread * F.col("buckets")), F.col("buckets") - 1).alias("bucket"),
    )
    # the last bucket that begins within the budget: those before it are taken whole
    upto = Window.partitionBy("plan_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        bucketed.groupBy("plan_source", "budget", "bucket")
        .agg(F.sum("size").alias("bucket_size"), F.max("order").alias("bucket_last"))
        .select(
            F.col("plan_source").alias("end_source"),
            "budget",
            F.col("bucket").alias("end_bucket"),
            F.coalesce(F.sum("bucket_size").over(upto), F.lit(0)).alias("before"),
            F.max("bucket_last").over(upto).alias("before_last"),
        )
        .filter("budget > 0 AND before <= budget")
        .groupBy("end_source")
        .agg(F.max_by(F.struct("end_bucket", "before", "before_last"), "end_bucket").alias("end"))
        .select("end_source", "end.*")
    )
    # inside it, a document that lies across the end of the budget is taken if half of it fits
    running = Window.partitionBy("plan_source").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    inside = bucketed.join(
        ends, F.col("plan_source").eqNullSafe(F.col("end_source")) & (F.col("bucket") == F.col("end_bucket"))
    ).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0)))
    last = inside.groupBy("end_source").agg(
        F.max(F.when(F.col("ahead") + F.col("size") / 2.0 <= F.col("budget"), F.col("order"))).alias("inside_last"),
        F.max("before_last").alias("before_last"),
    )
    plan = per_source.join(last, F.col("plan_source").eqNullSafe(F.col("end_source")), "left").select(
        "plan_source", "source_size", "target", "epochs", F.coalesce("inside_last", "before_last").alias("last")
    )
    return stored(plan, "plan")


def _checked(sources: DataFrame) -> DataFrame:
    """A stored table of one row per source, for a join with all documents."""
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
