"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of `block` words. Slot n has the van der Corput point of n (the bits of n mirrored), and the
source whose stretch of the cumulative weights holds that point. Mirroring bits undoes itself, so the slots are made the
other way round: every source lists the points of its stretch and mirrors them, which needs no range join and gives each
source exactly the slots that it is owed, spread evenly over the whole mix. Slots are ranked per source; the r-th one
takes the r-th block of equally many words of the source's documents in shuffled order, starting over when all are taken.

Ranks and word offsets are sums over ranges: counts per range, a running sum over the ranges of a source, and a window
inside each range. No window holds a whole source, so a source with a third of all rows is no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import WORD, materialized, row_key, whole_text

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
CAP = 3  # a source is taken at most so many times over
BLOCK = 64  # words in a slot
RANGE_BITS = 12  # slots are ranked in ranges of 4096
CHUNK = 1 << 16  # points of a source that one row unfolds into
TASK = 1 << 20  # slots that one task unfolds


def before(*order: str | Column, by: tuple = ()) -> Window:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target, want, src: the share of all words that each source gets.

    `sizes` has source and size. Filling up by weight stops at `cap` times the source's size; what is left goes to the
    others by weight. In ascending order of size by weight, the sources that are full come first, so the level at which
    the others stand follows from running sums: no loop. The windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")).cast("long")
    fullness = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    ranked = per_source.withColumn("src", rank.cast("int")).withColumn("weight", weight)
    running = ranked.select(
        "*",
        (cap * F.coalesce(F.sum("source_size").over(fullness.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("full"),
        F.sum("weight").over(fullness.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
        F.row_number().over(fullness).alias("place"),
    ).withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    first_open = F.when(cap * F.col("source_size") > F.col("level") * F.col("weight"), F.struct("place", "level"))
    level = F.min(first_open).over(Window.partitionBy())["level"]
    cap_size = (cap * F.col("source_size")).cast("double")
    target = F.least(cap_size, F.coalesce(level * F.col("weight"), cap_size))
    return running.withColumn("target", target).select(
        "source", "src", "source_size", "target", F.floor(F.col("target") + 0.5).cast("long").alias("want")
    )


def points_of(targets: DataFrame, block: int) -> DataFrame:
    """src, bits, point: the points that sources own, unfolded in tasks of about `TASK`."""
    words = targets.agg(F.sum("want")).first()[0] or 0
    partitions = max(targets.sparkSession.sparkContext.defaultParallelism, -(-words // (block * TASK)))
    first = F.coalesce(F.sum("n").over(before("src")), F.lit(0))
    owed = targets.select("src", F.ceil(F.col("want") / block).cast("long").alias("n"))
    owed = owed.withColumn("first", first).withColumn("bits", F.ceil(F.log2(F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(2)))))
    chunks = owed.where("n > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    last = F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1
    # A number of partitions of its own: by their bytes, these few rows would all be put together before they unfold.
    return chunks.repartition(partitions, "src", "chunk").select(
        "src", "bits", F.explode(F.sequence(F.col("first") + F.col("chunk") * CHUNK, F.col("first") + last)).alias("point")
    )


def slots(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, src, rank: who takes which place of the mix. One row per slot."""
    points = points_of(targets, block)
    mirrored = F.conv(F.reverse(F.lpad(F.bin("point"), F.col("bits").cast("int"), "0")), 2, 10).cast("long")
    placed = points.select("src", mirrored.alias("slot")).withColumn("range", F.shiftright("slot", RANGE_BITS))
    ranges = placed.groupBy("src", "range").agg(F.count("*").alias("n"))
    ranges = ranges.select("src", "range", F.coalesce(F.sum("n").over(before("range", by=("src",))), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("src", "range").orderBy("slot")) - 1
    # Sizes are estimated from the few sources that the slots unfold from: without the hints, joins would broadcast the mix.
    return placed.withColumn("inside", inside).join(ranges.hint("merge"), ["src", "range"]).select(
        "slot", "src", (F.col("start") + F.col("inside")).alias("rank")
    )


def mix_sources(
    df: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
    weights=WEIGHTS,
    cap: int = CAP,
    block: int = BLOCK,
    key: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(plan, totals) of the mix of all rows of `df`.

    plan: slot, id, first_word, words — the stretch of a document that a slot of the mix takes; slots in ascending order
    are the mix. totals: one row per row of `df` with doc_id, size, source_size, target, taken (words, repeats counted), key.

    A null text has no words and is never taken; a null source is a source, the last. Repeated rows are documents of their
    own. Ids may be null or repeated: they only order the documents. An empty table, or one without words, has an empty
    plan. Columns besides the three named are not read, but for what `key` reads: the name of a row in totals, by default
    made of id and text. The order of documents is that of the md5 of their ids, so reruns agree.
    """
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    key = row_key(id_col, whole_text(text)) if key is None else key
    sizes = df.select(F.col(id_col).alias("id"), F.col(source).alias("source"), words.alias("size"), key.alias("key"))
    sizes = materialized(sizes, "mix-sizes")
    targets = materialized(source_targets(sizes, weights, cap).coalesce(1), "mix-targets")
    order = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    known = sizes.withColumn("order", order).withColumn("range", F.substring("order", 1, 2))
    known = known.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(sizes["source"])
    ranges = known.groupBy("src", "range").agg(F.sum("size").alias("n"))
    ranges = ranges.select("src", "range", F.coalesce(F.sum("n").over(before("range", by=("src",))), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum("size").over(before("order", "id", "size", by=("src", "range"))), F.lit(0))
    placed = known.withColumn("inside", inside).join(ranges, ["src", "range"])
    docs = materialized(
        placed.select("id", "key", "src", "size", "source_size", "target", "want", (F.col("start") + F.col("inside")).alias("offset")),
        "mix-offsets",
    )

    # A document's stretch in each pass over its source, cut where blocks begin.
    passes = docs.where("size > 0 AND want > offset").withColumn(
        "lap", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("want") - 1 - F.col("offset")) / F.col("source_size"))))
    )
    start = F.col("offset") + F.col("lap") * F.col("source_size")
    stretches = passes.select("id", "src", "offset", start.alias("start"), F.least(start + F.col("size"), "want").alias("end"))
    pieces = stretches.withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    begin = F.greatest("start", F.col("rank") * block)
    stop = F.least("end", (F.col("rank") + 1) * block)
    pieces = pieces.select("id", "src", "offset", "rank", (begin - F.col("start")).alias("first_word"), (stop - begin).alias("words"))
    taken = slots(targets, block).hint("merge").join(pieces, ["src", "rank"])
    plan = taken.select("slot", "id", "first_word", "words")
    # Documents with words have offsets of their own; the others take nothing.
    sums = taken.groupBy("src", "offset").agg(F.sum("words").alias("taken"))
    totals = docs.join(sums, ["src", "offset"], "left").select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"),
        "key",
    )
    return plan, totals


def mixed_documents(df: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The rows of `df`, each as often as the mix takes it: all columns of `df`, whole documents.

    The mix takes the documents of a source in turn, so all but the last one it comes to are taken a whole number of times;
    that one is rounded. A document without words, or with a null text, has no part in the weights and stays as it is. A
    null source is a source. Rows are told apart by all their columns, so rows with one id and text but different sources
    stay what they are; rows that are equal in every column come as often as all of them together. An empty table stays empty.
    """
    # The length of each value stands before it, so that no two rows give one text; null has none.
    values = [F.col(c) if df.schema[c].dataType.typeName() == "string" else F.to_json(F.struct(c)) for c in df.columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    key = F.sha2(F.concat(*parts), 256)
    _, totals = mix_sources(df, text, id_col, source, key=key, **options)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5)).otherwise(1).cast("int")
    counts = totals.groupBy(F.col("key").alias("__key")).agg(F.sum(times).cast("int").alias("__times")).where("__times > 0")
    rows = df.withColumn("__key", key).join(counts, "__key").dropDuplicates(["__key"])
    return rows.withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*df.columns)
