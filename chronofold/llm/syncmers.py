"""Document fingerprints from closed syncmers, in DataFrame functions only.

A run of K characters is a closed syncmer if the smallest hash of its runs of S characters is that of the first or the last.
The choice depends on the K characters alone, so a text that is put together from others has their anchors, at moved
positions, and those across the seam: the edited text's are taken from the two documents, not searched again.
A fingerprint holds the smallest hashes of a text's anchors; the likeness of two estimates the share of anchors in common.

The next document is looked up among neighbours in id ranges; the first document of each range also goes to the range
before, so a text is shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.common import materialized, whole_text

S, SPAN = 5, 16  # length of inner runs; inner runs of a syncmer
K = S + SPAN - 1
SIZE = 64  # hashes in a fingerprint
RANGE = 256  # ids in a range
LOW_BITS = 0xFFFFFFFF


def characters(text: Column) -> Column:
    """The code points of a text; an empty pattern splits in linear time, which a search for runs does not."""
    return F.split(text, "")


def beside(array: Column, other: Column, by: int, join: Callable[..., Column]) -> Column:
    """Each entry joined with that of the other array `by` places on, or with a null behind its end."""
    later = F.slice(other, F.lit(by + 1), F.greatest(F.size(other) - by, F.lit(0)))
    return F.zip_with(array, later, lambda a, b: join(a, b))


def with_inner_hashes(df: DataFrame, text: str, name: str) -> DataFrame:
    """`name`: the hashes of all runs of S = 5 code points, in order: of pairs, of pairs of pairs, then with the fifth.

    Each step is a column of its own that the next one names more than once, so it is computed once a row.
    """
    steps = df.withColumn("__chars", characters(F.col(text)))
    steps = steps.withColumn("__two", beside(F.col("__chars"), F.col("__chars"), 1, F.xxhash64))
    steps = steps.withColumn("__four", beside(F.col("__two"), F.col("__two"), 2, F.xxhash64))
    five = beside(F.col("__four"), F.col("__chars"), S - 1, F.xxhash64)
    whole = F.slice(five, F.lit(1), F.greatest(F.size("__chars") - S + 1, F.lit(0)))
    return steps.withColumn(name, whole).drop("__chars", "__two", "__four")


def with_anchor_places(df: DataFrame, inner: str, name: str) -> DataFrame:
    """`name`: 0-based places of closed syncmers among inner hashes.

    The smallest of SPAN entries in a row comes by doubling: of 2, 4, 8 and so on; SPAN is a power of two.
    """
    steps, minima, width = df, inner, 1
    while width < SPAN:
        steps = steps.withColumn(f"__least{2 * width}", beside(F.col(minima), F.col(minima), width, F.least))
        minima, width = f"__least{2 * width}", 2 * width
    edges = beside(F.col(inner), F.col(inner), SPAN - 1, F.least)
    steps = steps.withColumn("__closed", F.zip_with(edges, F.col(minima), lambda e, m: e == m))
    places = F.filter(F.sequence(F.lit(0), F.size("__closed") - SPAN), lambda i: F.get("__closed", i))
    places = F.when(F.size("__closed") >= SPAN, places).otherwise(F.array().cast("array<int>"))
    return steps.withColumn(name, places).select(*df.columns, name)


def anchor_hashes(inner: Column, places: Column) -> Column:
    """One hash of K characters for each place."""
    return F.transform(places, lambda i: F.xxhash64(*(F.get(inner, i + at) for at in range(0, SPAN, S))).bitwiseAND(LOW_BITS))


def sketch(hashes: Column, text: Column) -> Column:
    """The smallest hashes; a text without anchors has the hash of itself."""
    some = F.slice(F.sort_array(F.array_distinct(hashes)), 1, SIZE)
    return F.when(F.size(hashes) > 0, some).otherwise(F.array(F.xxhash64(text).bitwiseAND(LOW_BITS)))


def likeness(a: Column, b: Column) -> Column:
    """Of the smallest hashes of both together, the share that both have."""
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, SIZE)
    return F.size(F.array_intersect(both, F.array_intersect(a, b))) / F.size(both)


def written(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def with_next(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """range, guard, id, hash, text: rows dealt by id range, each range with the first row of the next one as a guard."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), whole_text(text).alias("text"))
    docs = docs.select(F.floor(F.col("id") / RANGE).alias("range"), "id", F.xxhash64("text").alias("hash"), "text")
    heads = docs.groupBy("range").agg(F.min(F.struct(F.col("id"), F.col("hash"))).alias("head"))
    order = Window.orderBy(F.col("range").asc_nulls_last())
    numbered = heads.select("head", F.row_number().over(order).alias("place"), F.col("range").alias("own"))
    heads = materialized(numbered, "syncmer-heads")
    previous = heads.select((F.col("place") + 1).alias("place"), F.col("own").alias("range"))
    last = heads.agg(F.max_by("own", "place").alias("range")).select(F.lit(1).alias("place"), "range")
    goals = heads.join(previous.union(last), "place").select(F.col("head.id").alias("head_id"), F.col("head.hash").alias("head_hash"), "range")
    guards = docs.drop("range").join(goals, docs["id"].eqNullSafe(goals["head_id"]) & (docs["hash"] == goals["head_hash"]))
    return docs.withColumn("guard", F.lit(0)).unionByName(guards.select("range", "id", "hash", "text", F.lit(1).alias("guard")))


def fingerprint_documents(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of `df`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_anchors.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document's,
    in ascending order of integral ids, a null id last; after the last comes the first. Rows with the same id follow one
    another by a hash of their texts. A null text is empty; empty texts and others too short for an anchor are alike only
    if they are equal. A single row is its own successor, an empty table stays empty. Other columns are not read.

    A fingerprint has the `SIZE` = 64 smallest anchor hashes of a text of any length, and likenesses are estimated from them:
    the standard error is at most 1 / (2 * sqrt(64)) = 0.06, and most texts that share few anchors come out as 0.
    """
    dealt = with_next(df, text, id_col).repartition("range")
    # Lengths are columns below the window, so that no filter over anchors measures a text once for each of them.
    marked = with_inner_hashes(dealt.withColumn("n", F.length("text")), "text", "inner")
    marked = with_anchor_places(marked, "inner", "places")
    marked = marked.withColumn("hashes", anchor_hashes(F.col("inner"), F.col("places"))).drop("inner")
    marked = marked.withColumn("sketch", sketch(F.col("hashes"), F.col("text")))
    following = Window.partitionBy("range").orderBy("guard", F.col("id").asc_nulls_last(), "hash")
    followed = marked.select("*", *(F.lead(c).over(following).alias(f"next_{c}") for c in ("text", "n", "places", "hashes", "sketch"))).where("guard = 0")
    half = F.floor(F.col("n") / 2)
    cut = followed.withColumns({"head": F.left("text", F.col("n") - half), "tail": F.left("next_text", half)})
    seam = cut.withColumn("seam_text", F.concat(F.right("head", F.lit(K - 1)), F.left("tail", F.lit(K - 1))))
    seam = with_anchor_places(with_inner_hashes(seam, "seam_text", "seam"), "seam", "seam_places")

    def inside(hashes: str, places: str, length: Column) -> Column:
        """Anchors that end within the first `length` code points of their text."""
        return F.slice(hashes, F.lit(1), F.size(F.filter(places, lambda i: i <= length - K)))

    edited = seam.select(
        "id", "n", "sketch", "next_sketch", "hashes",
        F.concat("head", "tail").alias("edited"),
        F.concat(
            inside("hashes", "places", F.col("n") - half), inside("next_hashes", "next_places", F.least("next_n", half)),
            anchor_hashes(F.col("seam"), F.col("seam_places")),
        ).alias("edited_hashes"),
    ).withColumn("edited_sketch", sketch(F.col("edited_hashes"), F.col("edited")))
    return edited.select(
        F.col("id").alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        F.size("hashes").alias("n_anchors"),
    )
