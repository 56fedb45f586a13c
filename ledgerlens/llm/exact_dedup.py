"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after deleting ``[\\x20\\x09-\\x0D]``.

1. Texts are counted per length bucket; a text alone in its bucket is unique.
2. The rest are counted per hash of (length, first ``prefix_chars`` characters).
3. Only texts that are still not alone are hashed in full and grouped.

A bucket is a number below a fixed bound (``LENGTH_BUCKETS``, ``PREFIX_BUCKETS``),
so the lists of crowded buckets that are broadcast to the next level have a
proven size, whatever the input. Two lengths or prefixes that share a bucket only
send a unique text one level further, where the full hash settles it. The text
itself is never shuffled: each level reads it again and moves counts or hashes.

Hot groups: all three groupings aggregate map-side; the join that hands the
group back to its rows is an ordinary equi join, whose hot key AQE can split.

Edge cases: null text counts as empty; empty texts are one group; a null id sorts
after every other id; rows repeated with the same id and text are one group of
which exactly one row stays; an empty table gives an empty result; columns other
than the id and the text are never read, so clashing names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import WHITE, crowded, equi_split, split_by_ids, whole_text
from ledgerlens.session import checkpoint_dir

LENGTH_BUCKETS = 1 << 18
PREFIX_BUCKETS = 1 << 20


def normalised(text: Column) -> Column:
    """The text without white space."""
    out = whole_text(text)
    for ch in WHITE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def refined(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, digest: bool) -> DataFrame:
    """``id, n_points, full, shared``: ``shared`` marks the texts that the first two levels left over.

    ``full`` is the SHA-256 of the normalised text, of the left-over ones alone
    unless ``digest`` asks for all.
    """
    base = docs.select(F.col(id_col).alias("id"), whole_text(F.col(text_col)).alias("text")).select(
        "id", F.char_length("text").alias("n_points"), normalised(F.col("text")).alias("norm"))
    length = F.octet_length("norm")
    base = base.withColumn("by_length", F.pmod(length, F.lit(LENGTH_BUCKETS)))
    lengths = crowded(base, "by_length")
    prefix = F.pmod(F.xxhash64(length, F.substring("norm", 1, prefix_chars)), F.lit(PREFIX_BUCKETS))
    second = base.join(F.broadcast(lengths), "by_length", "left_semi").select(prefix.alias("by_prefix"))
    prefixes = crowded(second, "by_prefix")
    marked = (base.join(F.broadcast(lengths.withColumn("same_length", F.lit(True))), "by_length", "left")
              .withColumn("by_prefix", F.when(F.col("same_length"), prefix))
              .join(F.broadcast(prefixes.withColumn("same_prefix", F.lit(True))), "by_prefix", "left"))
    shared = F.coalesce(F.col("same_prefix"), F.lit(False))
    sha = F.sha2(F.col("norm"), 256)
    return marked.select("id", "n_points", (sha if digest else F.when(shared, sha)).alias("full"), shared.alias("shared"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 256,
                digest: bool = False) -> DataFrame:
    """One row per document: ``id, keep_id, group_size, kept, full``.

    Of equal texts the row with the most code points in the original text stays,
    then the smallest id. ``full`` is the SHA-256 of the normalised text, null for
    texts that were told apart earlier unless ``digest`` is set.
    """
    rows = refined(docs, id_col, text_col, prefix_chars, digest)
    same = rows.groupBy("full", "shared", "id", "n_points").agg(F.count(F.lit(1)).alias("copies"))
    best = F.struct((-F.col("n_points")).alias("shortest"), F.col("id").isNull().alias("no_id"), F.col("id").alias("keep_id"))
    groups = (same.filter("shared").groupBy(F.col("full").alias("g_full"))
              .agg(F.sum("copies").alias("size"), F.min(best).alias("best")).filter("size > 1"))
    joined = equi_split(same, groups, "full", "g_full", "left")  # a hot text's rows can be split
    chosen = F.col("best.keep_id").eqNullSafe(F.col("id")) & (F.col("best.shortest") == -F.col("n_points"))
    alone = F.col("g_full").isNull()
    return (joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("id",
                    F.when(alone, F.col("id")).otherwise(F.col("best.keep_id")).alias("keep_id"),
                    F.when(alone, F.lit(1)).otherwise(F.col("size")).cast("long").alias("group_size"),
                    F.when(alone, F.lit(True)).otherwise(chosen & (F.col("copy") == 1)).alias("kept"),
                    "full"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one per group of equal texts, the one ``exact_dedup`` keeps.

    Decisions are made on ids and hashes of shared texts. Rows whose id is not among
    those of dropped rows stay where they are; the others are shuffled once, by id and
    hash. Of rows repeated with one id and equal text, the one with the most code points
    stays (then the first by its text).
    """
    checkpoint_dir(docs.sparkSession)
    found = exact_dedup(docs, id_col, text_col).filter(F.col("group_size") > 1).select("id", "kept", "full")
    marks = found.groupBy("id", "full").agg(F.max("kept").alias("stays"), F.min("kept").alias("all_stay")).filter(
        ~F.col("all_stay")).select("id", F.col("full").alias("__full"), F.col("stays").alias("__stays"),
                                   *_named(F.col("id"), "__id", "__has_id")).checkpoint()
    asked, rest = split_by_ids(docs, id_col, marks.select("id"))
    keys = ["__id", "__has_id", "__full"]
    tagged = asked.select("*", *_named(F.col(id_col), "__id", "__has_id"), F.sha2(normalised(F.col(text_col)), 256).alias("__full"))
    told = tagged.join(marks.select(*keys, "__stays"), keys, "left")
    order = Window.partitionBy(*keys).orderBy(F.char_length(whole_text(F.col(text_col))).desc(), whole_text(F.col(text_col)))
    repeated = told.filter("__stays").withColumn("__nth", F.row_number().over(order)).filter("__nth = 1").drop("__nth")
    kept = told.filter(F.col("__stays").isNull()).unionByName(repeated)
    return kept.select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).unionByName(rest)


def _named(id_: Column, name: str, known: str) -> list[Column]:
    """An id as two columns without nulls, for joining and grouping alike."""
    return [F.coalesce(id_.cast("string"), F.lit("")).alias(name), id_.isNotNull().alias(known)]
