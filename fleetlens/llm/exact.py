"""Exact dedup by two-pass Bloom filtering, DataFrame functions only.

Pass 1 hashes every normalised text to two positions of a counting filter of a
fixed number of bits and keeps the positions that were hit twice or more, as
64-bit words.  Pass 2 looks every row up in that filter: a row with a position
that was hit once is certainly unique and passes straight through; only the
others shuffle, by SHA-256 of the normalised text.

The filter has at most ``bits / 64`` words, whatever the input, so broadcasting
it is bounded (a million words with the default).  More rows than the filter
suits only mean that more rows shuffle; the result stays exact.

Equal means identical after lower-casing A-Z; a null text counts as empty.  Of
equal texts the row with the largest id stays; a null id is smaller than any
other.  Of repeated rows with that id and the same text, exactly one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

BITS = 1 << 26


def repeated_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """(``word``, ``mask``): the positions hit twice or more, one row per
    64-bit word of the filter.  ``hashes`` has the columns ``p0`` and ``p1``."""
    hit = (hashes.select(F.explode(F.array("p0", "p1")).alias("pos"))
           .groupBy("pos").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return (hit.groupBy(F.shiftright("pos", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(pos & 63 as int))")).alias("mask")))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``
    (these replace columns of the same names).  Every input row is returned."""
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, 64 at least")
    df = df.drop("keep_id", "group_size", "kept", "text_sha256")
    own = [F.col(f"`{c}`") for c in df.columns]          # a name may hold a dot
    p0, p1, w0, w1, m0, m1, hit = (C.free_name(df, x) for x in ("p0", "p1", "w0", "w1", "m0", "m1", "hit"))
    norm = C.ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    ident = F.col(f"`{id_col}`")

    def positions(frame):
        h = F.xxhash64(norm)
        return frame.withColumns({p0: h.bitwiseAND(bits - 1), p1: F.shiftrightunsigned(h, 32).bitwiseAND(bits - 1)})

    filt = repeated_filter(positions(df).select(F.col(p0).alias("p0"), F.col(p1).alias("p1")), bits)

    def words(word, mask):
        return F.broadcast(filt.select(F.col("word").alias(word), F.col("mask").alias(mask)))

    def bit(mask, pos):
        return F.expr(f"coalesce((`{mask}` >> cast(`{pos}` & 63 as int)) & 1L, 0L) = 1L")

    looked = (positions(df)
              .join(words(w0, m0), F.shiftright(p0, 6) == F.col(w0), "left")
              .join(words(w1, m1), F.shiftright(p1, 6) == F.col(w1), "left")
              .withColumn(hit, bit(m0, p0) & bit(m1, p1))
              .select(*own, hit)
              .withColumn("text_sha256", F.sha2(norm, 256)))
    single = looked.filter(~F.col(hit)).select(
        *own, ident.alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")

    suspects = looked.filter(F.col(hit)).select(*own, "text_sha256")
    gs, gk, gn, rn, tied_in = (C.free_name(suspects, x) for x in ("gs", "gk", "gn", "rn", "tied"))
    # by (text, id) first: a group of copies that holds a third of all rows is spread by its ids,
    # and each map task sends one row of it to the second step
    groups = (suspects.groupBy(F.col("text_sha256").alias(gs), ident.alias(gk))
              .agg(F.count(F.lit(1)).alias(gn))
              .groupBy(gs).agg(F.max(F.struct(gk, gn)).alias("top"), F.sum(gn).alias(gn))
              .select(gs, gn, F.col(f"top.{gk}").alias(gk), (F.col(f"top.{gn}") > 1).alias(tied_in)))

    def with_groups(which, kept):
        return (suspects.join(which, F.col("text_sha256") == F.col(gs))
                .select(*own, F.col(gk).alias("keep_id"), F.col(gn).alias("group_size"),
                        kept.alias("kept"), "text_sha256"))

    largest = ident.eqNullSafe(F.col(gk))
    plain = with_groups(groups.filter(~F.col(tied_in)), largest)
    # repeated rows share the largest id: one of them stays (rare, so a branch of its own)
    tied = with_groups(groups.filter(F.col(tied_in)), largest)
    order = Window.partitionBy("text_sha256", ident).orderBy(F.lit(1))
    tied = (tied.withColumn(rn, F.row_number().over(order))
            .withColumn("kept", F.col("kept") & (F.col(rn) == 1)).drop(rn))
    return single.unionByName(plain).unionByName(tied)
