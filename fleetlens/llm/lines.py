"""Line dedup with DataFrame functions only.

Texts are split at ``\\n`` and exploded; a line's key is the line without
blanks at both ends and with A-Z lower-cased.  Keys long enough are hashed
(MD5, 16 bytes), the distinct documents of each hash are counted, and a key
found in ``min_docs`` documents or more loses all its lines except in the
document with the smallest id.  The dropped positions of a row go back to it,
and the runs of lines between them are joined again.

What shuffles: hashes with ids (counted, partly on the map side), hashes with
positions, and each text once.  The repeated hashes and the dropped positions
are written tables, so both joins read them as plain shuffle sides and a hot
line, or a row that is repeated very often, is split by AQE's skew join.

Defined cases: a null or empty text is one empty line; only ``\\n`` ends a line
(``\\r`` is a blank at its end).  Rows with the same id are one document when
documents are counted; a null id is a document of its own, larger than any
other.  Repeated rows have the same result.  A text that loses nothing comes
back as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BLANKS = " \t\n\x0b\f\r"


def line_key(line):
    """Blanks stripped at both ends, A-Z lower-cased."""
    return C.ascii_lower(F.btrim(line, F.lit(BLANKS)))


def split_lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def without(lines, dropped):
    """``lines`` without the positions in the ascending array ``dropped``: the
    runs between them, so the work follows the lines, not lines times drops."""
    def runs(all_lines):
        before = F.concat(F.array(F.lit(-1)), dropped)
        after = F.concat(dropped, F.array(F.size(all_lines)))
        return F.flatten(F.zip_with(before, after, lambda a, b: F.slice(all_lines, a + 2, b - a - 1)))
    # bound as a lambda variable, so that the text is split once
    return F.element_at(F.transform(F.array(lines), runs), 1)


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2,
                        min_chars: int = 10) -> DataFrame:
    """``df`` with ``n_lines`` (before), ``n_dropped`` and ``kept_text`` (these
    replace columns of the same names).  Every input row is returned."""
    if min_docs < 1 or min_chars < 0:
        raise ValueError("min_docs must be 1 at least, min_chars not negative")
    df = df.drop("n_lines", "n_dropped", "kept_text")
    idc, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    name = F.concat(F.length(idc.cast("string")).cast("string"), F.lit(":"), idc.cast("string"))
    row = F.unhex(F.md5(F.concat(F.coalesce(name, F.lit("-")), F.coalesce(text, F.lit(""))).cast("binary")))
    # keys and hashes are made in the array, before it is exploded, so each is made once; the outer form (a
    # text has a line at least) keeps Spark from filtering on the array's size and so making it twice
    keys = F.transform(split_lines(text), line_key)
    hashes = F.transform(keys, lambda k: F.when(F.length(k) >= min_chars, F.unhex(F.md5(k.cast("binary")))))
    lines = (df.select(idc.alias("id"), row.alias("row"), hashes.alias("hashes"))
             .select("id", "row", F.posexplode_outer("hashes").alias("pos", "hash")).filter(F.col("hash").isNotNull()))

    docs = F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))
    repeated = C.materialize(lines.groupBy("hash").agg(docs.alias("docs"), F.min("id").alias("first"))
                             .filter(F.col("docs") >= min_docs)
                             .select(F.col("hash").alias("found"), "first"), "repeated-lines")
    dropped = C.materialize(lines.join(repeated, F.col("hash") == F.col("found"))
                            .filter(~F.col("id").eqNullSafe(F.col("first")))
                            .groupBy("row").agg(F.sort_array(F.collect_set("pos")).alias("dropped")), "dropped-lines")

    mine, theirs, gone = (C.free_name(df, x) for x in ("row", "of", "dropped"))
    own = [F.col(f"`{c}`") for c in df.columns]
    n_dropped = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    whole = F.coalesce(text, F.lit(""))
    return (df.withColumn(mine, row)
            .join(dropped.select(F.col("row").alias(theirs), F.col("dropped").alias(gone)),
                  F.col(mine) == F.col(theirs), "left")
            .select(*own, F.size(split_lines(text)).cast("long").alias("n_lines"),
                    F.when(F.col(gone).isNull(), 0).otherwise(n_dropped).cast("long").alias("n_dropped"),
                    F.when(F.col(gone).isNull(), whole)
                    .otherwise(F.array_join(without(split_lines(text), F.col(gone)), "\n")).alias("kept_text")))
