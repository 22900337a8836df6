"""Corpus pipeline: five stages over ``documents``, each one of the operators.

quality classifier → exact dedup → SimHash near-dedup → substring dedup →
best-fit packing.  Each stage works on all that its predecessor kept; its
result is written as Parquet and read again.  All but the last return the
columns of ``documents``.

Defined cases: a null id is kept or dropped by its text like any other; a null
text is empty.  Of a group of near copies the document with the smallest id
stays (of several rows with that id, one of them).  A text
that substring dedup empties stays, empty.  Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import classifier, common as C, exact, packing, simhash, substring


def _col(name: str):
    """A column by its whole name, which may hold a dot."""
    return F.col(f"`{name}`")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = C.read(spark, sf_dir, "labels").filter(~classifier.held_out())
    model = classifier.fit(docs, labels, "quality")
    name = C.free_name(docs, "score")
    scored = classifier.score(docs, model, keep=docs.columns, score_col=name)
    return scored.filter(F.col(name) >= classifier.THRESHOLD).select(*[_col(c) for c in docs.columns])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    clash = {c: C.free_name(docs, c) for c in ("keep_id", "group_size", "kept", "text_sha256") if c in docs.columns}
    out = exact.exact_dedup(docs.withColumnsRenamed(clash)).filter("kept")
    return out.select(*[_col(clash.get(c, c)).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_per_component(docs, simhash.linked_rows(docs, shingle=4, radius=4))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand elsewhere too are cut out of the texts; a text that
    loses nothing stays as it is."""
    clash = {c: C.free_name(docs, "old_" + c) for c in ("n_words", "n_removed", "kept_text") if c in docs.columns}
    frame = docs.withColumnsRenamed(clash)
    out = substring.remove_repeated(frame, size=35, keep=[c for c in frame.columns if c != "text"], untouched=True)
    columns = {c: _col(clash.get(c, c)) for c in docs.columns} | {"text": F.col("kept_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length(F.col("kept_text")).cast("long")).otherwise(
            F.col(clash.get("n_chars", "n_chars"))).cast(docs.schema["n_chars"].dataType)
    return out.select(*(columns[c].alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of 1024."""
    return packing.pack_documents(docs, C.tokenizer_path(), capacity=1024, end_id=2)


STAGES = [("quality classifier", quality), ("exact dedup", exact_copies), ("simhash near-dedup", near_copies),
          ("substring dedup", repeated_passages), ("best-fit packing", pack)]

#: the classifier and the fingerprints cannot be told in SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = C.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = C.materialize(docs, f"stage-{i}")
    return docs
