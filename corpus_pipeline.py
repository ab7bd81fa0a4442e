"""From raw documents to packed training sequences, a stage at a time.

Stages: quality rules, near duplicates, benchmark decontamination, personal data, packing.
Each stage gets what the stage before it kept. All but the last return the columns of
``documents``.

Disk: the tables a stage stores for itself are removed when a later stage starts and its
input no longer reads them (its input is then the written output of the stage before), so
at most one stage's tables are on disk at a time. ``run`` removes them all at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm.common import ROW, numbered, without
from prefspark.llm.decontamination import contamination
from prefspark.llm.near_duplicates import near_duplicates
from prefspark.llm.pii import redact_personal_data
from prefspark.llm.quality_rules import cleaned_documents
from prefspark.llm.queries import packed_digests
from prefspark.storage import durable, recorded_tables, remove

#: Tables stored by stages that ran before, removed as soon as no input reads them.
_BEHIND: list[str] = []


def _read_by(docs: DataFrame) -> list[str]:
    try:
        return docs.inputFiles()
    except Exception:  # a plan that lists no files reads none of ours
        return []


def _free(spark: SparkSession, docs: DataFrame | None) -> None:
    """Remove the stored tables of earlier stages that ``docs`` doesn't read."""
    files = _read_by(docs) if docs is not None else []
    for path in list(_BEHIND):
        if not any(f.startswith(path) or f.startswith("file:" + path) for f in files):
            remove(spark, path)
            _BEHIND.remove(path)


def _freeing(stage):
    """``stage``, which first frees what earlier stages stored and records what it stores."""

    def body(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _free(spark, docs)
        with recorded_tables() as paths:
            out = stage(spark, docs, sf_dir)
        _BEHIND.extend(paths)
        return out

    body.__name__, body.__doc__ = stage.__name__, stage.__doc__
    return body


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, if there is one, counts the text."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the frequent lines; ``n_chars`` counts the new text."""
    return _counted(cleaned_documents(docs).where("_rules.kept").drop("_rules"))


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first of the least id, of each group of near duplicates."""
    rows = numbered(docs)
    return without(rows, near_duplicates(rows, row=ROW).where("not first"), ROW).drop(ROW)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no phrase of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = numbered(docs)
    return without(rows, contamination(rows, items, row=ROW).where("contaminated"), ROW).drop(ROW)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in them replaced; ``n_chars`` counts the new text."""
    return _counted(redact_personal_data(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packed_digests(docs)


STAGES = [
    ("quality_rules", _freeing(quality_stage)),
    ("near_duplicates", _freeing(duplicate_stage)),
    ("decontamination", _freeing(decontamination_stage)),
    ("personal_data", _freeing(personal_data_stage)),
    ("packing", _freeing(packing_stage)),
]

#: SQL can express neither the tokenizer's ids nor the spans with their checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written: list[str] = []
    for _, stage in STAGES:
        with recorded_tables() as paths:
            docs = durable(stage(spark, docs, sf_dir))
        for path in written:  # the output of the stage before is read no more
            remove(spark, path)
        written = [paths[-1]]
        _BEHIND.extend(p for p in paths[:-1] if p not in _BEHIND)
    _free(spark, docs)
    return docs
