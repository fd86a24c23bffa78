"""From raw documents to packed training sequences.

``STAGES`` are applied in order; each works on all rows its predecessor kept,
which are written to the shared folder and read again in between. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coview.llm import decontaminate, jaccard, langid, packing, pii
from coview.llm.tables import table, tokenizer_path
from coview.session import write_cut

#: a document with at least this share of benchmark words goes as a whole
DROP_SHARE = 0.5


def _with_text(changed: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` in order, ``n_chars`` (if there) counted anew."""
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, no letter) go."""
    model = langid.fit(docs)
    found = langid.identify(docs, model, keep=tuple(docs.columns))
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the least id. Of rows
    that share an id the one with the least text stays; null ids stay."""
    groups = jaccard.join(docs)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("text")
    kept = (docs.join(first, "doc_id", "left_semi").withColumn("_place", F.row_number().over(order))
            .where("_place = 1").select(*docs.columns))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Hit words are cut out; mostly hit documents go. What is kept is written in
    between: a task that ran both steps would hold a Python worker for each, and
    the additional workers would wait beside those of all later stages."""
    found = decontaminate.find_windows(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns))
    hit = decontaminate.n_hit()
    kept = found.where((hit == 0) | (hit < F.col("n_words") * DROP_SHARE))
    return _with_text(decontaminate.remove_hits(write_cut(kept, "kept")), docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every accepted span becomes its kind's tag; all documents stay."""
    rest = tuple(c for c in docs.columns if c != "text")
    return _with_text(pii.redact(docs, rest), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: learned stages and tokenisation have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
