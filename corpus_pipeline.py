"""Training-data pipeline: language ID, near duplicates, secrets, source mixing, packing.

Each stage takes (spark, docs, sf_dir), with docs the written result of the stage before, and
returns a DataFrame. All but the last return the columns of ``docs``; the last returns packed
pieces. Stages read ``doc_id``, ``text``, ``lang`` and ``source`` by name and carry other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import prepare, table, written
from tidewater.llm.language_id import fit_languages, held_out_row, identify
from tidewater.llm.mixing import mixed_documents
from tidewater.llm.packing import pack_documents
from tidewater.llm.secrets import mask_secrets
from tidewater.llm.similarity_join import link_documents

def unused(name: str, *taken: list[str]) -> str:
    """``name``, with underscores before it until no column of ``taken`` is called so (case ignored)."""
    known = {c.lower() for columns in taken for c in columns}
    while name.lower() in known:
        name = "_" + name
    return name


MIN_LANGUAGE_SCORE = 0.3  # less is a near tie between families and between languages


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sets ``lang`` to the predicted language; null, letterless and undecided texts go.
    Learns like the language ID query, from the labels of the rows it is given."""
    prepare(spark)
    labelled = docs.where(~held_out_row() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = fit_languages(labelled.select(F.col("doc_id").alias("key"), "text", "lang"))
    # The model's columns may clash with the table's: they travel under other names.
    names = {c: f"__{k}" for k, c in enumerate(docs.columns)}
    judged = identify(docs.select(*(F.col(c).alias(n) for c, n in names.items()), F.col("text").alias("__text")), model, "__text")
    judged = judged.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return judged.select(*(F.col("lang_pred").alias(c) if c == "lang" else F.col(names[c]).alias(c) for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the first in the order of ``docs``.
    Rows are numbered once and written with their numbers, as another read may pack the files
    otherwise; so null and repeated ids are told apart. Texts without words are no one's duplicate."""
    prepare(spark)
    row, other = unused("__row", docs.columns), unused("__gone", docs.columns)
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    linked = link_documents(numbered, row, "text")
    gone = written(linked.where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias(other)), "duplicates")
    return numbered.join(gone, F.col(row) == F.col(other), "left_anti").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mask, in the whole text; ``n_chars`` follows. No document goes."""
    prepare(spark)
    masked = mask_secrets(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents by the probabilities that make token shares meet the targets."""
    names = {c: f"__{k}" for k, c in enumerate(docs.columns)}
    own = docs.select(*(F.col(c).alias(names[c]) for c in docs.columns), "doc_id", "text", "lang", "source")
    mixed = mixed_documents(own, meet_targets=True)
    return mixed.where("mix_kept").select(*(F.col(names[c]).alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences; one row per piece."""
    import public_tokenizers
    prepare(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_stage), ("near_duplicates", near_duplicate_stage), ("secrets", secret_stage),
          ("source_mixing", mixing_stage), ("packing", packing_stage)]
ORACLE_SQL = None  # hashing, fitting and tokenizing are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
