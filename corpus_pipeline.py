"""A training corpus from ``documents``: five stages, each on all that the one before kept.

``STAGES`` names them in order; each takes (spark, docs, folder of the tables) and returns a DataFrame. All but the last
return the columns of ``documents``. ``run`` writes the result of each stage to the scratch folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import bpe_fst, ngram_join, quality_gbt, spaced_seeds, suffix_levels
from tiermill.llm.files import rows_per_batch
from tiermill.llm.queries import table, taught, tokenizer_file
from tiermill.sources.scratch import materialize

#: No SQL: the stages learn, search and encode; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None

#: Near copies are documents whose sets of five words in a row are equal to 80 % or more.
SHINGLE = 5
PERCENT = 80

#: Rows in an Arrow batch, of texts and of packed batches of texts, some megabytes each. An executor does not give the memory of
#: larger ones back, so that they would count in all stages that follow.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_AT_ONCE = 500
PACKED_AT_ONCE = 2


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality trees accept, learned from the labels that are not held out.

    They are scored when they are read, so the session keeps its smaller Arrow batches; ``run`` puts them back."""
    if int(spark.conf.get(BATCH)) > TEXTS_AT_ONCE:
        spark.conf.set(BATCH, str(TEXTS_AT_ONCE))
    model = quality_gbt.learn(docs.select("doc_id", "text"), taught(spark, folder))
    scored = quality_gbt.score(docs, model, name="__score")
    return scored.filter(F.col("__score") >= quality_gbt.KEEP_FROM).select(*docs.columns)


def _stored(docs: DataFrame, label: str, rows: int) -> DataFrame:
    """The same rows, stored by a job with this many of its input rows in an Arrow batch."""
    with rows_per_batch(docs.sparkSession, rows):
        return materialize(docs, label, "zstd").df


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """The rows with a number each (``__row``), stored, so that it is the same at every reading."""
    return materialize(docs.withColumn("__row", F.monotonically_increasing_id()), label, "zstd").df


def _own_texts(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("__row").alias("doc_id"), "text")


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id, one without an id last; each row is judged by its own text.
    Rows without words all stay, except repeated ones of one id."""
    rows = _numbered(docs, "copies")
    linked = ngram_join.link(_own_texts(rows), shingle=SHINGLE, percent=PERCENT)
    own = rows.select("__row", F.col("doc_id").alias("__id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__text"))
    known = linked.select(F.col("doc_id").alias("__row"), "n_shingles", "component_id").join(own, "__row")
    bare = (F.col("n_shingles") == 0) & F.col("__id").isNotNull()
    groups = known.groupBy(
        bare.alias("bare"), F.when(bare, F.col("__id")).otherwise(F.col("component_id")).alias("group"), F.when(bare, F.col("__text")).alias("same")
    )
    first = groups.agg(F.min(F.struct(F.col("__id").isNull(), "__id", "__row")).alias("first"))
    return rows.join(first.select("first.__row"), "__row", "left_semi").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; of a character that is cut in two all bytes stay. Every
    document stays, with an empty text if all of it was held before."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    aside = {c: f"__kept_{i}" for i, c in enumerate(others)}  # whatever their names
    cut = suffix_levels.remove_repeated(docs.withColumnsRenamed(aside), keep=tuple(aside.values()), whole_characters=True)
    text = F.col("kept").cast("string")
    new = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.char_length(text).cast("long")}
    return _stored(cut.select(*(new.get(c, F.col(aside.get(c, c))).alias(c) for c in docs.columns)), "cut", PACKED_AT_ONCE)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that hold no passage of the benchmark, each judged by its own text, whatever its id."""
    rows = _numbered(docs, "searched")
    with rows_per_batch(spark, TEXTS_AT_ONCE):
        found = spaced_seeds.contaminated(_own_texts(rows), table(spark, folder, "benchmark"))
    found = found.select(F.col("doc_id").alias("__row")).distinct()
    return rows.join(found, "__row", "left_anti").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each text, with the check that they decode to it."""
    # the stages before leave the executor's heap grown, so the workers remember less than they do on their own
    both = bpe_fst.round_trip(docs.select("doc_id", "text"), tokenizer_file("byte_bpe_50k.tiktoken"), pieces=50_000, states=40_000)
    exact = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    rows = both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), exact.alias("round_trip"))
    return _stored(rows, "tokens", 100)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with rows_per_batch(spark, TEXTS_AT_ONCE):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return docs
