"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import importlib.util
import os
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import arc_to_warc, bitplanes, bpe_fst, chat_windows, html_main, kneser_ney, line_crf, merkle, ngram_join, quality_gbt, spaced_seeds, spelling, suffix_levels
from tiermill.llm.files import rows_per_batch
from tiermill.llm.statements import STATEMENTS
from tiermill.sources.scratch import materialize

#: Folder of the public tokenizer files; a parameter of the environment, as they are not part of this repository.
TOKENIZERS = os.environ.get("TIERMILL_TOKENIZERS") or "/opt/tokenizers"


def tokenizer_file(name: str) -> str:
    found = importlib.util.find_spec("public_tokenizers")
    folder = TOKENIZERS if found is None or "TIERMILL_TOKENIZERS" in os.environ else os.path.dirname(found.origin)
    return os.path.join(folder, name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    documents = documents.withColumn("held_out", F.coalesce(held_out(10), F.lit(False)))
    model = kneser_ney.fit(documents.filter(~F.col("held_out")))
    scored = kneser_ney.score(documents, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_bitplanes(spark: SparkSession, folder: str) -> DataFrame:
    files = bitplanes.write_ids(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)
    back = bitplanes.read_ids(files)
    return back.select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op6_bpe_fst(spark: SparkSession, folder: str) -> DataFrame:
    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    both = bpe_fst.round_trip(documents, ranks)
    digests = both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe_fst.id_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
    with rows_per_batch(spark, 1000):
        return materialize(digests, "bpe").df


def op3_suffix_levels(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_levels.remove_repeated(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["until"] - s["from"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_html_main(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_main.extract(table(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_windows.digests(chat_windows.format_windows(turns))


def held_out(parts: int) -> Column:
    """Documents that nothing is learned from: the crc32 of the id as text is divisible by ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == 0


def taught(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").filter(~held_out(5))


def op7_quality_gbt(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_gbt.learn(documents, taught(spark, folder))
    scored = quality_gbt.score(documents, model).drop("text")
    predicted = (F.col("score") >= quality_gbt.KEEP_FROM).cast("int")
    return scored.select("doc_id", held_out(5).alias("held_out"), "score", predicted.alias("predicted"))


def op8_line_crf(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = line_crf.learn(documents, taught(spark, folder))
    judged = line_crf.judge(documents, model)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "n_lines", "n_content_lines", "n_content_words")


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link(table(spark, folder, "documents"))


def op10_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return spaced_seeds.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_arc_to_warc(spark: SparkSession, folder: str) -> DataFrame:
    archived = arc_to_warc.index(arc_to_warc.write_arc(table(spark, folder, "pages")))
    page_id = F.col("key").cast("long")
    chosen = arc_to_warc.choose_types(archived, order=[page_id.isNull(), page_id])
    records = arc_to_warc.resolve(arc_to_warc.read_warc(arc_to_warc.convert(chosen)))
    return records.filter("kind IN ('response', 'revisit')").select(
        page_id.alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        F.col("refers_to_key").cast("long").alias("refers_to"),
    )


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = merkle.digest(*[merkle.cell(lowered if c == "text" else F.col(c)) for c in columns])
    carry = {"tampered": F.when(held_out(3), tampered)}
    rows = merkle.manifest(table(spark, folder, "documents"), "lang", "doc_id", columns, carry)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    proof = F.sha2(merkle.siblings(F.col("path")), 256)
    proved = rows.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.count_words(table(spark, folder, "documents"), slip=199)
    return spelling.forms(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_bitplanes": op2_bitplanes,
    "op3_suffix_levels": op3_suffix_levels,
    "op4_html_main": op4_html_main,
    "op5_chat_windows": op5_chat_windows,
    "op6_bpe_fst": op6_bpe_fst,
    "op7_quality_gbt": op7_quality_gbt,
    "op8_line_crf": op8_line_crf,
    "op9_ngram_join": op9_ngram_join,
    "op10_spaced_seeds": op10_spaced_seeds,
    "op11_arc_to_warc": op11_arc_to_warc,
    "op12_merkle": op12_merkle,
    "op13_spelling": op13_spelling,
}

__all__ = ["QUERIES", "STATEMENTS"]
