"""One query per operator, over its whole table, with the parameters meant for production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    ann,
    bpe,
    decontaminate,
    language_id,
    licenses,
    merkle,
    mixing,
    ngram_join,
    secrets,
    spelling,
    substring_dedup,
    token_files,
    warc,
)
from tarmac.llm.common import documents_of, ship, stored
from tarmac.llm.oracles import ORACLES as ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors nearest to every twentieth one, by inner product."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a ten-word window of the benchmark."""
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return decontaminate.digest(found)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of each document, its own or the one of the nearest directory above it.

    The table has no paths. A document's source is its repository; the hexadecimal digits of its id
    are its directories and its name. A document that mentions a license is a licence file, of the
    directory with the document's digits or of one up to two above that, by the checksum of its id.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    digits = F.split(F.lower(F.hex("doc_id")), "(?<=.)(?=.)")
    depth = F.greatest(F.size(digits) - 1 - (F.crc32(F.col("doc_id").cast("string")) % 3).cast("int"), F.lit(0))
    mentions = F.coalesce(F.col("text").rlike("(?i)license"), F.lit(False))
    licence_file = F.concat_ws("/", F.slice(digits, F.lit(1), depth), F.lit("LICENSE"))
    place = F.when(mentions, licence_file).otherwise(F.array_join(digits, "/"))
    files = documents.select("doc_id", "text", F.concat_ws("/", "source", place).alias("path"))
    return licenses.scan(files, F.col("path").endswith("/LICENSE")).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.path").alias("path"), "own", "cosine", "licence", "inherited_from"
    )


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as its WARC record says, and its number in the merged capture history."""
    return warc.digest(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's token ids, read back from the files."""
    return token_files.digest(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments, access keys, hexadecimal strings and high-entropy strings in each document."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the words of 35-word windows that occur more than once."""
    return substring_dedup.digest(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot, release time and deadline of each document's block in a mix by tempered source sizes."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    parts = mixing.tempered_parts(mixing.source_counts(documents), MIX_POWER)
    return mixing.mix(documents, parts).select(
        F.col("row.doc_id").alias("doc_id"), "source", "block", "epoch", "slot", "released", "due"
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from three quarters of the labelled ones."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(documents)
    held_out = F.coalesce(language_id.crc(F.col("row.doc_id")) % 4 == 2, F.lit(False))
    return language_id.identify(documents.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of each document: five-word shingles, similarity 0.75 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of each document, and whether it still proves after a third were tampered with."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(hit, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    held = merkle.leaf_hash([*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text])
    proven = merkle.manifest(documents, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"held": held})
    root = merkle.folded(F.col("held"), F.col("proof")).alias("folded_root")
    return proven.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("proof")).alias("proof_sha256"), root
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document and the bytes they decode to, as checksums."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, RANKS).select(F.col("row.doc_id").alias("doc_id"), "ids")
    return bpe.decode(encoded, RANKS).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.joined_hash(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of the documents with its spelling neighbours, the form it is a variant of, and that form's root."""
    counts = spelling.word_counts(documents_of(table(spark, sf_dir, "documents")))
    return spelling.variants(stored(counts, "words"))


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: Share of a source in the mix: its size to this power.
MIX_POWER = 0.9

QUERIES = {
    "op1_ann_search": op1_ann_search,
    "op2_decontaminate": op2_decontaminate,
    "op3_license_scan": op3_license_scan,
    "op4_warc_archives": op4_warc_archives,
    "op5_token_files": op5_token_files,
    "op6_secret_scan": op6_secret_scan,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_source_mix": op8_source_mix,
    "op9_language_id": op9_language_id,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_spelling_variants": op13_spelling_variants,
}
