"""The registered queries of the operators of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared, language_id, piece_viterbi, toxicity
from .bfd_packing import pack_best_fit
from .cover_tree import top_k
from .media import to_transport_streams
from .mixture_packing import pack_by_mixture
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .token_counts import count_by_line


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared.spread(_shared.table(spark, sf_dir, "documents"))


def op1_bfd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed best-fit-decreasing into rows of 4096 ids."""
    return pack_best_fit(_documents(spark, sf_dir))


def op2_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 4096 ids that mirror the sources' shares of the corpus."""
    return pack_by_mixture(_documents(spark, sf_dir))


def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best integer inner products of every twentieth vector with all others."""
    vectors = _shared.table(spark, sf_dir, "embeddings")
    return top_k(vectors, F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by trees fitted on the rows that are not held out."""
    docs = _documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(docs.where(~F.coalesce(held_out, F.lit(False))))
    found = language_id.identify(docs, model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document by models fitted on the labelled rows that are not held out."""
    docs = _documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = _shared.table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids by the best path over pieces, and whether they decode to its text."""
    return piece_viterbi.encode(_documents(spark, sf_dir))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings that earlier documents hold."""
    return remove_repeats(_documents(spark, sf_dir), width=50)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(_documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and of each of its lines, crossing tokens going to the line with most of them."""
    return count_by_line(_documents(spark, sf_dir), rule="majority")


def op10_transport_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes as a transport stream, read back."""
    return to_transport_streams(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bfd_packing, op2_mixture_packing, op3_cover_tree, op4_language_id, op5_toxicity, op6_piece_viterbi, op7_suffix_dedup, op8_simhash, op9_token_counts, op10_transport_streams)}


def oracle_sql() -> dict[str, str]:
    return {}
