"""The registered queries of this subpackage, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import chat_format, conversation_trie, importance, jaccard_join, latent_decontam, license_scan, line_crf, line_dedup, piece_lattice, prefix_tokens, pu_quality, repeats, toxic_grammar
from starloom.llm.common import table
from starloom.llm.sql import SQL  # noqa: F401

PIECES = "piece_bpe_32k.model"


def piece_table(path: str | None = None, kind: str = "bpe") -> prefix_tokens.PieceTable:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(PIECES)
    return prefix_tokens.load_pieces(path, kind)


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.verdicts(line_crf.label_lines(docs, line_crf.train(docs, table(spark, sf_dir, "labels"))))


def op2_latent_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent_decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pu_quality.score(docs, pu_quality.train(docs, table(spark, sf_dir, "labels")))


def op4_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.token_counts(table(spark, sf_dir, "documents"), piece_table())


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.without_repeats(table(spark, sf_dir, "documents")))


def op8_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.document_digests(table(spark, sf_dir, "documents"), piece_table())


def op9_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxic_grammar.score(docs, toxic_grammar.train(docs, table(spark, sf_dir, "labels")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.cleaned_texts(table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_latent_decontam": op2_latent_decontam,
    "op3_pu_quality": op3_pu_quality,
    "op4_prefix_tokens": op4_prefix_tokens,
    "op5_license_scan": op5_license_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_repeats": op7_repeats,
    "op8_piece_lattice": op8_piece_lattice,
    "op9_toxic_grammar": op9_toxic_grammar,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_chat_format": op12_chat_format,
    "op13_importance": op13_importance,
}
