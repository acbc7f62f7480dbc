"""The operators of this folder as queries over the driver's tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odskein.llm import oracle
from odskein.llm.shared import new_path, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from odskein.llm.piece_codec import encoded

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op3_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.passage_quality import trained_scores

    return trained_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from odskein.llm.chat import digests, formatted

    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return digests(formatted(turns, public_tokenizers.path("byte_bpe_50k.json")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.warc import archived

    records = archived(table(spark, sf_dir, "pages")).where("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.suffix_dedup import repeated_bytes

    return repeated_bytes(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.quality_rules import judged

    return judged(table(spark, sf_dir, "documents")).drop("failed_rules")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.license_scan import scan

    return scan(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from odskein.llm.token_files import id_digests, write_token_files

    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return id_digests(spark, path)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.periodic_runs import planted, run_digests, runs

    return run_digests(runs(planted(table(spark, sf_dir, "documents"))))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.line_dedup import without_common_lines

    kept = without_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from odskein.llm.lexical_search import ranked_documents

    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (op1_simhash, op2_pieces, op3_passage_quality, op4_chat, op5_decontamination, op6_warc, op7_suffix_dedup, op8_quality_rules, op9_license_scan, op10_token_files, op11_periodic_runs, op12_line_dedup, op13_lexical_search)}
ORACLE: dict[str, str] = {
    "op4_chat": oracle.CHAT,
    "op5_decontamination": oracle.DECONTAMINATION,
    "op6_warc": oracle.WARC,
    "op7_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op8_quality_rules": oracle.QUALITY_RULES,
    "op9_license_scan": oracle.LICENSE_SCAN,
    "op12_line_dedup": oracle.LINE_DEDUP,
    "op13_lexical_search": oracle.LEXICAL_SEARCH,
}
