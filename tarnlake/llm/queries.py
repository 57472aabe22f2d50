"""Named queries over the given tables, one for each operator, with check SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import (
    chat_format,
    decontaminate,
    jaccard_join,
    language_id,
    line_dedup,
    prefix_trie,
    quality_rules,
    source_mix,
    spelling_variants,
    substring_dedup,
    token_store,
    url_templates,
    warc_archive,
)
from tarnlake.llm.check_sql import ORACLE_SQL
from tarnlake.session import ship_package, work_path

__all__ = ["ORACLE_SQL", "QUERIES"]

#: Rows of one Arrow batch: whole texts of any length pass through these batches.
ARROW_ROWS = "1024"
URL_RULES = (
    url_templates.Rule("org/", "allow"),
    url_templates.Rule("example.org/es/", "block"),
    url_templates.Rule("example.org/en/1", "block"),
    url_templates.Rule("com/fr/", "allow"),
    url_templates.Rule("com/de/", "block"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that quotes the template's own control strings, read back."""
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    quoted = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(
        f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, {quoted} AS text "
        f"UNION ALL SELECT -7L, 1L, 'assistant', {quoted}"
    )
    digests = chat_format.chat_digests(chat_format.format_chats(rows.unionByName(extra)))
    return digests.select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_token_store(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return token_store.store_digests(documents, tokenizer_path())


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(documents, _table(spark, folder, "benchmark"))


def op5_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict for every url; the trees learn from the urls that the rules decide."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return url_templates.judge_urls(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(
        _table(spark, folder, "documents").select("doc_id", "text")
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Trained on the documents whose id hash is not held out, predicted for all."""
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.train_language_model(
        documents.where(~held_out), F.col("text"), F.col("lang"), F.col("doc_id")
    )
    texts = documents.select("doc_id", held_out.alias("held_out"), "text")
    return language_id.identify(texts, model).select("doc_id", "held_out", "lang_pred", "score")


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = source_mix.mix_plan(_table(spark, folder, "documents").select("doc_id", "text", "source"))
    return plan.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.drop_repeated_passages(
        _table(spark, folder, "documents").select("doc_id", "text")
    )
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op11_warc_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as one-stream archives, normalised to members and read back through the index."""
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    streams, archives = work_path(spark, "streams"), work_path(spark, "archives")
    warc_archive.write_monolithic(warc_archive.warc_records(pages), streams)
    warc_archive.normalise(spark, streams, archives)
    records = warc_archive.read_records(spark, archives, with_payload=False)
    return records.select(
        warc_archive.page_key(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc_archive.page_key(F.col("refers_to")).alias("refers_to"),
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """All frequent words, one letter dropped in one of 97 runs, with their near words and forms."""
    words = spelling_variants.count_words(
        _table(spark, folder, "documents"), corrupt=spelling_variants.drop_one_in(97)
    )
    return spelling_variants.group_variants(words).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All nodes of the trie of conversations that share turns within families of five."""
    key = F.col("conv_id")
    symbols = prefix_trie.turn_symbols(
        _table(spark, folder, "conversations"),
        base=key - key % 5,
        shared=F.crc32(key.cast("string")) % 9,
    )
    return prefix_trie.trie_nodes(symbols)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(ship_package(spark), folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_quality_rules, op3_token_store, op4_decontaminate, op5_url_templates,
        op6_jaccard_join, op7_language_id, op8_source_mix, op9_line_dedup, op10_substring_dedup,
        op11_warc_normalise, op12_spelling_variants, op13_prefix_trie, pipeline,
    )
}
