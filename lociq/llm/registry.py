"""The registered queries of the llm operators: each applies one operator to its whole table."""

from __future__ import annotations

from lociq.llm.common import table
from lociq.llm.oracles import ORACLE_SQL


def op9_minhash_near_dedup(spark, sf_dir):
    from lociq.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op1_suffix_array_dedup(spark, sf_dir):
    from lociq.llm.suffix import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark, sf_dir):
    from lociq.llm import packing, tokens

    return packing.pack(table(spark, sf_dir, "documents"), tokens.path("byte_bpe_50k.json"))


def op3_token_binary_output(spark, sf_dir):
    from lociq.llm import binary, tokens

    return binary.read_tokens(*binary.write_tokens(table(spark, sf_dir, "documents"), tokens.path("word_bpe_49k.json")))


def op4_toxicity(spark, sf_dir):
    from lociq.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_embedding_near_dedup(spark, sf_dir):
    from lociq.llm.embeddings import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_decontamination(spark, sf_dir):
    from lociq.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark, sf_dir):
    from lociq.llm import secrets

    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans")


def op8_warc_index_merge(spark, sf_dir):
    from lociq.llm import warc

    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_html_extraction(spark, sf_dir):
    from lociq.llm.html import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark, sf_dir):
    from lociq.llm import conversations

    return conversations.digests(conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations"))))


def op12_spelling_variants(spark, sf_dir):
    from lociq.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark, sf_dir):
    from lociq.llm.lines import dropped_lines

    return dropped_lines(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_token_binary_output": op3_token_binary_output,
        "op4_toxicity": op4_toxicity,
        "op5_embedding_near_dedup": op5_embedding_near_dedup,
        "op6_decontamination": op6_decontamination,
        "op7_secret_scan": op7_secret_scan,
        "op8_warc_index_merge": op8_warc_index_merge,
        "op9_minhash_near_dedup": op9_minhash_near_dedup,
        "op10_html_extraction": op10_html_extraction,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
