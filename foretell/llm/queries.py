"""The registered queries of this subpackage and the SQL that must give their rows."""

from __future__ import annotations

import corpus_pipeline
from foretell.llm import ann, bpe, collocations, fingerprints, html_text, mixing, neardup, prefix_trie, secret_scan, sharding, substring_dedup, toxicity, url_filters
from foretell.llm.common import load


def op1_url_filters(spark, folder):
    return url_filters.judge(load(spark, folder, "pages").select("page_id", "url"), url_filters.rules_frame(spark)).select(
        "page_id", "host", "path", "rule", "verdict")


def op4_mixing(spark, folder):
    return mixing.mixed(load(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_nearest_neighbours(spark, folder):
    return ann.search(load(spark, folder, "embeddings"))


def op3_fingerprints(spark, folder):
    return fingerprints.with_next(load(spark, folder, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op5_byte_bpe(spark, folder):
    return bpe.digests(load(spark, folder, "documents"))


def op6_toxicity(spark, folder):
    docs = load(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, load(spark, folder, "labels")))


def op7_html_text(spark, folder):
    return html_text.extracted(load(spark, folder, "pages"))


def op8_minhash_dedup(spark, folder):
    return neardup.linked(load(spark, folder, "documents"))


def op9_secret_scan(spark, folder):
    return secret_scan.scanned(load(spark, folder, "documents"))


def op10_sharding(spark, folder):
    return sharding.sharded(load(spark, folder, "documents"))


def op11_collocations(spark, folder):
    return collocations.mined(load(spark, folder, "documents"))


def op12_prefix_trie(spark, folder):
    return prefix_trie.trie(load(spark, folder, "conversations"))


def op13_substring_dedup(spark, folder):
    return substring_dedup.digests(load(spark, folder, "documents"))


def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_nearest_neighbours, op3_fingerprints, op4_mixing, op5_byte_bpe, op6_toxicity, op7_html_text,
    op8_minhash_dedup, op9_secret_scan, op10_sharding, op11_collocations, op12_prefix_trie, op13_substring_dedup, pipeline,
)}
ORACLE_SQL = {"op1_url_filters": url_filters.oracle(), "op11_collocations": collocations.oracle(),
              "op12_prefix_trie": prefix_trie.oracle(), "op13_substring_dedup": substring_dedup.oracle()}
