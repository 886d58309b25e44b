"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from trendengine.llm import (
    centroids,
    chat,
    decontaminate,
    hard_negatives,
    langid,
    licenses,
    mixing,
    secret_scan,
    sentencepiece_fst,
    simhash,
    url_filter,
    vector_graph,
    warc,
)

QUERIES = {
    "op1_simhash": simhash.query,
    "op2_decontaminate": decontaminate.query,
    "op3_secrets": secret_scan.query,
    "op4_sentencepiece": sentencepiece_fst.query,
    "op5_warc": warc.query,
    "op6_embeddings": vector_graph.query,
    "op7_chat": chat.query,
    "op8_urls": url_filter.query,
    "op9_language": langid.query,
    "op10_licenses": licenses.query,
    "op11_centroids": centroids.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_mixing": mixing.query,
}

ORACLE = {
    "op2_decontaminate": decontaminate.SQL,
    "op5_warc": warc.SQL,
    "op7_chat": chat.SQL,
    "op8_urls": url_filter.SQL,
    "op11_centroids": centroids.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_mixing": mixing.SQL,
}
