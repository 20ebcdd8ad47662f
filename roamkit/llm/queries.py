"""One query per operator of this package, over its whole table, and the SQL where there is any."""

from __future__ import annotations

import public_tokenizers

from roamkit.llm import bpe, ffd, merkle, neardup, oracles, packing, quality, search, secret_scan, sharding, toxicity, treap, warc, wavelet
from roamkit.llm.shared import documents_of

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"

QUERIES = {
    "op1_secret_forest": lambda spark, d: secret_scan.op1(documents_of(spark, d)),
    "op2_warc_capture_index": lambda spark, d: warc.op2(documents_of(spark, d, "pages")),
    "op3_wavelet_tokens": lambda spark, d: wavelet.op3(documents_of(spark, d), public_tokenizers.path(WORD_VOCABULARY)),
    "op4_forced_boundary_bpe": lambda spark, d: bpe.op4(documents_of(spark, d), public_tokenizers.path(WORD_VOCABULARY)),
    "op5_histogram_packing": lambda spark, d: packing.op5(documents_of(spark, d), public_tokenizers.path(BYTE_VOCABULARY)),
    "op6_toxicity_machine": lambda spark, d: toxicity.op6(documents_of(spark, d), documents_of(spark, d, "labels")),
    "op7_bm25_topk": lambda spark, d: search.op7(documents_of(spark, d)),
    "op8_virtual_slots": lambda spark, d: sharding.op8(documents_of(spark, d)),
    "op9_quality_mcd": lambda spark, d: quality.op9(documents_of(spark, d)),
    "op10_prob_minhash": lambda spark, d: neardup.op10(documents_of(spark, d)),
    "op11_treap_search": lambda spark, d: treap.op11(documents_of(spark, d), documents_of(spark, d, "benchmark")),
    "op12_tournament_packing": lambda spark, d: ffd.op12(documents_of(spark, d), public_tokenizers.path(BYTE_VOCABULARY)),
    "op13_merkle_climb": lambda spark, d: merkle.op13(documents_of(spark, d)),
}

ORACLES = {
    "op2_warc_capture_index": """
        with payload as (select page_id, coalesce(html, '') as body from pages),
        sized as (select page_id, strlen(body) as payload_bytes, sha256(body) as payload_digest, min(page_id) over (partition by body) as first from payload)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and page_id > first then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 100 and page_id > first then first end as refers_to
        from sized""",
    "op7_bm25_topk": oracles.bm25_topk(),
    "op11_treap_search": oracles.ranked_search(),
    "op13_merkle_climb": oracles.merkle(),
}
