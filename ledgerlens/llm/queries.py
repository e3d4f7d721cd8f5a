"""Queries of the operators and their SQL counterparts."""

from __future__ import annotations

from ledgerlens.llm import (
    bpe,
    centroids,
    collocations,
    fingerprints,
    jaccard,
    language,
    mixing,
    passages,
    personal,
    quality,
    sharding,
    vptree,
    warc,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_jaccard": jaccard.op2_jaccard,
    "op3_passages": passages.op3_passages,
    "op4_quality": quality.op4_quality,
    "op5_language": language.op5_language,
    "op6_warc": warc.op6_warc,
    "op7_nearest": vptree.op7_nearest,
    "op8_bpe": bpe.op8_bpe,
    "op9_personal": personal.op9_personal,
    "op10_sharding": sharding.op10_sharding,
    "op11_fingerprints": fingerprints.op11_fingerprints,
    "op12_centroids": centroids.op12_centroids,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op1_mixing": mixing.OP1_SQL,
    "op2_jaccard": jaccard.OP2_SQL,
    "op6_warc": warc.OP6_SQL,
    "op7_nearest": vptree.OP7_SQL,
    "op12_centroids": centroids.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
