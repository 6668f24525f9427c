"""The registered queries of this subpackage, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from spendlink.llm import bpe, centroids, chat, decontaminate, embeddings, jaccard, lm, secrets, sharding, spelling, suffixes, toxicity, winnowing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.query,
    "op2_chat_formatting": chat.query,
    "op3_suffix_dedup": suffixes.query,
    "op4_bpe": bpe.query,
    "op5_jaccard_join": jaccard.query,
    "op6_feistel_sharding": sharding.query,
    "op7_embedding_near_dups": embeddings.query,
    "op8_lm_scoring": lm.deep_query,
    "op9_secret_scan": secrets.query,
    "op10_decontamination": decontaminate.query,
    "op11_centroid_clustering": centroids.query,
    "op12_spelling_variants": spelling.query,
    "op13_winnowing": winnowing.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op10_decontamination": decontaminate.SQL,
    "op11_centroid_clustering": centroids.SQL,
    "op12_spelling_variants": spelling.SQL,
}
