"""Queries and SQL of this subpackage, for the entry module."""

from __future__ import annotations

import corpus_pipeline

from . import centroids, decontaminate, jaccard, licenses, mixing, neighbors, quality, repeats, search, secrets, tokens, toxicity, warc


def queries() -> dict:
    return {
        "op1_quality": quality.op1_quality,
        "op2_license_scan": licenses.op2_license_scan,
        "op3_decontaminate": decontaminate.op3_decontaminate,
        "op4_near_documents": jaccard.op4_near_documents,
        "op5_near_vectors": neighbors.op5_near_vectors,
        "op6_warc": warc.op6_warc,
        "op7_secret_scan": secrets.op7_secret_scan,
        "op8_token_counts": tokens.op8_token_counts,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_source_mix": mixing.op10_source_mix,
        "op11_centroids": centroids.op11_centroids,
        "op12_repeats": repeats.op12_repeats,
        "op13_search": search.op13_search,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontaminate": decontaminate.OP3_SQL, "op4_near_documents": jaccard.OP4_SQL, "op5_near_vectors": neighbors.OP5_SQL, "op6_warc": warc.OP6_SQL,
        "op11_centroids": centroids.OP11_SQL, "op12_repeats": repeats.OP12_SQL, "op13_search": search.OP13_SQL,
    }
