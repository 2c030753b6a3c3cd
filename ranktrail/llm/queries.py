"""The registered queries of this package and their SQL."""

from __future__ import annotations

from ranktrail.llm import (
    bestfit,
    centroids,
    extraction,
    langid,
    metricjoin,
    minhash,
    mixing,
    packing,
    quality,
    revisits,
    runindex,
    spelling,
    urlfilter,
)

QUERIES = {
    "op1_pack_token_ids": packing.op1_pack_token_ids,
    "op2_pareto_mix": mixing.op2_pareto_mix,
    "op3_metric_range_join": metricjoin.op3_metric_range_join,
    "op4_main_text": extraction.op4_main_text,
    "op5_revisits": revisits.op5_revisits,
    "op6_link_graph_filter": urlfilter.op6_link_graph_filter,
    "op7_minhash_near_dedup": minhash.op7_minhash_near_dedup,
    "op8_best_fit_packing": bestfit.op8_best_fit_packing,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_run_index_dedup": runindex.op10_run_index_dedup,
    "op11_centroid_clustering": centroids.op11_centroid_clustering,
    "op12_language_id": langid.op12_language_id,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}
SQL = {
    "op2_pareto_mix": mixing.OP2_SQL,
    "op5_revisits": revisits.OP5_SQL,
    "op6_link_graph_filter": urlfilter.OP6_SQL,
    "op11_centroid_clustering": centroids.OP11_SQL,
    "op13_spelling_variants": spelling.OP13_SQL,
}
