"""Queries and SQL of this subpackage, by name."""

from vigil.llm import ann, bigrams, middle, mixing, ngram_join, packing, pii, quality, recompression, runs, secrets, topk, toxicity

QUERIES = {
    "op1_ngram_jaccard": ngram_join.op1_ngram_jaccard,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_pii_pseudonyms": pii.op3_pii_pseudonyms,
    "op4_toxicity_score": toxicity.op4_toxicity_score,
    "op5_quality_score": quality.op5_quality_score,
    "op6_exact_top_k": topk.op6_exact_top_k,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_source_mix": mixing.op8_source_mix,
    "op9_pitman_yor_score": bigrams.op9_pitman_yor_score,
    "op10_learned_partitions": ann.op10_learned_partitions,
    "op11_substring_dedup": recompression.op11_substring_dedup,
    "op12_periodic_runs": runs.op12_periodic_runs,
    "op13_fill_in_middle": middle.op13_fill_in_middle,
}
SQL = {
    "op2_secret_scan": secrets.OP2_SQL,
    "op6_exact_top_k": topk.OP6_SQL,
    "op8_source_mix": mixing.OP8_SQL,
    "op11_substring_dedup": recompression.OP11_SQL,
    "op12_periodic_runs": runs.OP12_SQL,
    "op13_fill_in_middle": middle.OP13_SQL,
}
