"""The queries of this subpackage, with DuckDB SQL where SQL can express them."""

from . import byte_pairs, decontaminate, hard_negatives, language_id, licenses, line_quality, mixing, near_duplicates, neighbours, periodic_runs, personal_data, toxicity, url_rules

QUERIES = {
    "op1_line_quality": line_quality.op1_line_quality,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_language_id": language_id.op4_language_id,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_nearest_neighbours": neighbours.op7_nearest_neighbours,
    "op8_personal_data": personal_data.op8_personal_data,
    "op9_near_duplicates": near_duplicates.op9_near_duplicates,
    "op10_url_filter": url_rules.op10_url_filter,
    "op11_byte_pairs": byte_pairs.op11_byte_pairs,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES = {
    "op2_mix_sources": mixing.SQL,
    "op9_near_duplicates": near_duplicates.SQL,
    "op10_url_filter": url_rules.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
