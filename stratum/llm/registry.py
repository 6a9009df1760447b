"""Queries of this package and their SQL statements."""

from __future__ import annotations

from stratum.llm.bpe import op4_bpe
from stratum.llm.fill_in_middle import OP13_SQL, op13_fill_in_middle
from stratum.llm.fingerprints import op9_fingerprints
from stratum.llm.language_id import op11_language_id
from stratum.llm.language_model import op5_lm_scoring
from stratum.llm.neighbours import op3_nearest_neighbours
from stratum.llm.packing import op2_best_fit_packing
from stratum.llm.quality import op1_quality_classifier
from stratum.llm.runs import op12_periodic_runs
from stratum.llm.simhash import op8_simhash_near_dedup
from stratum.llm.token_counts import op7_token_counts
from stratum.llm.toxicity import op6_toxicity
from stratum.llm.url_filters import OP10_SQL, op10_url_filters

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_bpe": op4_bpe,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_url_filters": op10_url_filters,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: DuckDB statements; the other queries are tested against brute force.
SQL: dict[str, str] = {"op10_url_filters": OP10_SQL, "op13_fill_in_middle": OP13_SQL}
