"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peopleflow.llm.bpe import op1_bpe_round_trip
from peopleflow.llm.divergence import OP13_SQL, op13_source_divergence
from peopleflow.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from peopleflow.llm.minhash import OP5_SQL, op5_minhash_near_dedup
from peopleflow.llm.packing import op6_best_fit_packing
from peopleflow.llm.phrases import OP11_SQL, op11_phrase_collocations
from peopleflow.llm.quality import OP9_SQL, op9_quality_rules
from peopleflow.llm.repeats import op8_repeated_strings
from peopleflow.llm.secret_scan import op4_secret_scan
from peopleflow.llm.simhash import op12_simhash_near_dedup
from peopleflow.llm.token_counts import op2_token_counts
from peopleflow.llm.toxicity import op10_toxicity
from peopleflow.llm.url_filter import op7_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_round_trip,
        op2_token_counts,
        op3_exact_dedup,
        op4_secret_scan,
        op5_minhash_near_dedup,
        op6_best_fit_packing,
        op7_url_filter,
        op8_repeated_strings,
        op9_quality_rules,
        op10_toxicity,
        op11_phrase_collocations,
        op12_simhash_near_dedup,
        op13_source_divergence,
    )
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op5_minhash_near_dedup": OP5_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op13_source_divergence": OP13_SQL,
}
