"""The subpackage's registered queries and their DuckDB equivalents.

A query without SQL is tested against a brute-force version or held-out accuracy.
"""

from __future__ import annotations

from marketlake.llm.decontamination import OP1_SQL, op1_decontamination
from marketlake.llm.embedding_dedup import OP9_SQL, op9_embedding_dedup
from marketlake.llm.embedding_whitening import op11_embedding_whitening
from marketlake.llm.importance_resampling import OP12_SQL, op12_importance_resampling
from marketlake.llm.language_id import op7_language_id
from marketlake.llm.license_scan import op8_license_scan
from marketlake.llm.mixing import op3_source_mixing
from marketlake.llm.quality_gam import op4_quality_classifier
from marketlake.llm.secret_scan import op6_secret_scan
from marketlake.llm.simhash_dedup import op5_simhash_dedup
from marketlake.llm.substring_dedup import OP2_SQL, op2_substring_dedup
from marketlake.llm.toxicity_gru import op13_toxicity
from marketlake.llm.warc import OP10_SQL, op10_warc

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_license_scan": op8_license_scan,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_warc": op10_warc,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_toxicity": op13_toxicity,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op2_substring_dedup": OP2_SQL,
    "op9_embedding_dedup": OP9_SQL,
    "op10_warc": OP10_SQL,
    "op12_importance_resampling": OP12_SQL,
}
