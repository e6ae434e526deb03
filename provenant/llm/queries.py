"""The queries of this folder and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provenant.llm import oracles
from provenant.llm.byte_bpe import op5_byte_bpe
from provenant.llm.decontaminate import op8_decontaminate
from provenant.llm.fingerprints import op12_fingerprints
from provenant.llm.importance import op11_importance
from provenant.llm.license_scan import op3_license_scan
from provenant.llm.minhash import op7_minhash
from provenant.llm.passages import op1_passages
from provenant.llm.pii import op6_pii
from provenant.llm.quality_rules import op4_quality_rules
from provenant.llm.sharding import op9_sharding
from provenant.llm.suffix_dedup import op2_suffix_dedup
from provenant.llm.token_counts import op10_token_counts
from provenant.llm.variants import op13_variants

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_passages": op1_passages,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_license_scan": op3_license_scan,
        "op4_quality_rules": op4_quality_rules,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_pii": op6_pii,
        "op7_minhash": op7_minhash,
        "op8_decontaminate": op8_decontaminate,
        "op9_sharding": op9_sharding,
        "op10_token_counts": op10_token_counts,
        "op11_importance": op11_importance,
        "op12_fingerprints": op12_fingerprints,
        "op13_variants": op13_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_importance": oracles.IMPORTANCE, "op13_variants": oracles.VARIANTS}
