"""Registered queries of this package, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labormart.llm.conversation_repair import repair_query
from labormart.llm.decontaminate import decontaminate_query
from labormart.llm.hard_negatives import ORACLE as NEGATIVES_SQL
from labormart.llm.hard_negatives import negatives_query
from labormart.llm.minhash import minhash_query
from labormart.llm.oracle import SUBSTRING, jaccard_groups
from labormart.llm.packing import packing_query
from labormart.llm.quality import quality_query
from labormart.llm.rules import rules_query
from labormart.llm.secret_scan import secrets_query
from labormart.llm.set_join import set_join_query
from labormart.llm.substring_dedup import substring_query
from labormart.llm.suffix_dedup import suffix_query
from labormart.llm.tokens import token_counts_query
from labormart.llm.toxicity import toxicity_query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": quality_query,
    "op2_packing": packing_query,
    "op3_secret_scan": secrets_query,
    "op4_minhash_dedup": minhash_query,
    "op5_quality_rules": rules_query,
    "op6_token_counts": token_counts_query,
    "op7_toxicity": toxicity_query,
    "op8_substring_dedup": substring_query,
    "op9_suffix_array_dedup": suffix_query,
    "op10_decontamination": decontaminate_query,
    "op11_conversation_repair": repair_query,
    "op12_hard_negatives": negatives_query,
    "op13_set_join": set_join_query,
}
#: DuckDB forms. The other operators are tested against brute force (tests/llm).
ORACLE: dict[str, str] = {
    "op4_minhash_dedup": jaccard_groups(3, 85, kept=True),
    "op8_substring_dedup": SUBSTRING,
    "op12_hard_negatives": NEGATIVES_SQL,
    "op13_set_join": jaccard_groups(4, 85, kept=False),
}
