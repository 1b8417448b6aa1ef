"""The numbered queries by name, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm.alignment import op12_alignment
from quire.llm.chat import OP6_SQL, op6_chat_format
from quire.llm.decontaminate import OP4_SQL, op4_decontamination
from quire.llm.language import op3_language_id
from quire.llm.licences import op10_licences
from quire.llm.mixing import op7_mixing
from quire.llm.pieces import op11_pieces
from quire.llm.pii import op2_pii
from quire.llm.quality import op1_quality_classifier
from quire.llm.rules import OP5_SQL, op5_quality_rules
from quire.llm.search import OP13_SQL, op13_search
from quire.llm.simhash import op9_simhash
from quire.llm.token_counts import op8_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_pii": op2_pii,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_format": op6_chat_format,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_simhash": op9_simhash,
    "op10_licences": op10_licences,
    "op11_pieces": op11_pieces,
    "op12_alignment": op12_alignment,
    "op13_search": op13_search,
}
ORACLES: dict[str, str] = {"op4_decontamination": OP4_SQL, "op5_quality_rules": OP5_SQL, "op6_chat_format": OP6_SQL, "op13_search": OP13_SQL}
