"""Registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.chat import op6_chat
from lodestone.llm.conversation_repair import OP13_SQL, op13_conversation_repair
from lodestone.llm.embedding_dedup import op8_embedding
from lodestone.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from lodestone.llm.langid import op2_language
from lodestone.llm.line_dedup import op5_line_dedup
from lodestone.llm.mixing import OP7_SQL, op7_mixing
from lodestone.llm.nearest import op12_nearest
from lodestone.llm.packing import op10_packing
from lodestone.llm.ranked_search import OP11_SQL, op11_ranked_search
from lodestone.llm.simhash import op1_simhash
from lodestone.llm.token_files import op9_token_files
from lodestone.llm.toxicity import op3_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_chat": op6_chat,
    "op7_mixing": op7_mixing,
    "op8_embedding": op8_embedding,
    "op9_token_files": op9_token_files,
    "op10_packing": op10_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_nearest": op12_nearest,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": OP4_SQL,
    "op7_mixing": OP7_SQL,
    "op11_ranked_search": OP11_SQL,
    "op13_conversation_repair": OP13_SQL,
}
