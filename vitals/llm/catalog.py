"""The queries of this subpackage, and DuckDB SQL where SQL can state them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitals.llm.bpe import op8_bpe
from vitals.llm.chat import OP7_SQL, op7_chat
from vitals.llm.decontaminate import op10_decontaminate
from vitals.llm.html_text import op3_main_text
from vitals.llm.langid import op2_language
from vitals.llm.personal import op5_personal
from vitals.llm.phrases import OP12_SQL, op12_phrases
from vitals.llm.quality import op6_quality
from vitals.llm.repair import OP11_SQL, op11_repair
from vitals.llm.rules import OP9_SQL, op9_rules
from vitals.llm.secret_scan import op4_secrets
from vitals.llm.simhash import op1_simhash
from vitals.llm.substrings import OP13_SQL, op13_substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_main_text": op3_main_text,
    "op4_secrets": op4_secrets,
    "op5_personal": op5_personal,
    "op6_quality": op6_quality,
    "op7_chat": op7_chat,
    "op8_bpe": op8_bpe,
    "op9_rules": op9_rules,
    "op10_decontaminate": op10_decontaminate,
    "op11_repair": op11_repair,
    "op12_phrases": op12_phrases,
    "op13_substrings": op13_substrings,
}

ORACLE_SQL: dict[str, str] = {
    "op7_chat": OP7_SQL,
    "op9_rules": OP9_SQL,
    "op11_repair": OP11_SQL,
    "op12_phrases": OP12_SQL,
    "op13_substrings": OP13_SQL,
}
