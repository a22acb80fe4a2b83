"""The registered queries of the text operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabscope.llm.collocations import OP13_SQL, op13_collocations
from tabscope.llm.decontaminate import OP4_SQL, op4_decontaminate
from tabscope.llm.html_text import op3_html_text
from tabscope.llm.knn_join import OP6_SQL, op6_knn_join
from tabscope.llm.language_model import op1_language_model
from tabscope.llm.near_duplicates import OP8_SQL, op8_near_duplicates
from tabscope.llm.packing import op10_packing
from tabscope.llm.periodic_runs import op11_periodic_runs
from tabscope.llm.quality import op9_quality
from tabscope.llm.repeats import op7_repeats
from tabscope.llm.simhash import op12_simhash
from tabscope.llm.token_counts import op2_token_counts
from tabscope.llm.token_files import op5_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_model": op1_language_model,
    "op2_token_counts": op2_token_counts,
    "op3_html_text": op3_html_text,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_files": op5_token_files,
    "op6_knn_join": op6_knn_join,
    "op7_repeats": op7_repeats,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_simhash": op12_simhash,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op4_decontaminate": OP4_SQL,
    "op6_knn_join": OP6_SQL,
    "op8_near_duplicates": OP8_SQL,
    "op13_collocations": OP13_SQL,
}
