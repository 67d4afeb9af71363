"""The queries of this package's operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablegrade.llm.conversations import op11_conversation_repair
from tablegrade.llm.decontamination import op5_benchmark_decontamination
from tablegrade.llm.html_text import op8_html_extraction
from tablegrade.llm.language import op6_language_id
from tablegrade.llm.licenses import op7_license_scans
from tablegrade.llm.lsh_forest import op3_ngram_jaccard_join
from tablegrade.llm.packing import op10_packing
from tablegrade.llm.quality import op4_quality_rules
from tablegrade.llm.runs import op13_periodic_runs
from tablegrade.llm.sharding import op9_sharding
from tablegrade.llm.token_files import op12_token_files
from tablegrade.llm.toxicity import op2_toxicity
from tablegrade.llm.urls import OP1_SQL, op1_url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_url_filters,
        op2_toxicity,
        op3_ngram_jaccard_join,
        op4_quality_rules,
        op5_benchmark_decontamination,
        op6_language_id,
        op7_license_scans,
        op8_html_extraction,
        op9_sharding,
        op10_packing,
        op11_conversation_repair,
        op12_token_files,
        op13_periodic_runs,
    )
}

ORACLE: dict[str, str] = {"op1_url_filters": OP1_SQL}
