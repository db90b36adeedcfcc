"""The queries of this subpackage: name -> fn(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkstats.llm import (chat, decontaminate, exact_dedup, fim, html_text, line_dedup, mixing, near_dedup, periodic_runs, sharding,
                           suffix_dedup, toxicity, urls)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in [
    toxicity.op1_toxicity, suffix_dedup.op2_suffix_dedup, line_dedup.op3_line_dedup, exact_dedup.op4_exact_dedup, mixing.op5_mix_sources,
    decontaminate.op6_decontaminate,    chat.op7_chat_format, urls.op8_url_filter, html_text.op9_html_text,
    near_dedup.op10_near_dedup, sharding.op11_shard, fim.op12_fill_in_middle, periodic_runs.op13_periodic_runs,
]}

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
}
