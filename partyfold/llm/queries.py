"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, cotraining, html_text, jaccard_join, language, line_dedup, mixing, nearest, periodic_runs,
               quality_rules, secrets, url_filter, whitening)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_cotraining": cotraining.query,
        "op2_quality_rules": quality_rules.query,
        "op3_source_mix": mixing.query,
        "op4_secret_scan": secrets.query,
        "op5_html_text": html_text.query,
        "op6_byte_bpe": bpe.query,
        "op7_jaccard_join": jaccard_join.query,
        "op8_nearest_neighbours": nearest.query,
        "op9_language_id": language.query,
        "op10_line_dedup": line_dedup.query,
        "op11_periodic_runs": periodic_runs.query,
        "op12_whitening": whitening.query,
        "op13_url_filter": url_filter.query,
    }


def oracle_queries() -> dict[str, str]:
    return {"op3_source_mix": mixing.SQL, "op7_jaccard_join": jaccard_join.SQL,
            "op13_url_filter": url_filter.SQL}
