"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.bitplanes import OP11_SQL, op11_centroid_clustering
from tillroll.llm.decontaminate import op1_decontaminate
from tillroll.llm.fingerprints import op10_document_fingerprints
from tillroll.llm.html_text import OP12_SQL, op12_html_extraction
from tillroll.llm.language_id import op8_language_id
from tillroll.llm.line_dedup import op4_line_dedup
from tillroll.llm.mixing import OP9_SQL, op9_mixing
from tillroll.llm.simhash_dedup import op2_simhash_dedup
from tillroll.llm.spelling import OP13_SQL, op13_spelling_variants
from tillroll.llm.token_counts import op7_token_counts
from tillroll.llm.toxicity import op6_toxicity
from tillroll.llm.url_filter import OP5_SQL, op5_url_filter
from tillroll.llm.warc import OP3_SQL, op3_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate,
        op2_simhash_dedup,
        op3_warc,
        op4_line_dedup,
        op5_url_filter,
        op6_toxicity,
        op7_token_counts,
        op8_language_id,
        op9_mixing,
        op10_document_fingerprints,
        op11_centroid_clustering,
        op12_html_extraction,
        op13_spelling_variants,
    )
}

ORACLE: dict[str, str] = {"op3_warc": OP3_SQL, "op5_url_filter": OP5_SQL, "op9_mixing": OP9_SQL,
                          "op11_centroid_clustering": OP11_SQL, "op12_html_extraction": OP12_SQL,
                          "op13_spelling_variants": OP13_SQL}
