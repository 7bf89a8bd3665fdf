"""One query per operator and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotewell.llm.bpe import op4_bpe
from quotewell.llm.decontaminate import OP13_SQL, op13_decontaminate
from quotewell.llm.itq import op7_embedding_near_dedup
from quotewell.llm.jaccard import op5_ngram_jaccard
from quotewell.llm.langid import op9_language_id
from quotewell.llm.licenses import OP6_SQL, op6_license_scan
from quotewell.llm.lines import OP8_SQL, op8_line_dedup
from quotewell.llm.merkle import OP11_SQL, op11_merkle_manifest
from quotewell.llm.mixing import OP3_SQL, op3_mixing
from quotewell.llm.mtree import op2_top_k
from quotewell.llm.quality import op1_quality
from quotewell.llm.token_files import op10_token_counts
from quotewell.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_top_k": op2_top_k,
    "op3_mixing": op3_mixing,
    "op4_bpe": op4_bpe,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_license_scan": op6_license_scan,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_whitening": op12_whitening,
    "op13_decontaminate": op13_decontaminate,
}

SQL: dict[str, str] = {"op3_mixing": OP3_SQL, "op6_license_scan": OP6_SQL, "op8_line_dedup": OP8_SQL, "op11_merkle_manifest": OP11_SQL, "op13_decontaminate": OP13_SQL}
