"""Every query over training data, and the SQL of those that SQL can express.

Fingerprints of operator 5 need XXH64, operators 3, 6 and 8 need markup and vocabulary rules, 9 and 10 trained models, 11 a
shortest path by its letters, and many packings of 13 are right: these are tested against brute force, the libraries themselves, round trips and held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from countypanel.llm.byte_bpe import op8_byte_bpe
from countypanel.llm.common import share_package
from countypanel.llm.conversation_repair import op11_conversation_repair
from countypanel.llm.decontaminate import OP1_SQL, op1_decontaminate
from countypanel.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from countypanel.llm.html_text import op3_html_text
from countypanel.llm.licenses import OP7_SQL, op7_licenses
from countypanel.llm.packing import op13_packing
from countypanel.llm.quality import op10_quality
from countypanel.llm.simhash_dedup import op5_simhash_dedup
from countypanel.llm.token_counts import op6_token_counts
from countypanel.llm.topk import OP4_SQL, op4_topk
from countypanel.llm.toxicity import op9_toxicity
from countypanel.llm.url_filters import OP2_SQL, op2_url_filters


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _query(f)
    for f in (
        op1_decontaminate, op2_url_filters, op3_html_text, op4_topk, op5_simhash_dedup, op6_token_counts, op7_licenses,
        op8_byte_bpe, op9_toxicity, op10_quality, op11_conversation_repair,
        op12_hard_negatives, op13_packing,
    )
}

ORACLE_SQL = {
    "op1_decontaminate": OP1_SQL, "op2_url_filters": OP2_SQL, "op4_topk": OP4_SQL, "op7_licenses": OP7_SQL,
    "op12_hard_negatives": OP12_SQL,
}
