"""Registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stresslake.llm.common import prepare
from stresslake.llm.conversation_repair import op13_conversation_repair
from stresslake.llm.embedding_dedup import OP10_SQL, op10_embedding_dedup
from stresslake.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from stresslake.llm.knn import OP5_SQL, op5_topk
from stresslake.llm.language import op6_language
from stresslake.llm.licenses import op8_licenses
from stresslake.llm.line_dedup import OP11_SQL, op11_line_dedup
from stresslake.llm.mixing import OP1_SQL, op1_mixing
from stresslake.llm.pieces import op7_pieces
from stresslake.llm.secrets import op9_secrets
from stresslake.llm.simhash import op3_simhash
from stresslake.llm.tokens import op4_token_counts
from stresslake.llm.toxicity import op2_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _ready(query)
    for query in (
        op1_mixing, op2_toxicity, op3_simhash, op4_token_counts, op5_topk, op6_language,
        op7_pieces, op8_licenses, op9_secrets, op10_embedding_dedup, op11_line_dedup,
        op12_hard_negatives, op13_conversation_repair,
    )
}
ORACLE: dict[str, str] = {
    "op1_mixing": OP1_SQL, "op5_topk": OP5_SQL, "op10_embedding_dedup": OP10_SQL,
    "op11_line_dedup": OP11_SQL, "op12_hard_negatives": OP12_SQL,
}
