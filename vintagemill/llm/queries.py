"""The queries of this subpackage and, where SQL can say it, the same results as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op6_byte_bpe
from .cosine import OP9_SQL, op9_sign_hashing
from .dialogue import OP12_SQL, op12_auction_repair
from .hyperminhash import OP1_SQL, op1_hyperminhash
from .mixing import OP7_SQL, op7_curriculum_mix
from .passages import op10_compact_windows
from .periodic import op13_periodic_runs
from .pii import op2_bilstm_pii
from .quality_model import op8_subword_quality
from .quality_rules import op4_token_fertility
from .unigram import op3_viterbi_counts
from .url_filter import op5_url_trees
from .versions import OP11_SQL, op11_lookup_sketch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_hyperminhash,
        op2_bilstm_pii,
        op3_viterbi_counts,
        op4_token_fertility,
        op5_url_trees,
        op6_byte_bpe,
        op7_curriculum_mix,
        op8_subword_quality,
        op9_sign_hashing,
        op10_compact_windows,
        op11_lookup_sketch,
        op12_auction_repair,
        op13_periodic_runs,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_hyperminhash": OP1_SQL,
    "op7_curriculum_mix": OP7_SQL,
    "op9_sign_hashing": OP9_SQL,
    "op11_lookup_sketch": OP11_SQL,
    "op12_auction_repair": OP12_SQL,
}
