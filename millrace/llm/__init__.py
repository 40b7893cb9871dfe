"""Operators of a training-data pipeline: fingerprints, filters, classifiers, deduplication, mixing.

Each module holds one operator with its registered query.  Nothing outside
this folder imports it.  Tasks import these modules, so executors need the
package on their Python path.
"""

from . import (  # noqa: F401
    op1_winnowing, op2_url_rules, op3_toxicity, op4_pfair_mix, op5_secret_ledger, op6_token_groups, op7_cotraining,
    op8_language, op9_spaced_seeds, op10_suffix_blocks, op11_phrases, op12_merkle,
    op13_line_index,
)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
