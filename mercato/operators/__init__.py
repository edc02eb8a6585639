"""Reusable relational operators built from DataFrame primitives."""

from mercato.operators.dedupe import keep_first, top1_by_count, top_n_per_group, minmax_over, mode_of_counts  # noqa: F401
from mercato.operators.stats import (global_row, with_global, histogram, value_counts, describe,  # noqa: F401
                                     profile, layer_overview, quantiles, roc_auc)
from mercato.operators.pairs import pairs_within  # noqa: F401
from mercato.operators.indexing import dense_index  # noqa: F401
