"""tidemark: clickstream analytics and event detection on Spark.

Batch jobs are DataFrame compositions (``tidemark.plans.jobs``); the same
operators run on streams in ``tidemark.streaming``. The most used entry
points are re-exported here.
"""

from .operators.aggregates import bitmap_distinct_count, distinct_count
from .operators.detect import click_cap, fail_bursts, fail_pairs, fail_sequences, match_sequence
from .operators.late import accepted_window_counts, route_late
from .operators.ordered import with_neighbors
from .operators.topn import top_n_per_window, top_n_report
from .operators.windows import sliding_count, sliding_from_panes, tumbling_count
from .session import build_session, scale_settings

__version__ = "0.1.0"

__all__ = [
    "accepted_window_counts", "bitmap_distinct_count", "build_session", "click_cap",
    "distinct_count", "fail_bursts", "fail_pairs", "fail_sequences", "match_sequence",
    "route_late", "scale_settings", "sliding_count", "sliding_from_panes", "top_n_per_window",
    "top_n_report", "tumbling_count", "with_neighbors",
]
