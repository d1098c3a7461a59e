"""Structured Streaming forms of the incremental steps."""

from .streams import (keyword_filter_stream, dedup_stream, hourly_label_counts,  # noqa: F401
                      run_available_now, tweet_stream)
from .counts import fold_counts, read_counts, run_counts, store_counts  # noqa: F401
from .once import read_once, run_once, store_once  # noqa: F401
