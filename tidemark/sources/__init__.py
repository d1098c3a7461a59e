"""Readers and writers of the landed formats."""

from .readers import (read_csv, read_tweets, read_metrics, read_price_histories, read_price_history,  # noqa: F401
                      read_table, spread)
from .writers import (write_table, write_by_token, append_new, write_partitions,  # noqa: F401
                      write_predictions)
