"""Column -> Column expressions. All are built-in Spark functions (JVM side,
whole-stage codegen); none is a Python UDF."""

from .text import (clean_text, words, concat_text, token_upper, extract_field,  # noqa: F401
                   map_label, label_word, word_ngrams)
from .dates import epoch_ts, parse_ts, floor_hour, day_windows  # noqa: F401
from .arrays import union_tokens, generalise_tokens, any_in_range_arr, sum_arr  # noqa: F401
from .conditional import coalesce_cols, pick_better, mean_of, percentage  # noqa: F401
