from .aggregates import (bitmask_of, bits_set, carry, completeness_pct, count_distinct_if, count_distinct_when, outside_mask,
                         count_if, percentiles, sum_if, unmapped_total, value_counts, weighted_total)
from .bitmaps import bitmap_words, count_words, mark_present, merge_words
from .dedup import conflict_ledger, first_wins, insert_ignore, insert_with_conflicts, table_after_insert, upsert
from .joins import disjoint_ranges, enrich, label_by_ranges, left_join_on, maybe_broadcast, share_of_total
from .quality import (check_balanced, check_not_null, check_unique, duplicate_keys, null_key_rows,
                      out_of_range, profile_series, smoke_profile)
from .reshape import (drop_incomplete, ensure_columns, head_rows, normalise_headers, ordered, period_columns,
                      pivot_periods, register_view, rename_present, select_present, union_all, unpivot_periods)
from .windows import blocked_windows, days_since_last, lead_columns, rolling_count_if, rolling_sum, trailing, trailing_days

__all__ = [
    "bitmap_words", "count_words", "mark_present", "merge_words", "blocked_windows", "disjoint_ranges", "label_by_ranges", "smoke_profile",
    "bitmask_of", "bits_set", "value_counts", "carry", "completeness_pct", "count_distinct_if", "count_distinct_when", "count_if", "percentiles",
    "sum_if", "unmapped_total", "weighted_total", "conflict_ledger", "first_wins", "insert_ignore", "insert_with_conflicts", "table_after_insert",
    "upsert", "enrich", "left_join_on", "maybe_broadcast", "share_of_total",
    "check_balanced", "check_not_null", "check_unique", "duplicate_keys", "null_key_rows",
    "out_of_range", "profile_series", "drop_incomplete", "head_rows", "ordered", "register_view", "ensure_columns", "normalise_headers", "period_columns",
    "pivot_periods", "rename_present", "select_present", "union_all", "unpivot_periods",
    "days_since_last", "lead_columns", "rolling_count_if", "rolling_sum", "trailing", "trailing_days",
]
