"""Building blocks the plans share: pre-aggregated joins, split windows, stored intermediates."""
