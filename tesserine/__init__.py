"""Cohort evaluation on Spark: endpoints, splits, roll-ups, metrics and comparisons as DataFrame plans."""
