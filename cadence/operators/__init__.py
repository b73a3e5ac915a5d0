"""Relational building blocks: bounded broadcasts, hop windows, thresholds,
first-event flags, key dedup (insert-if-absent / replace), dims and conform."""
