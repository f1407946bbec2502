"""Reusable table operators: latest record, merges, skew-safe joins, exact order statistics,
profiles, dimension lists and therapeutic areas."""
