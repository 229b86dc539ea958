"""Relational operators: predicates, aggregates, ordering and deduplication as DataFrame expressions."""
