"""Whole plans: the cleaning pipeline, the blocking pipeline, the cap sweep, the registered queries."""
