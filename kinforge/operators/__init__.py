"""Set-based operators: validation, profiling, postings, passes, ranking, evaluation."""
