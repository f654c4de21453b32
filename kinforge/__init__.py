"""Spark-native record linkage: cleaning, blocking, ranking and evaluation of entity records.

Names are loaded when they are first used, so that Python workers import only what they run.
"""

from importlib import import_module

_HOME = {
    "operators.checker": ["validate"],
    "operators.cleaning": ["check_invariants", "clean", "expected_prefix", "validate_input_file", "verify_file_quality"],
    "operators.evaluation": ["in_holdout", "macro_f05", "recall"],
    "operators.ranking": ["export", "rank"],
    "operators.store": ["CandidateStore"],
    "streaming.matching": ["stream_candidates"],
    "plans.blocking": ["Blocking", "CandidateIndex", "candidates_for"],
    "plans.cleaning": ["clean_and_profile_file", "run_cleaning_pipeline"],
    "plans.linkage": ["run_blocking_pipeline", "run_cap_sweep"],
    "schema": ["PROVENANCE", "BlockingConfig", "PublicationTransactionError", "QualityCheckError", "StructuralIntegrityError"],
}
_MODULE = {name: module for module, names in _HOME.items() for name in names}
__all__ = sorted(_MODULE)


def __getattr__(name: str):
    if name not in _MODULE:
        raise AttributeError(name)
    return getattr(import_module(f"{__name__}.{_MODULE[name]}"), name)
