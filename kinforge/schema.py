"""Columns, evidence bits and settings of record linkage."""

from __future__ import annotations

from dataclasses import dataclass, field

INPUT_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TEXT_COLUMNS = INPUT_COLUMNS[1:]
NORMALIZED_COLUMNS = [f"{c}_normalized" for c in TEXT_COLUMNS]
FLAG_COLUMNS = [f"{c}_is_missing" for c in TEXT_COLUMNS]
OUTPUT_COLUMNS = INPUT_COLUMNS + NORMALIZED_COLUMNS + FLAG_COLUMNS

# The bits of the provenance mask, by pass.
PROVENANCE = {
    "exact_name": 1,
    "rare_name_token": 2,
    "address_token": 4,
    "address_number_location": 8,
    "compact_char_ngram": 16,
    "missing_country_fallback": 32,
    "cross_country_high_specificity": 64,
}

# Words that never tell companies apart.
LEGAL_STOPLIST = "inc incorporated corp corporation ltd limited llc llp pvt private gmbh sa srl co company".split()

# Words that never tell addresses apart.
ADDRESS_STOPLIST = (
    "st street rd road ave avenue dr drive lane ln blvd boulevard way ct court cir circle hwy highway pkwy parkway "
    "pl place suite ste apt apartment unit floor fl bldg building no nr near opp opposite behind"
).split()

# Words that say nothing beside a house number.
STRUCTURAL_NOISE = "no nr apt suite ste floor fl unit bldg".split()


@dataclass(frozen=True)
class BlockingConfig:
    """Thresholds of the blocking passes; document frequencies are the lesser of an absolute and a relative bound."""

    max_name_df_absolute: int = 10_000
    max_name_df_relative: float = 0.003
    max_addr_df_absolute: int = 5_000
    max_addr_df_relative: float = 0.002
    max_ngram_df_absolute: int = 5_000
    max_ngram_df_relative: float = 0.002
    min_token_length: int = 2
    min_addr_token_length: int = 2
    ngram_size: int = 4
    min_ngram_length: int = 3
    max_block_size: int = 1_000
    max_candidates_per_source: int = 1_000
    allow_missing_country_fallback: bool = True
    allow_cross_country_high_specificity: bool = True
    cross_country_min_rare_tokens: int = 2
    holdout_ratio: float = 0.05
    holdout_salt: str = "val_salt"
    legal_stoplist: list[str] = field(default_factory=lambda: list(LEGAL_STOPLIST))
    address_stoplist: list[str] = field(default_factory=lambda: list(ADDRESS_STOPLIST))

    def max_df(self, family: str, total: int) -> int:
        """The most records that a key may have among ``total`` before it is filtered. The floor is five."""
        absolute, relative = {
            "name": (self.max_name_df_absolute, self.max_name_df_relative),
            "addr": (self.max_addr_df_absolute, self.max_addr_df_relative),
            "num_loc": (self.max_addr_df_absolute, self.max_addr_df_relative),
            "ngram": (self.max_ngram_df_absolute, self.max_ngram_df_relative),
        }[family]
        return min(absolute, max(5, int(total * relative)))


class StructuralIntegrityError(Exception):
    """A raw file breaks the format at a line."""

    def __init__(self, path: str, line_number: int, reason: str):
        super().__init__(f"{path}, line {line_number}: {reason}")
        self.path, self.line_number, self.reason = path, line_number, reason


class QualityCheckError(Exception):
    """A cleaned file breaks an invariant."""


class PublicationTransactionError(Exception):
    """The publication failed; what was published before has been restored."""
