"""Column functions: text, dates, vectors and reproducible random numbers."""

from lexloom.functions.parsing import parse_date, parse_year, period_number
from lexloom.functions.randomness import bucket, poisson_copies
from lexloom.functions.text import (
    clean_tokens,
    join_tokens,
    rule_tokenise,
    shrink,
    split_tokens,
    token_rules,
    tokenise,
    without_words,
)
from lexloom.functions.vectors import (
    cosine_distance,
    cosine_similarity,
    dot,
    euclidean_distance,
    norm,
    to_vector,
)

__all__ = [
    "bucket",
    "clean_tokens",
    "cosine_distance",
    "cosine_similarity",
    "dot",
    "euclidean_distance",
    "join_tokens",
    "norm",
    "parse_date",
    "parse_year",
    "period_number",
    "poisson_copies",
    "rule_tokenise",
    "shrink",
    "split_tokens",
    "to_vector",
    "token_rules",
    "tokenise",
    "without_words",
]
