from tessera.functions.expressions import (
    py_strip, label_of, to_double, norm_dim, header_year, year_name,
    first_substring, map_lookup, infer_product, normalize_description,
    clean_text, tokens,
)
from tessera.functions import constants

__all__ = [
    "py_strip", "label_of", "to_double", "norm_dim", "header_year", "year_name",
    "first_substring", "map_lookup", "infer_product", "normalize_description",
    "clean_text", "tokens", "constants",
]
