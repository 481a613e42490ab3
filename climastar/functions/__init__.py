"""Column expressions.  All of them are built-in Spark expressions, so they
stay inside whole-stage code generation; the one Python twin
(``hemisphere_pandas``) exists only to cross-check the native form."""

from climastar.functions.casts import (
    to_decimal, to_double, to_float, to_int, to_long, to_text, tolerant_cast,
)
from climastar.functions.keys import monotonic_key, stable_key
from climastar.functions.parsing import (
    date_month, date_year, hemisphere_coordinate, split_part,
)

__all__ = [
    "to_decimal", "to_double", "to_float", "to_int", "to_long", "to_text",
    "tolerant_cast", "monotonic_key", "stable_key", "date_month", "date_year",
    "hemisphere_coordinate", "split_part",
]
