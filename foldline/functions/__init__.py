"""Column-level helpers: name quoting/resolution and value expressions."""

from .names import check_unique, col, cols, drop_nulls, free_name, positive_int, quote, resolve
from .values import cell_text, finite_double, md5_leading_digits

__all__ = [
    "cell_text",
    "check_unique",
    "col",
    "cols",
    "drop_nulls",
    "finite_double",
    "free_name",
    "md5_leading_digits",
    "positive_int",
    "quote",
    "resolve",
]
