"""Column expressions used by more than one operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: digits standing alone between parentheses.
YEAR_IN_PARENTHESES = r"(?<=\()(\d+)(?=\))"


def genre_list(genres: Column | str) -> Column:
    return F.split(genres, r"\|")


def released_year(title: Column | str, last: bool = False) -> Column:
    """The parenthesised number of a title as int, null when there is none or it does not fit.

    The first such number counts, as in ``(500) Days of Summer (2009)`` -> 500; ``last`` takes
    the last one instead.
    """
    if last:
        found = F.try_element_at(F.regexp_extract_all(title, F.lit(YEAR_IN_PARENTHESES), F.lit(1)), F.lit(-1))
    else:
        found = F.regexp_extract(title, YEAR_IN_PARENTHESES, 1)
    return found.try_cast("int")


def defined(column: str) -> Column:
    """Neither null nor NaN."""
    return F.col(column).isNotNull() & ~F.isnan(column)


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column | str) -> Column:
    """The vector over its length; null for a zero vector."""
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length))
