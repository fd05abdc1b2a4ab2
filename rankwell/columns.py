"""Column names shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

# The names and defaults a caller of the library may rely on.
USER = "userId"
ITEM = "movieId"
RATING = "rating"
TIMESTAMP = "timestamp"
TITLE = "title"
GENRES = "genres"
LABEL = "label"
PREDICTION = "prediction"
RELEVANCE = "relevance"
SIMILARITY = "sim"
FEATURES = "features"
ITEM_COUNT = "number_of_rating_per_movie"
ITEM_MEAN = "average_rating_per_movie"
ITEM_DEVIATION = "standard_deviation_rating_per_movie"
USER_COUNT = "number_of_rating_per_user"
USER_MEAN = "average_rating_per_user"

DEFAULT_K = 10
SEED = 42
NO_GENRE = "(no genres listed)"


@dataclass(frozen=True)
class Cols:
    """Names of the key and value columns of one set of rating tables."""

    user: str = USER
    item: str = ITEM
    rating: str = RATING
    prediction: str = PREDICTION
    timestamp: str = TIMESTAMP


DEFAULT_COLS = Cols()


def require_columns(df, names, what: str) -> None:
    """Raise ValueError when ``df`` lacks one of ``names``; looks at the schema only."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}; it has {df.columns}")
