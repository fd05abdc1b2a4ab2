"""Small documents that hold the awkward cases."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    None,
    "",
    " \t\n ",
    "a",
    "The cat sat on the mat. The cat sat on the mat again, isn't it?",
    "don't we've i'll 'start 're 'r ''s x''s  's 12 three4five",
    "ÄÖÜ größe 漢字 🙂 and more　space\x1c\x85",
    "line one is here\nline one is here\n\n   \nline two\r\n" * 3,
    "All rights reserved. CC-BY 4.0, under the GNU General Public License.",
    "word " * 3000 + "x" * 2000,
    "### $$$ %%% &&& *** <<>> ||",
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, ties, repeated rows, null ids and a column with a clashing name."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(AWKWARD)]
    rows += [rows[4], (None, "null id", None, None, None), (50, AWKWARD[4], None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
