import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest

LONG = "lorem ipsum dolor sit amet consectetur " * 6000

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, n long, score double, _h long, u string"


def rows(*texts):
    return [(i, t, "en", f"src{i % 3}", len(t) if t is not None else None, 1, 2, 0.5, 3, "x") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    base = rows("a plain text of some words here", "", None, LONG, "tie tie tie", "?!  \n\t --", "\u00e9t\u00e9 \U0001f600 na\u00efve")
    base += [base[0], base[0], (None,) * 10, (None, "a plain text of some words here", None, None, None, 1, 2, 0.5, 3, "x")]
    base += [(0, "another text under the same number", "en", "src0", 5, 1, 2, 0.5, 3, "x")]
    return spark.createDataFrame(base, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
