import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from oddities import CLASH, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with further columns named like those that operators make or use."""
    rows = [(i, t, "en", "src", None if t is None else len(t), *(["x"] * len(CLASH))) for i, t in odd_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)).cache()


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(20)] + [(3, None, None), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")
