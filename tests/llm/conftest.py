import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

TEXT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts; ids count from 0 unless pairs of id and text are given."""

    def make(*texts, extra=False):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", f"src{i or 0}", len(t) if t is not None else None) for i, t in rows]
        if not extra:
            return spark.createDataFrame(rows, TEXT)
        # columns whose names the operators use for themselves
        names = "fp string, score string, row string, seg string, piece string, label string, id string, y string, rank string"
        return spark.createDataFrame([(*r, *"abcdefghi") for r in rows], f"{TEXT}, {names}")

    return make
