import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as extra columns of the input.
EXTRA = ["id", "twin", "size", "target", "part", "whole", "cut", "code", "_row", "_plan", "_id", "_key", "starts", "label", "_nth", "key"]


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source]) tuples, with extra columns of clashing names."""

    def made(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        schema = COLUMNS
        if extra:
            full = [(*r, *["x"] * len(EXTRA)) for r in full]
            schema += "".join(f", {c} string" for c in EXTRA)
        return spark.createDataFrame(full, schema)

    return made


@pytest.fixture(scope="session")
def labels(spark):
    def made(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, source string, score double")

    return made
