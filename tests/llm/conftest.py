import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from flowgraph.llm import queries  # noqa: E402

AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "a\x00b ☃ é 漢字 🙂"), (None, "no id at all here now"),
    (7, "x" * 50_000), (8, "long " * 20_000), (9, "Call +1 (743) 555-3220 or mail a.b@c.example.org now\nor not"), (9, "other text of the same id"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and further columns whose names the operators use themselves."""
    schema = "doc_id long, text string, row string, id string, n long, score double, t string, k0 string, block long, trained string"
    return spark.createDataFrame([(i, t, "r", "i", 1, 0.5, "t", "k", 2, "x") for i, t in AWKWARD], schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return queries.table(spark, sf_dir, "documents")
