import pathlib
import sys

import pytest

sys.path[:0] = [str(pathlib.Path(__file__).parent), str(pathlib.Path(__file__).parents[1])]

from conftest_llm import AWKWARD, DOCUMENTS, documents  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    return documents(spark, AWKWARD).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
