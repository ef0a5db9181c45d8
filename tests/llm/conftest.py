import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))


@pytest.fixture(autouse=True)
def few_partitions(settings):
    """Small tables need few tasks."""
    settings(spark__sql__shuffle__partitions="2")
