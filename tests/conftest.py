import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tablelearn.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(autouse=True, scope="module")
def interpreted(request, spark):
    """Hand-made tables are too small to be worth compiling a plan for; the registered queries and the layouts run compiled."""
    if request.module.__name__.endswith(("test_oracle", "test_layout")):
        yield
        return
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")
