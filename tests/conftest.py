import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from cantoria.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("4", 4, **{"spark.driver.memory": "3g"})
