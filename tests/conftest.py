import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

import pytest  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from callweave.session import local_session

    session = local_session(4, 4, spark__driver__memory="3g")
    yield session
    session.stop()
