import os
import sys
import tempfile
from pathlib import Path

import pyspark
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from ratewell.session import build_session  # noqa: E402


def own_scratch() -> dict[str, str]:
    """A scratch folder for these local tests, where the installation doesn't name one."""
    folder = os.environ.get("SPARK_CONF_DIR") or Path(pyspark.__file__).parent / "conf"
    defaults = Path(folder, "spark-defaults.conf")
    named = defaults.exists() and "spark.checkpoint.dir" in defaults.read_text()
    return {} if named else {"spark__checkpoint__dir": tempfile.mkdtemp(prefix="ratewell-")}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ratewell-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        **own_scratch(),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
