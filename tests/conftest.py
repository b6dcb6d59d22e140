import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from scarmap.cluster import own_checkpoint_folder, session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("ERROR")
    own_checkpoint_folder(s)
    yield s
    s.stop()
