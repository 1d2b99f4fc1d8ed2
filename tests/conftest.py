import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from layerwell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
        # Tiny frames: compiling code for them takes longer than running them.
        spark__sql__codegen__wholeStage="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
