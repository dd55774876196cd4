import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hearthline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folders(tmp_path):
    """Write {folder: {file: [header, rows…]}} as CSV and return the root."""

    def write(tables):
        for folder, files in tables.items():
            (tmp_path / folder).mkdir(exist_ok=True)
            for name, lines in files.items():
                (tmp_path / folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(tmp_path)

    return write
