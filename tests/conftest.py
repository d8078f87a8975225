from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tokenloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """A function from ``{doc_id: [line, ...]}`` to a frame of lines."""

    def build(docs: dict[str, list[str]]):
        rows = [(doc, i, line) for doc, found in docs.items() for i, line in enumerate(found)]
        return spark.createDataFrame(rows, "doc_id string, line_no long, text string")

    return build


@pytest.fixture
def write_file(tmp_path):
    def write(name: str, content: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode())
        return str(path)

    return write
