import io
import os
import sys
import zipfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from drydock.session import local_session, ship_package  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    ship_package(session)
    return session


def zip_bytes(members: dict) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in members.items():
            archive.writestr(name, body)
    return buffer.getvalue()


@pytest.fixture
def archives(spark):
    """Archives given as {path: {member: body} or raw bytes}."""
    def make(found: dict):
        rows = [(path, 0, zip_bytes(body) if isinstance(body, dict) else body) for path, body in found.items()]
        return spark.createDataFrame(rows, "path string, length bigint, content binary")
    return make
