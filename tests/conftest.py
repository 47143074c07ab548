import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mutualis.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="mutualis-tests")
    yield s
    s.stop()


def write_lines_file(tmp_path, name, rows):
    path = tmp_path / name
    path.write_text("".join(r + "\n" for r in rows))
    return str(path)
