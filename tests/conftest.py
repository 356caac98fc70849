import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    ckpt = tempfile.mkdtemp(prefix="tessera-test-ckpt-", dir="/tmp")
    s = build_session("local[4]", 4, extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "6g"})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")


def write_lines(folder: str, name: str, lines, encoding="utf-8", newline="\n") -> str:
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(newline.join(lines) + newline)
    return path


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
