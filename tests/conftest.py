import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cohortlens.session import build_session, checkpoint_dir
    s = build_session("local[4]", 8, "cohortlens-tests")
    checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()
