from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from wardflow.config import Settings  # noqa: E402
from wardflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cpus=4, app="wardflow-tests", memory="4g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def settings(tmp_path):
    return Settings(root=str(tmp_path / "lake"), corpus_dir=str(tmp_path / "corpus"))
