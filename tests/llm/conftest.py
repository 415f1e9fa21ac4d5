from __future__ import annotations

import sys
from pathlib import Path

import pytest

from siltgate.sources.staging import Staging

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture()
def staging(spark):
    with Staging(spark) as staged:
        yield staged
