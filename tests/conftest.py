import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"

# Labels and thresholds of the reference tests' fake configuration (fixed values).
FAKE_LABELS = ["Astronomy", "Heliophysics", "Planetary Science", "Earth Science", "NASA-funded Biophysics",
               "Other Physics", "Other", "Text Garbage"]
FAKE_THRESHOLDS = [0.6, 0.4, 0.8, 0.5, 0.7, 0.3, 0.2, 0.9]


@pytest.fixture(scope="session")
def spark():
    from labelweave.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app="labelweave-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
