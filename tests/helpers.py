"""Names that test modules share; no test imports a conftest."""

import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def fixture(name: str) -> str:
    return os.path.join(FIXTURES, name)
