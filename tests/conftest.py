import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripledger.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g", 8)
    yield session
    session.stop()


def money(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


def day(text):
    return date.fromisoformat(text)


def moment(text):
    return datetime.fromisoformat(text)


def write_files(folder, files):
    """Files by name, content as given."""
    for name, content in files.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as f:
            f.write(content)
    return str(folder)
