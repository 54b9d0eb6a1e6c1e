import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wellspring.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="wellspring-warehouse-")
    session = local_session("8", 4, **{"spark.sql.warehouse.dir": warehouse})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
