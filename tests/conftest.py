import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexivane.session import local_session

    base = tmp_path_factory.mktemp("spark")
    s = local_session("4", 4, "4g", **{"spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse", "spark.local.dir": f"{base}/local"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
