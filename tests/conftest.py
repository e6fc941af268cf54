import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quarrymill.session import local_session

    where = str(tmp_path_factory.mktemp("spark"))
    session = local_session("4", 4, **{"spark.local.dir": where, "spark.sql.warehouse.dir": f"{where}/warehouse", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"{where}/checkpoints"})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(f"{where}/checkpoints")
    yield session
    session.stop()
