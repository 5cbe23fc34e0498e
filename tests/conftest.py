import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ecoflux import build_session
    from ecoflux.session import clear_scratch

    scratch = tempfile.mkdtemp(prefix="ecoflux-tests-")
    s = build_session(
        app="ecoflux-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    # tests set their own checkpoint folder, only because none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    clear_scratch(s)


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="ecoflux-run-")
