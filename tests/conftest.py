import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from folio.session import local_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = local_session("*", app="folio-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
