"""Every registered query against its SQL on the smallest tables."""

import sys
import threading
from pathlib import Path
from types import SimpleNamespace

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import compare, connect  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from earshot.workload import queries as Q  # noqa: E402
from earshot.workload.oracle import ORACLE  # noqa: E402
from earshot.workload.queries import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, db, name):
    good, text = compare(spark, db, name, SF)
    assert good, text


def test_every_query_has_sql():
    assert set(ORACLE) == set(REGISTRY)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_landed_folders_are_written_side_by_side(spark):
    both, written = threading.Barrier(2, timeout=20), []

    def frame(fail=False):
        def json(path):
            both.wait()
            if fail:
                raise OSError(path)
            written.append(path)

        return SimpleNamespace(sparkSession=spark, write=SimpleNamespace(json=json))

    Q._land({"a": frame(), "b": frame()})
    assert sorted(written) == ["a", "b"]
    with pytest.raises(OSError, match="d"):
        Q._land({"c": frame(), "d": frame(fail=True)})
