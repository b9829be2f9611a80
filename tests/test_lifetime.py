"""Tables, cached frames and broadcasts are gone after a workflow, also a failed one."""
import os
from urllib.parse import urlparse

import pytest

from respengine.lifetime import Lifetime, delete_table
from respengine.plans.workflow import ohe_report, run_ohe, split_observations
from respengine.session import ensure_checkpoint_dir, materialize
from respengine.sources.tables import ctr_events

from conftest import SF001


def _left(spark):
    tables = os.path.join(urlparse(ensure_checkpoint_dir(spark)).path, "tables")
    return set(os.listdir(tables)) if os.path.isdir(tables) else set()


def _cached(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_workflow_leaves_nothing(spark):
    before, cached = _left(spark), _cached(spark)
    with Lifetime(spark) as mine:
        rows = ohe_report(run_ohe(split_observations(ctr_events(spark, SF001)), iterations=2)).collect()
        assert mine.tables and mine.frames and _left(spark) > before
    assert len(rows) == 7
    assert _left(spark) == before and _cached(spark) == cached


def test_failure_and_nesting(spark):
    before = _left(spark)
    with Lifetime(spark) as outer:
        kept = materialize(spark.range(5))
        with pytest.raises(ValueError, match="boom"):
            with Lifetime(spark):
                materialize(spark.range(3))
                raise ValueError("boom")
        assert kept.count() == 5 and len(outer.tables) == 1
    assert _left(spark) == before
    # Nothing is noted outside; what cannot be freed does not keep the rest.
    loose = materialize(spark.range(2))
    assert loose.count() == 2
    owner = Lifetime(spark)
    owner.tables = ["nosuchscheme://x/y", *[f"{ensure_checkpoint_dir(spark)}/tables/{t}" for t in _left(spark) - before]]
    with pytest.raises(RuntimeError, match="1 of 2 not freed"):
        owner.free()
    assert _left(spark) == before
    delete_table(spark, f"{ensure_checkpoint_dir(spark)}/tables/absent/none")
