"""Inputs that several steps of a query read are derived once and stored."""

import pytest

from tests.conftest import DATA
from workload import snapshots
from workload.frames import Frames
from workload.registry import QUERIES


class Stop(Exception):
    pass


def test_upserts_read_stored_rows(spark, monkeypatch):
    read, upsert = [], snapshots.tables.keyed_upsert
    monkeypatch.setattr(snapshots.tables, "keyed_upsert",
                        lambda source, *a, **kw: (read.extend(source.inputFiles()), upsert(source, *a, **kw)))
    QUERIES["sink_keyed_upsert"](spark, DATA)
    assert read and not [file for file in read if "lineitem" in file]


def test_daily_runs_number_their_lines_once(spark, monkeypatch):
    read = []

    def fact(f, lines):
        read.extend(lines.inputFiles())
        raise Stop
    monkeypatch.setattr(snapshots, "material_fact", fact)
    with pytest.raises(Stop):
        snapshots.run_days(Frames(spark, DATA), [])
    assert read and not [file for file in read if "lineitem" in file]
