"""Scratch space: the shared folder where one is set, never a local one on a cluster."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from aislane.session import scratch_path


class _Session:
    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default=None: folder or default)


def test_shared_folder_is_used():
    path = scratch_path(_Session("spark://host:7077", "hdfs://shared/scratch/"), "pieces")
    assert path.startswith("hdfs://shared/scratch/pieces-")


def test_cluster_without_folder_is_refused():
    with pytest.raises(ValueError):
        scratch_path(_Session("yarn"), "pieces")


def test_local_master_may_go_on():
    session = _Session("local[2]")
    assert scratch_path(session, "a") != scratch_path(session, "a")
