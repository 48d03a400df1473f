from types import SimpleNamespace

import pytest

from scanlake.session import shared_dir


def session(master, folder=None, application="app"):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=application))


def test_shared_folder_comes_from_the_session():
    assert shared_dir(session("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"


def test_only_a_local_master_may_use_its_own_folder():
    folder = shared_dir(session("local[2]"))
    assert folder == shared_dir(session("local[2]"))
    with pytest.raises(ValueError):
        shared_dir(session("yarn"))
