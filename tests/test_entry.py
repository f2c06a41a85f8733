"""The flagship entry reads the folder that it is given."""

from __future__ import annotations

import pytest

import __spark_entry__
from tidelog.plans import sample_log


class Read(Exception):
    pass


@pytest.mark.parametrize("given, read", [("/some/tables", "/some/tables"), (None, "/root/testdata/sf0.001")])
def test_entry_reads_the_given_folder(spark, monkeypatch, given, read):
    def messages(_, sf_dir):
        raise Read(sf_dir)

    monkeypatch.setattr(sample_log, "messages", messages)
    monkeypatch.delenv("ENTRY_SF_DIR", raising=False)
    if given:
        monkeypatch.setenv("ENTRY_SF_DIR", given)
    with pytest.raises(Read, match=read):
        __spark_entry__.entry(spark)
