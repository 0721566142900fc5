"""The end-to-end example runs on the smallest test data."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_layers_demo_runs(spark, capsys):
    from examples.layers_demo import main
    main(SF)
    out = capsys.readouterr().out
    assert "silver v1 rows 1500" in out and "fact rows 6000" in out
    assert "{'batches': 0, 'rows': 0}" in out          # the rerun loaded nothing
