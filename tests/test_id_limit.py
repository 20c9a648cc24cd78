"""The registered id classifiers have no limit in ids."""

import pytest

from catalog import QUERIES


@pytest.mark.parametrize("name", ["fm_ids", "id_embeddings"])
def test_every_held_out_pair_gets_a_class(spark, name):
    rows = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["valid"] for r in rows)
