"""Queries that read every row of their table."""

import os

import pyarrow.parquet as pq
import pytest

from marlstone.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")


def test_components_of_every_line_item(spark):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    t = pq.read_table(f"{SF}/lineitem.parquet", columns=["l_orderkey", "l_partkey"]).to_pydict()
    for o, p in zip(t["l_orderkey"], t["l_partkey"], strict=True):
        a, b = sorted((find(f"o{o}"), find(f"p{p}")))
        root[b] = a
    got = QUERIES["connected_components_of_ids"](spark, SF).collect()
    assert len(got) == len(root) and {r.node: r.component for r in got} == {x: find(x) for x in list(root)}


def test_year_merge_reads_every_order(spark):
    got = QUERIES["year_merge"](spark, SF).collect()
    assert sum(r.n_rows for r in got) == pq.read_metadata(f"{SF}/orders.parquet").num_rows
    assert any(r.ambiguous_year for r in got) and not all(r.ambiguous_year for r in got)
