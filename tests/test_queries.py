"""Every registered query against its SQL."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare

from landledger.plans import registry

registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    if name in registry.ORACLES:
        compare(name, df, sf, registry.ORACLES[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_parent_links_past_a_million_parcels(spark, tmp_path):
    """Lines of orders around the millionth; two orders have no parcel by their state, one is missing."""
    keys = [999_998, 999_999, 1_000_000, 1_000_001, 12_345_678]
    lines = [(key, line) for key in keys for line in (1, 2, 2)]
    orders = [(999_998, "O"), (999_999, "P"), (1_000_000, "F"), (1_000_001, "P")]
    pq.write_table(pa.table({"l_orderkey": pa.array([k for k, _ in lines], pa.int64()), "l_linenumber": pa.array([n for _, n in lines], pa.int32())}), tmp_path / "lineitem.parquet")
    pq.write_table(pa.table({"o_orderkey": pa.array([k for k, _ in orders], pa.int64()), "o_orderstatus": [s for _, s in orders]}), tmp_path / "orders.parquet")
    assert compare("parent_links", registry.QUERIES["parent_links"](spark, str(tmp_path)), str(tmp_path), registry.ORACLES["parent_links"]) == 6
