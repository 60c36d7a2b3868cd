"""JDBC reader: the hash predicates are disjoint and cover every key."""

from shopmetrics.sources.jdbc import SPLIT_COLUMNS, hash_predicates
from shopmetrics.schema import STAR_TABLES


def test_hash_predicates_partition_keys():
    preds = hash_predicates("order_id", 4)
    assert len(preds) == 4
    assert all("hashtext(CAST(order_id AS text))" in p for p in preds)
    assert [p.split("= ")[-1][0] for p in preds] == ["0", "1", "2", "3"]
    assert "IS NULL" in preds[0] and all("IS NULL" not in p for p in preds[1:])


def test_every_star_table_has_a_split_column():
    assert set(STAR_TABLES) <= set(SPLIT_COLUMNS)
