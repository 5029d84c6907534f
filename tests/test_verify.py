"""Verification of published tables: one job, missing ones tolerated."""

import pytest

from ledgerlake.sinks.writers import Store, path_has_files, verify_tables


@pytest.mark.parametrize("catalog", [False, True])
def test_verify_tables(spark, tmp_path, catalog):
    store = Store(spark, base_path=None if catalog else str(tmp_path / "t"), use_catalog=catalog, prefix=f"v{tmp_path.name.replace('-', '_')}")
    if catalog:
        store.create_databases()
    store.write(spark.range(5), "gold", "five")
    store.write(spark.range(0), "gold", "none")
    got = [tuple(r) for r in verify_tables(store, "gold", ["none", "absent", "five"]).collect()]
    assert got == [("none", True, 0), ("absent", False, None), ("five", True, 5)]
    assert verify_tables(store, "gold", []).count() == 0


def test_path_has_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "full").mkdir()
    (tmp_path / "full" / "a.csv").write_text("x\n1\n")
    assert [path_has_files(spark, str(tmp_path / p)) for p in ("empty", "full", "absent")] == [False, True, False]
