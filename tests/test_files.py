import re

import pytest

from tradelake.operators.files import has_wildcard, root_prefix, wildcard_to_regex
from tradelake.plans.tables import InvalidTableName, ledger_id, resolve_names


def test_wildcard_crosses_slash_like_fnmatch():
    rx = re.compile(wildcard_to_regex("/lake/btc_trades/year=*/month=*/day=*/*.parquet"))
    assert rx.match("file:/lake/btc_trades/year=2026/month=4/day=4/btc_trades_1.parquet")
    assert rx.match("/lake/btc_trades/year=2026/month=4/day=4/deeper/x.parquet")
    assert not rx.match("/lake/btc_trades/year=2026/month=4/day=4/x.json")


def test_wildcard_classes_and_question_mark():
    rx = re.compile(wildcard_to_regex("gs://b/a/file-?[0-9][!x].parquet"))
    assert rx.match("gs://b/a/file-A1y.parquet")
    assert not rx.match("gs://b/a/file-A1x.parquet")


def test_root_prefix():
    assert root_prefix("gs://b/btc_trades/year=*/month=*/*.parquet") == "gs://b/btc_trades/"
    assert root_prefix("/lake/x/*.parquet") == "/lake/x/"
    assert root_prefix("*.parquet") == ""
    assert has_wildcard("a/*") and not has_wildcard("a/b.parquet")


def test_names_of_table_and_ledger():
    names = resolve_names(None, "lake.market.trades", "seen")
    assert (names.fact, names.ledger_table) == ("`lake`.`market`.`trades`", "`lake`.`market`.`seen`")
    assert resolve_names(None, "market.trades", current_catalog="spark_catalog").database == "`spark_catalog`.`market`"
    assert ledger_id(None, "lake.market.trades", ledger="") == "lake.market.loaded_files"
    for wrong in ("trades", "", ".trades", "market.", "lake..trades", "x.lake.market.trades"):
        with pytest.raises(InvalidTableName, match="db.table"):
            resolve_names(None, wrong, current_catalog="c")


def test_limit_files_rejects_negative(spark):
    from tradelake.operators.files import limit_files

    df = spark.createDataFrame([("a",), ("b",)], "path string")
    assert limit_files(df, None).count() == 2
    assert limit_files(df, 0).count() == 2
    assert [r.path for r in limit_files(df, 1).collect()] == ["a"]
    with pytest.raises(ValueError):
        limit_files(df, -1)


def test_relative_patterns_match(spark, tmp_dir, monkeypatch):
    from tradelake.sources.listing import list_files, qualified

    spark.range(3).write.parquet(f"{tmp_dir}/lake/day=1")
    working = qualified(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    import os

    relative = os.path.relpath(f"{tmp_dir}/lake", working)
    assert list_files(spark, f"{relative}/*/*.parquet").count() == list_files(spark, f"{tmp_dir}/lake/*.parquet").count() > 0


def test_only_a_missing_path_means_no_files(spark, tmp_dir):
    from tradelake.sources.listing import exists_any

    spark.range(3).write.parquet(f"{tmp_dir}/there")
    assert exists_any(spark, f"{tmp_dir}/there") and not exists_any(spark, f"{tmp_dir}/missing")
    with pytest.raises(Exception, match="scheme"):
        exists_any(spark, "nosuchscheme://bucket/x")
