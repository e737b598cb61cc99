from __future__ import annotations

from forgeline.functions.columns import chosen_targets, parse_target_list, parse_target_list_col


def test_target_list_plain():
    assert parse_target_list("a/b,c/d") == ["a/b", "c/d"]


def test_target_list_blanks():
    assert parse_target_list("  a/b , , c/d  ") == ["a/b", "c/d"]
    assert parse_target_list("") == []


def test_target_list_column_matches(spark):
    row = spark.range(1).select(parse_target_list_col("  a/b , , c/d  ").alias("t")).collect()[0]
    assert row["t"] == ["a/b", "c/d"]


def test_single_repository_overrides_the_list():
    assert chosen_targets("a/b,c/d", " x/y ") == ["x/y"]
    assert chosen_targets("a/b,c/d", "  ") == chosen_targets("a/b,c/d") == ["a/b", "c/d"]
