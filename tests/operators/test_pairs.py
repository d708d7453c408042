"""Baselines by pairs of antennas agree with the operators on lists of baselines, and are made by many tasks."""

import pytest

from visloom.operators import baselines


@pytest.fixture
def array(spark):
    """Thirty antennas, numbers of one and two digits, so that some pairs are mirrored by name."""
    return spark.createDataFrame([(k, f"m{k}", float(k * k % 37), 3.0 * k, 0.0) for k in range(30)], "number long, antenna string, east double, north double, up double")


def same(a, b):
    assert a.columns == b.columns and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def without_mirrored(df):
    return baselines.kept(df).select("cbf_bl", "input1", "input2")


def test_pairs_are_dealt_over_tasks(spark, array, monkeypatch):
    monkeypatch.setattr(baselines, "PAIRS", 50)
    made = baselines.generate(array.coalesce(1))
    assert made.rdd.getNumPartitions() == 9 and made.count() == made.distinct().count() == 30 * 31 // 2 * 4
    assert {tuple(r)[1:] for r in made.where("cbf_bl = (3 * 1000000 + 17) * 4 + 3").collect()} == {("m3v", "m17h")}


def runs(rows, of):
    """How often ``of`` changes from row to row."""
    return sum(of(a) != of(b) for a, b in zip(rows, rows[1:], strict=False))


def test_labels_of_a_block_are_written_together(spark, array, monkeypatch):
    """A task goes through its blocks of partners one after another, so that the labels it writes fit a file's dictionary."""
    monkeypatch.setattr(baselines, "PAIRS", 200)
    monkeypatch.setattr(baselines, "PARTNERS", 7)
    made = baselines.generate(array)
    assert {tuple(r) for r in made.collect()} == {((a * 1_000_000 + b) * 4 + k, f"m{a}{p}", f"m{b}{q}") for a in range(30) for b in range(a, 30) for k, (p, q) in enumerate(baselines.PRODUCTS)}
    for part in made.rdd.glom().collect():
        assert runs(part, lambda r: r["cbf_bl"] // 4 % 1_000_000 // 7) <= 4
    assert baselines.generate(array.limit(0)).count() == 0


def test_groups_and_orders_by_product(spark, array, monkeypatch):
    """A pair's four numbers stand together in each group, and numbers of one product in the order follow one another."""
    grouped = baselines.grouped_pairs(array).collect()
    assert [r["grp"] for r in grouped[:4]] == ["auto"] * 4 and [r["cbf_bl"] for r in grouped[:4]] == [r["cbf_bl"] for r in grouped[4:8]]
    ordered = baselines.ordered_pairs(array).where("substring(input1, 1, length(input1) - 1) <> substring(input2, 1, length(input2) - 1)").collect()
    assert runs(ordered, lambda r: r["cbf_bl"] % 4) < len(ordered) // 4


def test_order_of_pairs(spark, array, monkeypatch):
    monkeypatch.setattr(baselines, "BLOCK", 7)
    ordered = baselines.ordered_pairs(array)
    expected = sorted((x["ant1"] != x["ant2"], x["pol1"] != x["pol2"], x["pol1"], x["pol2"], x["cbf_bl"]) for x in baselines.kept(baselines.generate(array)).collect())
    assert [r["cbf_bl"] for r in ordered.orderBy("bl").collect()] == [x[-1] for x in expected]
    same(ordered, baselines.order(baselines.generate(array)))
    assert dict(ordered.dtypes)["bl"] == "int"
    twice = array.union(array.where("number = 4"))
    assert baselines.ordered_pairs(twice).count() == baselines.kept(baselines.generate(twice)).count()
    assert baselines.ordered_pairs(array.limit(0)).count() == 0


def test_groups_of_pairs(array):
    same(baselines.grouped_pairs(array), baselines.groups(without_mirrored(baselines.generate(array)), "cbf_bl"))


def test_lengths_of_pairs(array):
    same(baselines.pair_lengths(baselines.measured_pairs(array)), baselines.lengths(baselines.generate(array), array).where("ant2 >= ant1"))


def reach_of(spark):
    return spark.createDataFrame([(k, r) for k, r in enumerate((0.0, 8.0, 8.0, 31.5, -1.0, 60.0, float("inf")))], "channel int, reach double")


@pytest.mark.parametrize("autos", [False, True])
def test_range_mask_of_pairs(spark, array, autos):
    measured, reach = baselines.measured_pairs(array), reach_of(spark)
    same(baselines.range_mask(measured, reach, autos), baselines.range_mask(baselines.pair_lengths(measured), reach, autos))
    assert "BroadcastHashJoin [bin#" in baselines.range_mask(measured, reach, autos)._jdf.queryExecution().executedPlan().toString()


def test_masks_of_pairs(spark, array):
    measured, reach = baselines.measured_pairs(array.union(array.limit(1).selectExpr("30L", "'m30'", "CAST(NULL AS DOUBLE)", "north", "up"))), reach_of(spark)
    rows = baselines.pair_lengths(measured)
    same(baselines.pair_masks(measured, reach), baselines.unique_masks(baselines.range_mask(rows, reach), rows))
    same(baselines.pair_masks(measured, reach.limit(0)).select("channels").distinct(), spark.createDataFrame([("",)], "channels string"))


def test_masks_compare_lengths_by_join(spark, array):
    """Lengths on a level's edge, and levels of one bin, are told apart by the join's own condition."""
    measured = spark.createDataFrame([(k, k + 1, "a", "b", x) for k, x in enumerate((0.0, 7.9, 8.0, 8.05, 8.1, 8.2, 60.0, 61.0))], "n1 long, n2 long, ant1 string, ant2 string, length_m double")
    reach = spark.createDataFrame([(k, r) for k, r in enumerate((0.0, 8.0, 8.1, 8.1, 60.0))], "channel int, reach double")
    masks = baselines.pair_masks(measured, reach)
    assert [r["channels"] for r in masks.where("cbf_bl % 4 = 0").orderBy("cbf_bl").collect()] == ["0,1,2,3,4", "1,2,3,4", "1,2,3,4", "2,3,4", "2,3,4", "4", "4", ""]
    assert "array_min" not in masks._jdf.queryExecution().executedPlan().toString()
