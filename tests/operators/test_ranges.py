import pytest
from hypothesis import given
from hypothesis import strategies as st

from visloom.functions.ranges import ChannelRanges, Range, align_down, align_up, averaging_ratio, tune_next

ints = st.integers(-30, 30)
ranges = st.builds(Range, ints, ints)


@given(ranges, ranges)
def test_set_relations(a, b):
    x, y = set(a), set(b)
    assert len(a) == len(x) and (a == b) == (x == y)
    assert a.issubset(b) == (x <= y) and a.issuperset(b) == (x >= y)
    assert set(a.intersection(b)) == x & y
    hull = a.union(b)
    assert set(hull) == (set(range(min(x | y), max(x | y) + 1)) if x | y else set())
    if a == b:
        assert hash(a) == hash(b)


@given(ranges, st.integers(1, 9))
def test_alignment(a, n):
    out = a.alignto(n)
    assert out.isaligned(n) and a.issubset(out)
    assert not a or (out.start > a.start - n and out.stop < a.stop + n)


def test_parse_split_relative():
    assert Range.parse("-3:7").astuple() == (-3, 7)
    assert Range.parse("3:7").asslice() == slice(3, 7)
    for bad in ("3", "3:4:5", "a:b", ""):
        with pytest.raises(ValueError):
            Range.parse(bad)
    assert Range(0, 12).split(3, 1) == Range(4, 8)
    with pytest.raises(ValueError):
        Range(0, 12).split(5, 0)
    assert Range(5, 6).relative_to(Range(4, 9)) == Range(1, 2)
    with pytest.raises(ValueError):
        Range(1, 3).relative_to(Range(2, 9))
    with pytest.raises(ValueError):
        Range(-1, 3).asslice()


def test_channel_plan_worked_example():
    plan = ChannelRanges.plan(4, 2, 4096, 16, 128, 16, 64, Range(464, 1744), Range(640, 1664))
    assert (plan.output, plan.sd_output, plan.computed) == (Range(784, 1104), Range(896, 1152), Range(768, 1152))
    assert (plan.input, plan.subscribed) == (Range(704, 1216), Range(512, 1280))
    good = dict(servers=4, server=2, channels=4096, cont_factor=16, sd_cont_factor=128, streams=16, guard=64, all_output=Range(464, 1744), all_sd_output=Range(640, 1664))
    for change in ({"server": 0}, {"server": 5}, {"streams": 17}, {"all_output": Range(465, 1744)}, {"all_output": Range(464, 5000)}, {"all_sd_output": Range(640, 1665)}, {"all_output": Range(464, 1760)}):
        with pytest.raises(ValueError):
            ChannelRanges.plan(**good | change)


def test_quantisation():
    assert [tune_next(v, (2, 4, 8)) for v in (1, 2, 3, 8, 9)] == [2, 2, 4, 8, 9]
    assert [averaging_ratio(s, 1.0) for s in (0.1, 1.4, 1.5, 2.5, 3.5)] == [1, 1, 2, 2, 4]


def test_column_forms(spark):
    from pyspark.sql import functions as F

    for r in spark.range(-20, 20).select("id", align_down(F.col("id"), 7).alias("a"), align_up(F.col("id"), 7).alias("b")).collect():
        assert (r["a"], r["b"]) == (r["id"] // 7 * 7, -(-r["id"] // 7) * 7)
