"""Baselines: labels, order, groups, lengths and static masks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written

GROUPS = ("auto", "autohh", "autovv", "autohv", "cross", "crosshh", "crossvv", "crosshv")
PRODUCTS = (("h", "h"), ("v", "v"), ("h", "v"), ("v", "h"))


def antenna_of(label: Column) -> Column:
    return F.substring(label, F.lit(1), F.length(label) - 1)


def polarisation_of(label: Column) -> Column:
    return F.right(label, F.lit(1))


#: Antennas are numbered below this, as the numbers of baselines have it.
NUMBERS = 1_000_000
#: Pairs of antennas that a task makes.
PAIRS = 1 << 20
#: Antennas that a row of partners holds.
BLOCK = 1 << 11
#: So are those of a block that tasks make pairs with: a file's dictionary of labels stays small, and its rows repeat in step with the block.
PARTNERS = 1 << 9


def _spread(antennas: DataFrame) -> DataFrame:
    """Antennas dealt over so many tasks that each makes some ``PAIRS`` pairs: a table of antennas is one small file, its pairs grow with its square."""
    return antennas.repartition(_tasks(antennas.count()), "number")


def _tasks(n: int) -> int:
    return max(1, min(4096, n * n // (2 * PAIRS)))


def _shares(tasks: int, blocks: int) -> int:
    """Into how many shares the antennas that meet a block of partners are dealt, so that each task has some eight pairs of a share and a block."""
    return max(1, 8 * tasks // max(1, blocks))


def _sides(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = {"number": "n", "antenna": "ant"}
    one, two = (df.select(*[F.col(c).alias(f"{names.get(c, c)}{k}") for c in df.columns]) for k, df in ((1, first), (2, second)))
    return one, two


def _pairs(first: DataFrame, second: DataFrame) -> DataFrame:
    """Each pair of antennas, an antenna with itself included; columns n1, ant1, ... and n2, ant2, ... The second side is less than ``NUMBERS`` rows."""
    one, two = _sides(_spread(first), second)
    return one.join(F.broadcast(two), F.col("n1") <= F.col("n2"))


def _pairs_by_block(first: DataFrame, second: DataFrame) -> DataFrame:
    """``_pairs``, dealt by blocks of partners and shares of the antennas that meet a block, so that what a task writes has the labels of one block after another."""
    one, two = _sides(first, second)
    two = two.withColumn("block", F.floor(F.col("n2") / PARTNERS))
    n, many = two.agg(F.count("*"), F.count_distinct("block")).first()
    blocks = two.groupBy("block").agg(F.max("n2").alias("last"))
    # By block here, and so in each task, too: Spark leaves out a sort below a join.
    met = blocks.join(F.broadcast(one), F.col("n1") <= F.col("last")).drop("last")
    tasks = _tasks(n)
    dealt = met.repartition(tasks, "block", F.pmod(F.col("n1").cast("long"), F.lit(_shares(tasks, many))))
    return dealt.join(F.broadcast(two), "block").where("n1 <= n2").drop("block")


def _products(spark: SparkSession, **more: Column) -> DataFrame:
    """k from 0 to 3; with what ``more`` makes of ``k``, too."""
    return spark.range(0, len(PRODUCTS), 1, 1).withColumnRenamed("id", "k").select(*[c.alias(name) for name, c in ({"k": F.col("k")} | more).items()])


def _cbf_bl() -> Column:
    return ((F.col("n1") * NUMBERS + F.col("n2")) * 4 + F.col("k")).alias("cbf_bl")


def _each_product(pairs: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Each pair with k from 0 to 3, and ``cbf_bl``; with what rows of ``products`` have beside k, too."""
    return pairs.crossJoin(F.broadcast(_products(pairs.sparkSession) if products is None else products)).withColumn("cbf_bl", _cbf_bl())


def _inputs(antennas: DataFrame) -> DataFrame:
    """Antennas with their inputs' labels, h and v, which are not to be put together again for each pair."""
    return antennas.withColumns({p: F.concat("antenna", F.lit(p)) for p in "hv"})


def _input(side: int) -> Column:
    """The label of a product's first or second input, of rows that have ``k`` and the labels of ``_inputs``."""
    return F.when(F.col("k").isin([k for k, x in enumerate(PRODUCTS) if x[side - 1] == "h"]), F.col(f"h{side}")).otherwise(F.col(f"v{side}"))


def generate(antennas: DataFrame) -> DataFrame:
    """(cbf_bl, input1, input2): the four products of each pair of antennas, an antenna with itself included."""
    own = _inputs(antennas.select("number", "antenna"))
    return _each_product(_pairs_by_block(own, own)).select("cbf_bl", _input(1).alias("input1"), _input(2).alias("input2"))


def _parts(df: DataFrame) -> DataFrame:
    names = {"ant1": antenna_of(F.col("input1")), "ant2": antenna_of(F.col("input2")), "pol1": polarisation_of(F.col("input1")), "pol2": polarisation_of(F.col("input2"))}
    return df.withColumns(names)


def kept(labelled: DataFrame, antenna_mask: list[str] | None = None) -> DataFrame:
    """Without the mirrored baselines, and on wish only those between the given antennas."""
    df = _parts(labelled).where("ant2 >= ant1")
    return df.where(F.col("ant1").isin(antenna_mask) & F.col("ant2").isin(antenna_mask)) if antenna_mask else df


def order(labelled: DataFrame, antenna_mask: list[str] | None = None) -> DataFrame:
    """``bl``: autos before crosses, parallel hands before cross hands, then by polarisations, then as received. Numbers run within parts of the
    range of ``cbf_bl``, which begin where those before have ended; one task adds up the sizes of parts. ``ordered_pairs`` does without a sort."""
    kind = {"cross": F.col("ant1") != F.col("ant2"), "hands": F.col("pol1") != F.col("pol2"), "part": F.coalesce(F.floor(F.col("cbf_bl") / (4 * BLOCK)).cast("long"), F.lit(-(1 << 62)))}
    df, own = kept(labelled, antenna_mask).withColumns(kind), ["cross", "hands", "pol1", "pol2", "part"]
    before = F.sum("n").over(Window.orderBy(*own).rowsBetween(Window.unboundedPreceding, -1))
    starts = df.groupBy(*own).agg(F.count("*").alias("n")).select(*own, F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy(*own).orderBy("cbf_bl")) - 1
    return df.withColumn("place", place).join(starts, own).select("cbf_bl", "input1", "input2", (F.col("start") + F.col("place")).cast("int").alias("bl"))


def ordered_pairs(antennas: DataFrame) -> DataFrame:
    """``order(generate(antennas))``. An antenna's partners are counted by blocks of antennas, so that each pair's number follows from
    its place among them, and no pair is sorted or exchanged. ``bl`` is a long where there are 2**31 baselines or more."""
    own = _inputs(antennas.select("number", "antenna")).where("number IS NOT NULL AND antenna IS NOT NULL")
    n, numbers, names, low, high = own.agg(F.count("*"), F.count_distinct("number"), F.count_distinct("antenna"), F.min("number"), F.max("number")).first()
    if not n or not n == numbers == names or low < 0 or high >= NUMBERS:
        return order(generate(antennas))
    tasks = _tasks(n)
    share = F.pmod("number1", F.lit(_shares(tasks, 1 + n // BLOCK)))
    ranked = own.withColumn("rank", F.row_number().over(Window.orderBy("number")).cast("long") - 1)
    members = F.sort_array(F.collect_list(F.struct(*own.columns)))
    blocks = ranked.groupBy(F.floor(F.col("rank") / BLOCK).alias("block")).agg(members.alias("members"), F.max("number").alias("last"))
    first = own.select(*[F.col(c).alias(c + "1") for c in own.columns])
    partners = F.filter("members", lambda x: (x["number"] > F.col("number1")) & (x["antenna"] > F.col("antenna1")))
    counts = written(first.repartition(tasks, "number1").join(F.broadcast(blocks), F.col("last") > F.col("number1")).select("number1", "block", F.size(partners).alias("n")).where("n > 0"), "partners")
    crosses = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = counts.groupBy("number1").agg(F.sum("n").alias("all")).select("number1", before("all", Window.orderBy("number1")).alias("begin"))
    starts = counts.join(per, "number1").withColumn("start", F.col("begin") + before("n", Window.partitionBy("number1").orderBy("block")))
    dealt = starts.join(first, "number1").repartition(tasks, "block", share).crossJoin(F.broadcast(_products(own.sparkSession))).join(F.broadcast(blocks), "block").withColumn("partners", partners)
    pairs = dealt.select("k", *first.columns, "start", F.posexplode("partners").alias("place", "x"))
    names = lambda df, k, of: [F.col(of("number")).alias(f"n{k}"), *[F.col(of(p)).alias(f"{p}{k}") for p in "hv"]]
    cross = pairs.select("k", *names(pairs, 1, lambda c: c + "1"), *names(pairs, 2, lambda c: f"x.{c}"), (F.col("start") + F.col("place") + 4 * n).alias("at"), F.lit(crosses).alias("step"))
    auto = ranked.crossJoin(F.broadcast(_products(own.sparkSession))).select("k", *names(ranked, 1, str), *names(ranked, 2, str), F.col("rank").alias("at"), F.lit(n).cast("long").alias("step"))
    bl = (F.col("at") + F.col("k") * F.col("step")).cast("int" if 4 * (n + crosses) < 1 << 31 else "long")
    shape = lambda df: df.select(_cbf_bl(), _input(1).alias("input1"), _input(2).alias("input2"), bl.alias("bl"))
    return shape(auto).union(shape(cross))


def groups(labelled: DataFrame, key: str = "bl") -> DataFrame:
    """(key, grp): the overlapping classes that quick-look percentiles are taken over."""
    df = _parts(labelled)
    kind = F.when(F.col("ant1") == F.col("ant2"), "auto").otherwise("cross")
    first, second = (F.when(F.col(p) == "h", "h").otherwise("v") for p in ("pol1", "pol2"))
    pols = F.when(first == second, F.concat(first, second)).otherwise("hv")
    return df.select(key, F.explode(F.array(kind, F.concat(kind, pols))).alias("grp"))


def grouped_pairs(antennas: DataFrame) -> DataFrame:
    """(cbf_bl, grp): ``groups`` of the baselines that ``kept`` leaves of ``generate(antennas)``, by pairs of antennas."""
    own = antennas.select("number", "antenna")
    pols = F.element_at(F.array(*[F.lit(p + q if p == q else "hv") for p, q in PRODUCTS]), F.col("k").cast("int") + 1)
    # A pair's four products in one group, then in the other: numbers that repeat so compress better than one by one.
    both = antennas.sparkSession.range(0, 2, 1, 1).crossJoin(F.broadcast(_products(antennas.sparkSession, pols=pols))).withColumn("pols", F.when(F.col("id") == 1, F.col("pols")).otherwise(""))
    products = both.select("k", F.concat(F.lit("auto"), "pols").alias("auto"), F.concat(F.lit("cross"), "pols").alias("cross"))
    grp = F.when(F.col("ant1") == F.col("ant2"), F.col("auto")).otherwise(F.col("cross"))
    return _each_product(_pairs(own, own).where("ant2 >= ant1"), products).select("cbf_bl", grp.alias("grp"))


def check_contiguous(grouped: DataFrame) -> None:
    """Raise if a group's baselines (bl, grp) are not one run of numbers, as the output order makes them. Groups are a handful."""
    per = grouped.groupBy("grp").agg(F.min("bl").alias("a"), F.max("bl").alias("b"), F.count_distinct("bl").alias("n")).where("b - a + 1 <> n")
    if broken := sorted(r["grp"] for r in per.collect()):
        raise ValueError(f"baselines of {', '.join(broken)} are not contiguous")


def lengths(labelled: DataFrame, antennas: DataFrame) -> DataFrame:
    """``length_m`` between a baseline's antennas."""
    at = lambda k: antennas.select(F.col("antenna").alias(f"ant{k}"), *[F.col(c).alias(f"{c}{k}") for c in ("east", "north", "up")])
    df = _parts(labelled).join(at(1), "ant1").join(at(2), "ant2")
    square = lambda c: (F.col(f"{c}1") - F.col(f"{c}2")) * (F.col(f"{c}1") - F.col(f"{c}2"))
    return df.select("cbf_bl", "ant1", "ant2", F.sqrt(square("east") + square("north") + square("up")).alias("length_m"))


def measured_pairs(antennas: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """(n1, n2, ant1, ant2, length_m): pairs of antennas that ``kept`` leaves, with ``lengths``; the four products of a pair share it."""
    places = (antennas if places is None else places).select("antenna", "east", "north", "up")
    own = antennas.select("number", "antenna").join(places, "antenna")
    square = lambda c: (F.col(f"{c}1") - F.col(f"{c}2")) * (F.col(f"{c}1") - F.col(f"{c}2"))
    return _pairs(own, own).where("ant2 >= ant1").select("n1", "n2", "ant1", "ant2", F.sqrt(square("east") + square("north") + square("up")).alias("length_m"))


def pair_lengths(measured: DataFrame) -> DataFrame:
    """``lengths`` of the baselines of ``measured_pairs``."""
    return _each_product(measured).select("cbf_bl", "ant1", "ant2", "length_m")


def channel_axis(spark, n_channels: int, centre: float, bandwidth: float, factor: int = 1) -> DataFrame:
    """(channel, frequency, width): the band's channels, or groups of ``factor`` of them."""
    width = bandwidth / n_channels
    first = centre - bandwidth / 2 + width * (factor - 1) / 2
    return spark.range(n_channels // factor).select(F.col("id").cast("int").alias("channel"), (F.lit(first) + F.col("id") * F.lit(width * factor)).alias("frequency"), F.lit(width * factor).alias("width"))


@dataclass(frozen=True)
class Axis:
    """A regular frequency axis: ``n`` channels as ``channel_axis`` has them."""

    n: int
    first: float
    width: float

    @classmethod
    def of(cls, n_channels: int, centre: float, bandwidth: float) -> Axis:
        return cls(n_channels, centre - bandwidth / 2, bandwidth / n_channels)

    @classmethod
    def read(cls, channels: Axis | DataFrame) -> Axis:
        """An axis as it is, or that of a table of channels (channel, frequency, width), of which one row comes to the driver."""
        if isinstance(channels, Axis):
            return channels
        row = channels.agg(F.count("*").alias("n"), F.min("frequency").alias("first"), F.first("width").alias("width")).first()
        return cls(row["n"], row["first"], row["width"])

    def low(self, i: Column) -> Column:
        return self.frequency(i) - F.lit(self.width) / 2

    def high(self, i: Column) -> Column:
        return self.frequency(i) + F.lit(self.width) / 2

    def frequency(self, i: Column) -> Column:
        return F.lit(self.first) + i * F.lit(self.width)

    def _edge(self, guess: Column, holds: Callable[[Column], Column], from_above: bool) -> Column:
        """Near ``guess``, which rounding may have moved by one, the last channel from above (or the first from below) for which a monotone condition holds."""
        near = F.transform(F.array(*[F.lit(k) for k in (-2, -1, 0, 1, 2)]), lambda k: guess + k)
        holding = F.filter(near, holds)
        return F.array_max(holding) if from_above else F.array_min(holding)

    def between(self, reaches: Callable[[Column], Column], begins: Callable[[Column], Column], lowest: Column, highest: Column) -> tuple[Column, Column]:
        """First and last channel of a range from frequency ``lowest`` to ``highest``; the conditions say exactly whether channel i's upper edge reaches it and its lower edge begins before its end."""
        clamp = lambda c: F.least(F.greatest(c, F.lit(-4.0)), F.lit(float(self.n + 4)))
        at = lambda f: clamp((f - F.lit(self.first)) / F.lit(self.width)).cast("long")
        first = F.greatest(self._edge(at(lowest), reaches, False), F.lit(0).cast("long"))
        last = F.least(self._edge(at(highest), begins, True), F.lit(self.n - 1).cast("long"))
        return first, last


def covered(ranges: DataFrame, n: int, value: str | None = None) -> DataFrame:
    """(channel, value): the channels that ranges (first, last, value) cover, with the greatest value over each.

    A range becomes at most two aligned blocks of channels of each power of two; blocks combine map-side to fewer than 2n rows,
    and each channel looks up the blocks that it lies in by equality. The work is the ranges times log n, not times the channels.
    """
    bits = max(1, (n - 1).bit_length())
    # Going up the levels, an odd first and an even last block stand alone; what is left between goes on to the level above.
    a, b = F.col("first"), F.col("last") + 1
    blocks = []
    for level in range(bits + 1):
        low, high = F.shiftright(a + F.lit((1 << level) - 1), level), F.shiftright(b, level)
        blocks.append(F.when((low < high) & (low % 2 == 1), F.struct(F.lit(level).alias("level"), low.alias("block"))))
        blocks.append(F.when((low < high) & (high % 2 == 1), F.struct(F.lit(level).alias("level"), (high - 1).alias("block"))))
    greatest = [F.max(value).alias(value)] if value else []
    parts = ranges.where("first <= last").select(F.inline(F.array_compact(F.array(*blocks))), *([value] if value else []))
    parts = parts.groupBy("level", "block").agg(*greatest) if greatest else parts.distinct()
    channels = ranges.sparkSession.range(n).select(F.col("id").alias("channel"), F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("level")).withColumn("block", F.expr("shiftright(channel, level)"))
    found = channels.join(parts, ["level", "block"]).groupBy(F.col("channel").cast("int").alias("channel"))
    return found.agg(*greatest) if greatest else found.agg(F.lit(1)).select("channel")


def interference_reach(channels: Axis | DataFrame, model: DataFrame) -> DataFrame:
    """(channel, reach): the longest baseline that interference (fmin, fmax, max_baseline) touches in each channel that a range overlaps. The model may be of any size."""
    axis = Axis.read(channels)
    first, last = axis.between(lambda i: axis.high(i) >= F.col("fmin"), lambda i: axis.low(i) <= F.col("fmax"), F.col("fmin"), F.col("fmax"))
    ranges = model.select(first.alias("first"), last.alias("last"), "max_baseline")
    return covered(ranges, axis.n, "max_baseline").withColumnRenamed("max_baseline", "reach")


#: Lengths are binned by four parts of each doubling; longer ones share the last bin.
LAST_BIN = 255


def _bin(length: Column) -> Column:
    return F.least(F.floor(F.log2(F.greatest(length, F.lit(0.0)) + 1) * 4), F.lit(LAST_BIN)).cast("int")


#: Rows of channels by bin up to which they are broadcast.
BROADCAST_ROWS = 1 << 20


def range_mask(measured: DataFrame, reach: DataFrame, mask_autos: bool = False) -> DataFrame:
    """(cbf_bl, channel): what the interference model masks; whether an antenna with itself is, the model says.

    Channels meet the baselines of their reach's bin, where lengths are compared, and of all bins below, by equality of bins. Of ``measured_pairs``
    each pair meets them once. There are a few bins of many baselines, so channels are broadcast unless they are too many.
    """
    wide = reach.where("reach >= 0").select("channel", "reach", F.explode(F.sequence(F.lit(0), _bin(F.col("reach")))).alias("bin"))
    own = (measured if mask_autos else measured.where("ant1 <> ant2")).withColumn("bin", _bin(F.col("length_m")))
    found = own.join(F.broadcast(wide) if wide.count() <= BROADCAST_ROWS else wide, "bin").where("length_m <= reach")
    return (found if "cbf_bl" in measured.columns else _each_product(found)).select("cbf_bl", "channel")


def band_mask(channels: Axis | DataFrame, model: DataFrame, centre: float | None = None, bandwidth: float | None = None) -> DataFrame:
    """Channels whose extent overlaps one of the model's (min_fraction, max_fraction) of the band, which is the axis's own if none is given."""
    axis = Axis.read(channels)
    bandwidth = axis.width * axis.n if bandwidth is None else bandwidth
    begin = axis.first if centre is None else centre - bandwidth / 2
    low = lambda i: (axis.low(i) - F.lit(begin)) / F.lit(bandwidth)
    high = lambda i: (axis.high(i) - F.lit(begin)) / F.lit(bandwidth)
    at = lambda c: F.lit(begin) + F.col(c) * F.lit(bandwidth)
    first, last = axis.between(lambda i: high(i) >= F.col("min_fraction"), lambda i: low(i) <= F.col("max_fraction"), at("min_fraction"), at("max_fraction"))
    return covered(model.select(first.alias("first"), last.alias("last")), axis.n)


def unique_masks(masked: DataFrame, all_baselines: DataFrame) -> DataFrame:
    """(cbf_bl, mask_id, channels): each baseline's list of masked channels, equal lists under one number."""
    lists = masked.groupBy("cbf_bl").agg(F.array_join(F.sort_array(F.collect_set("channel")), ",").alias("channels"))
    rows = all_baselines.select("cbf_bl").join(lists, "cbf_bl", "left").withColumn("channels", F.coalesce("channels", F.lit("")))
    numbered = rows.select("channels").distinct().withColumn("mask_id", F.row_number().over(Window.orderBy("channels")) - 1)
    return rows.join(F.broadcast(numbered), "channels").select("cbf_bl", "mask_id", "channels")


def pair_masks(measured: DataFrame, reach: DataFrame) -> DataFrame:
    """``unique_masks`` of the interference model for ``measured_pairs``, by what masks depend on: the least reach that a length lies within.

    There are no more masks than different reaches, and one for what none covers. Those that occur are found map-side; no baseline is exchanged.
    """
    reach = written(reach.where("reach >= 0"), "reach").withColumn("own", _bin(F.col("reach")))
    inside = F.collect_set(F.when(F.col("own") == F.col("bin"), F.col("reach")))
    above = F.min(F.when(F.col("own") > F.col("bin"), F.col("reach")))
    levels = reach.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("own")))).groupBy("bin").agg(F.array_compact(F.concat(inside, F.array(above))).alias("levels"))
    # A bin's levels as steps of lengths, of which a length lies in one at most: a join compares faster than a function on arrays.
    steps = F.transform("levels", lambda r, i: F.struct(F.when(i > 0, F.element_at("levels", i)).otherwise(F.lit(-1.0)).alias("low"), r.alias("level")))
    steps = levels.withColumn("levels", F.sort_array("levels")).select(F.col("bin").alias("of"), F.inline(steps))
    within = (F.col("bin") == F.col("of")) & (F.col("length_m") > F.col("low")) & (F.col("length_m") <= F.col("level")) & (F.col("ant1") != F.col("ant2"))
    own = measured.withColumn("bin", _bin(F.col("length_m"))).join(F.broadcast(steps), within, "left").select("n1", "n2", F.coalesce("level", F.lit(-1.0)).alias("level"))
    seen = own.select("level").distinct()
    lists = seen.where("level >= 0").join(reach, F.col("reach") >= F.col("level")).groupBy("level").agg(F.array_join(F.sort_array(F.collect_set("channel")), ",").alias("channels"))
    named = seen.join(lists, "level", "left").select("level", F.coalesce("channels", F.lit("")).alias("channels"))
    numbered = written(named.withColumn("mask_id", F.dense_rank().over(Window.orderBy("channels")) - 1), "masks")
    return _each_product(own.join(F.broadcast(numbered), "level")).select("cbf_bl", "mask_id", "channels")


def plan_masks(masked: DataFrame, all_baselines: DataFrame, key: str = "cbf_bl") -> tuple[DataFrame, DataFrame]:
    """Masks for a plan: (key, mask_id) of all baselines, and (mask_id, channel) of their channels. ``masked``: key, channel.

    A baseline's channels are bitmaps, one for each 32,768 channels, which combine map-side; baselines with equal bitmaps share a mask, numbered
    by the smallest of them. Nothing is sorted or numbered in one task. Baselines without masked channels are under mask -1.
    """
    at = F.col("channel").cast("long") + 1
    parts = masked.groupBy(key, F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    its = parts.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias("bitmap"))
    numbered = its.groupBy("bitmap").agg(F.min(key).cast("long").alias("mask_id"))
    own = its.join(numbered, "bitmap").select(key, "mask_id")
    ids = all_baselines.select(key).join(own, key, "left").select(key, F.coalesce("mask_id", F.lit(-1)).alias("mask_id"))
    firsts = numbered.select(F.col("mask_id").alias("_first"))
    channels = masked.join(firsts, F.col(key) == F.col("_first"), "left_semi").select(F.col(key).cast("long").alias("mask_id"), "channel").distinct()
    return ids, channels
