"""Half-open integer ranges: a planning value, and the same algebra over columns."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True, eq=False)
class Range:
    """[start, stop). All empty ranges are equal."""

    start: int
    stop: int

    @classmethod
    def parse(cls, text: str) -> Range:
        """From ``A:B``."""
        parts = text.split(":")
        if len(parts) != 2:
            raise ValueError(f"range {text!r} is not of the form A:B")
        return cls(int(parts[0]), int(parts[1]))

    def __len__(self) -> int:
        return max(0, self.stop - self.start)

    def __bool__(self) -> bool:
        return len(self) > 0

    def __contains__(self, value: int) -> bool:
        return self.start <= value < self.stop

    def __iter__(self) -> Iterator[int]:
        return iter(range(self.start, self.stop))

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Range) and ((not self and not other) or self.astuple() == other.astuple())

    def __hash__(self) -> int:
        return hash(self.astuple() if self else ())

    def astuple(self) -> tuple[int, int]:
        return self.start, self.stop

    def asslice(self) -> slice:
        if self.start < 0:
            raise ValueError("a slice cannot start below 0")
        return slice(self.start, self.stop)

    def issubset(self, other: Range) -> bool:
        return not self or (other.start <= self.start and self.stop <= other.stop)

    def issuperset(self, other: Range) -> bool:
        return other.issubset(self)

    def isaligned(self, size: int) -> bool:
        return not self or (self.start % size == 0 and self.stop % size == 0)

    def alignto(self, size: int) -> Range:
        """The smallest aligned range around this one."""
        return Range(self.start // size * size, -(-self.stop // size) * size) if self else self

    def intersection(self, other: Range) -> Range:
        both = Range(max(self.start, other.start), min(self.stop, other.stop))
        return both if both else Range(0, 0)

    def union(self, other: Range) -> Range:
        """The smallest range around both."""
        if not self or not other:
            return self or other
        return Range(min(self.start, other.start), max(self.stop, other.stop))

    def relative_to(self, other: Range) -> Range:
        """Positions within ``other``, which must hold this range."""
        if not self.issubset(other):
            raise ValueError(f"{self} is not inside {other}")
        return Range(self.start - other.start, self.stop - other.start)

    def split(self, parts: int, index: int) -> Range:
        """One of ``parts`` equal pieces."""
        if len(self) % parts or not 0 <= index < parts:
            raise ValueError(f"{self} has no piece {index} of {parts}")
        size = len(self) // parts
        return Range(self.start + index * size, self.start + (index + 1) * size)


def align_down(value: Column, size: int) -> Column:
    """Largest multiple of ``size`` not above the value; floors, so it holds for negative values too."""
    return (F.floor(value / size) * size).cast("long")


def align_up(value: Column, size: int) -> Column:
    return (F.ceil(value / size) * size).cast("long")


def length(start: Column, stop: Column) -> Column:
    return F.greatest(stop - start, F.lit(0))


@dataclass(frozen=True)
class ChannelRanges:
    """What one of several servers receives, computes and emits, all in channels of the full band.

    The output shares are equal slices of the whole outputs. What is computed covers both shares, aligned
    to both continuum factors; the input adds ``guard`` channels on either side for the detector's windows, and
    the subscription is the input rounded out to whole streams.
    """

    channels: int
    output: Range
    sd_output: Range
    computed: Range
    input: Range
    subscribed: Range
    all_output: Range
    all_sd_output: Range

    @classmethod
    def plan(cls, servers: int, server: int, channels: int, cont_factor: int, sd_cont_factor: int, streams: int, guard: int, all_output: Range, all_sd_output: Range) -> ChannelRanges:
        """``server`` counts from 1."""
        band = Range(0, channels)
        if not 1 <= server <= servers:
            raise ValueError("the server's number is out of range")
        if channels % streams:
            raise ValueError("channels are not a multiple of the streams")
        for name, part, factor in (("output", all_output, cont_factor), ("quick-look output", all_sd_output, sd_cont_factor)):
            if not part.issubset(band):
                raise ValueError(f"{name} channels exceed the band")
            if not part.isaligned(factor):
                raise ValueError(f"{name} channels are not aligned to the continuum factor")
            if len(part) % (servers * factor):
                raise ValueError(f"{name} channels do not divide among the servers")
        output, sd_output = all_output.split(servers, server - 1), all_sd_output.split(servers, server - 1)
        computed = output.union(sd_output).alignto(math.lcm(cont_factor, sd_cont_factor))
        if not computed.issubset(band):
            raise ValueError("computed channels exceed the band")
        wide = Range(computed.start - guard, computed.stop + guard).intersection(band)
        return cls(channels, output, sd_output, computed, wide, wide.alignto(channels // streams), all_output, all_sd_output)


def tune_next(value: int, sizes: tuple[int, ...]) -> int:
    """The smallest size that is not below the value; the value itself beyond all sizes."""
    return min((s for s in sizes if s >= value), default=value)


def averaging_ratio(output_seconds: float, input_seconds: float) -> int:
    """Dumps in an output dump: rounded half to even, one at least."""
    return max(1, round(output_seconds / input_seconds))
