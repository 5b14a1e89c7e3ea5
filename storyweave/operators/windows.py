"""Closed time windows on ``added_at``. A run is one window, named by its ``begin`` and ``end``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyweave.sources.tables import in_days

RUN = ["begin", "end"]


def _moment(value: datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def window_scan(df: DataFrame, begin, end) -> DataFrame:
    """Rows with ``begin <= added_at <= end``; of a table laid out by day only the folders of these days are read."""
    begin, end = _moment(begin), _moment(end)
    return in_days(df, begin, end).filter(F.col("added_at").between(begin, end))


def windows_scan(df: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows of each of ``windows(begin, end)`` with its bounds. Windows meet rows by day, a column of a table laid out so, and
    Spark prunes the folders by the windows' days where these are few.
    """
    days = F.sequence(F.to_date("begin"), F.to_date("end"))
    asked = windows.select(*RUN, F.explode(days).alias("added_on"))
    held = df if "added_on" in df.columns else df.withColumn("added_on", F.to_date("added_at"))
    return held.join(asked, "added_on").filter(F.col("added_at").between(F.col("begin"), F.col("end"))).select(
        *[c for c in df.columns if c not in ("added_on", "key_part")], *RUN)


def batch_scan(df: DataFrame, tag) -> DataFrame:
    return window_scan(df, tag, tag)


def single_run(df: DataFrame, begin, end) -> DataFrame:
    """The rows of one window, stamped with it."""
    begin, end = _moment(begin), _moment(end)
    return window_scan(df, begin, end).withColumns({"begin": begin, "end": end})


def sliding_windows(df: DataFrame, size: timedelta, slide: timedelta) -> DataFrame:
    """One copy of each row per window holding it; window ends are the multiples of ``slide`` since the epoch.

    Both ends are closed, so a row exactly on a boundary is in one window more than ``F.window`` would give.
    """
    step = int(slide / timedelta(microseconds=1))
    length = int(size / timedelta(microseconds=1))
    at = F.unix_micros("added_at")
    first = -_floor_div(-at, step)
    last = _floor_div(at + length, step)
    end = F.explode(F.sequence(first * step, last * step, F.lit(step)))
    return (df.withColumn("_end", end)
            .withColumns({"begin": F.timestamp_micros(F.col("_end") - length),
                          "end": F.timestamp_micros("_end")})
            .drop("_end"))


@dataclass(frozen=True)
class Panes:
    """Closed windows of ``size`` ending on every multiple of ``slide``, cut into panes that lie wholly in a window or wholly outside.

    Rows exactly on the p-th multiple have pane 2p, those between it and the one before 2p - 1; the window ending with the e-th multiple
    holds the panes 2(e - k) to 2e, for k slides in a size.
    """

    size: timedelta
    slide: timedelta

    def __post_init__(self):
        if self.size % self.slide:
            raise ValueError("the size of a window must be a multiple of its slide")

    @property
    def slides(self) -> int:
        return self.size // self.slide

    @property
    def _step(self) -> int:
        return self.slide // timedelta(microseconds=1)

    def pane(self, at: str = "added_at") -> Column:
        moment = F.unix_micros(at)
        whole = _floor_div(moment, self._step)
        return F.when(F.pmod(moment, F.lit(self._step)) == 0, 2 * whole).otherwise(2 * whole + 1)

    def first_end(self, pane: str = "pane") -> Column:
        """The first multiple that ends a window holding the pane; those holding it end there and on the following ones."""
        return F.ceil(F.col(pane) / 2).cast("long")

    def stretches(self, length: int, pane: str = "pane") -> Column:
        """The numbers of the stretches, ``length`` windows one after another, that hold any window with the pane."""
        last = F.floor(F.col(pane) / 2).cast("long") + self.slides
        return F.sequence(F.floor(self.first_end(pane) / length).cast("long"), F.floor(last / length).cast("long"))

    def bounds(self, end: Column) -> list[Column]:
        """``begin`` and ``end`` of the window that ends with this multiple."""
        last = end * self._step
        return [F.timestamp_micros(last - self.slides * self._step).alias("begin"), F.timestamp_micros(last).alias("end")]

    def holding(self, tags: DataFrame) -> DataFrame:
        """``(begin, end)``: the windows that hold any of the times ``tags(added_at)``, each once."""
        panes = tags.select(self.pane().alias("pane")).distinct()
        last = F.floor(F.col("pane") / 2).cast("long") + self.slides
        ends = panes.select(F.explode(F.sequence(self.first_end(), last)).alias("e")).distinct()
        return ends.select(*self.bounds(F.col("e")))

    def sums(self, counted: DataFrame) -> DataFrame:
        """``(key, pane, sums)`` of ``counted(key, pane, n)``, one row per key and pane: for each window holding the pane, in order of their ends, the sum
        of the key's n over the window. Each is the difference of two running sums over the key's panes.
        """
        k = self.slides

        def of_keys(table: pa.Table) -> pa.RecordBatch:
            key, pane = table.column("key").combine_chunks(), table.column("pane").to_numpy()
            new = np.ones(len(pane), bool)
            new[1:] = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
            # Keys one after another on one axis, so far apart that no window reaches into the next.
            apart = int(pane.max() - pane.min()) + 4 * k + 4
            shift = (np.cumsum(new) - 1) * apart - pane.min() + 2 * k + 1
            place, total = pane + shift, np.concatenate([[0], np.cumsum(table.column("n").to_numpy())])
            first = -(-pane // 2)
            held = pane // 2 + k - first + 1
            offsets = np.concatenate([[0], np.cumsum(held)])
            end = np.repeat(first - offsets[:-1], held) + np.arange(offsets[-1])
            moved = np.repeat(shift, held)
            found = total[np.searchsorted(place, 2 * end + moved, "right")] - total[np.searchsorted(place, 2 * (end - k) + moved, "left")]
            return pa.RecordBatch.from_arrays([key, table.column("pane").combine_chunks(), pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(found, pa.int64()))], names=["key", "pane", "sums"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # The last key of a batch may go on in the next one; a key has a row for each of its panes at most.
            held = None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
                key = held.column("key").combine_chunks()
                done = pc.index(key, key[-1]).as_py()
                if done:
                    yield of_keys(held.slice(0, done))
                    held = held.slice(done)
            if held is not None and held.num_rows:
                yield of_keys(held)

        by_key = counted.select("key", "pane", "n").repartition("key").sortWithinPartitions("key", "pane")
        return by_key.mapInArrow(run, T.StructType([counted.schema["key"], T.StructField("pane", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))]))


def _floor_div(value: Column, step: int) -> Column:
    # Made a multiple first, so that the division is exact.
    return ((value - F.pmod(value, F.lit(step))) / F.lit(step)).cast("long")
