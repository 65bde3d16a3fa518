"""Pair statistics of items that share a group, by sparse counting.

Basket lift needs, for every item pair, the number of groups (orders) holding
both; the sales screen needs, for every pair, the co-moments of two value
series over the groups (days) where both occur. A self-join on the group
sends one row through the shuffle for each pair and group; here each task
forms the pairs of its groups in numpy, chunk by chunk, and folds equal pairs
before anything is shuffled.

A group of more than ``WIDE`` items is split: its items are hashed to blocks
of about WIDE items and every pair of blocks (i <= j) is a unit of its own,
dealt over the tasks, so one huge group is many units of bounded size. All
other groups are formed where the count of their items put them; only the
wide ones are shuffled again. A task holds one unit, ``PAIRS`` pairs of a
chunk and at most ``HELD`` folded pairs (about 200 MB at the defaults),
whatever the catalogue or the group.

Co-moments are centred: each chunk gives (n, mean, sum of squared deviations,
sum of products of deviations) of a pair, and partial results are merged by
the pairwise update, in the task and in the final aggregate, so nothing
cancels when values are large and vary little.

The caller guarantees one row for each (group, item); null groups hold no
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.session import dealt

WIDE = 1024
PAIRS = 1 << 20
HELD = 1 << 20

_COUNTS = "item_a long, item_b long, n long"
_MOMENTS = _COUNTS + ", mean_a double, mean_b double, m2_a double, m2_b double, c_ab double"
_STATS = ["mean_a", "mean_b", "m2_a", "m2_b", "c_ab"]


def _grouped(pairs: pd.DataFrame) -> pd.DataFrame:
    """Partial rows of equal pairs merged (pairwise update of mean, M2 and C)."""
    order = np.lexsort((pairs["item_b"].to_numpy(), pairs["item_a"].to_numpy()))
    pairs = pairs.iloc[order]
    a, b = pairs["item_a"].to_numpy(), pairs["item_b"].to_numpy()
    start = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    n = pairs["n"].to_numpy()
    total = np.add.reduceat(n, start)
    out = {"item_a": a[start], "item_b": b[start], "n": total}
    if "mean_a" in pairs:
        sizes = np.diff(np.append(start, len(n)))
        mean, apart = {}, {}
        for s in "ab":
            own = pairs[f"mean_{s}"].to_numpy()
            first = own[start]                                   # shift: deviations from the first partial mean
            shifted = own - np.repeat(first, sizes)
            mean[s] = np.add.reduceat(n * shifted, start) / total
            apart[s] = shifted - np.repeat(mean[s], sizes)
            out[f"mean_{s}"] = first + mean[s]
        for s in "ab":
            out[f"m2_{s}"] = np.add.reduceat(pairs[f"m2_{s}"].to_numpy() + n * apart[s] ** 2, start)
        out["c_ab"] = np.add.reduceat(pairs["c_ab"].to_numpy() + n * apart["a"] * apart["b"], start)
    return pd.DataFrame(out)


def _chunk(items: np.ndarray, values: np.ndarray | None, low: np.ndarray, high: np.ndarray, rows: slice) -> pd.DataFrame:
    """Folded pairs of the rows in ``rows`` with their partner rows [low, high)."""
    count = high[rows] - low[rows]
    one = np.repeat(np.arange(rows.start, rows.stop), count)
    two = np.arange(len(one)) - np.repeat(np.cumsum(count) - count - low[rows], count)
    swap = items[one] > items[two]
    one, two = np.where(swap, two, one), np.where(swap, one, two)
    found = {"item_a": items[one], "item_b": items[two], "n": np.ones(len(one), dtype=np.int64)}
    if values is not None:
        zero = np.zeros(len(one))
        found |= {"mean_a": values[one], "mean_b": values[two], "m2_a": zero, "m2_b": zero, "c_ab": zero}
    return _grouped(pd.DataFrame(found))


def _make_task(unit_cols: Sequence[str], item: str, value: str | None):
    def form(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Folded pairs of whole units, a bounded chunk at a time."""
        unit = pdf.groupby(list(unit_cols), sort=False, dropna=False).ngroup().to_numpy()
        side = pdf["_side"].to_numpy() if "_side" in pdf else np.zeros(len(pdf), dtype=np.int64)
        order = np.lexsort((side, unit))
        unit, side = unit[order], side[order]
        items = pdf[item].to_numpy(dtype=np.int64)[order]
        values = pdf[value].to_numpy(dtype=np.float64)[order] if value else None
        place = np.arange(len(unit))
        high = np.searchsorted(unit, unit, side="right")
        low = place + 1
        if "_cross" in pdf:                                        # a unit of two blocks: only pairs across
            cross = pdf["_cross"].to_numpy()[order]
            other = np.searchsorted(2 * unit + side, 2 * unit + 1, side="left")
            low = np.where(cross, np.where(side == 0, other, high), low)
        done = np.concatenate(([0], np.cumsum(high - low)))
        at = 0
        while at < len(unit):
            stop = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
            if done[stop] > done[at]:
                yield _chunk(items, values, low, high, slice(at, stop))
            at = stop

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, held, size = None, [], 0
        for pdf in _then_none(batches):
            if pdf is None:
                whole = rest
            else:
                # The last unit may go on in the next Arrow batch: hold it back.
                pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
                tail = np.ones(len(pdf), dtype=bool)
                for c in unit_cols:
                    tail &= (pdf[c] == pdf[c].iloc[-1]).to_numpy()
                whole, rest = pdf[~tail], pdf[tail]
            if whole is None or not len(whole):
                continue
            for found in form(whole):
                held.append(found)
                size += len(found)
                if size > HELD:
                    held = [_grouped(pd.concat(held, ignore_index=True))]
                    size = len(held[0])
                    if size > HELD // 2:
                        yield held[0]
                        held, size = [], 0
        if held:
            yield _grouped(pd.concat(held, ignore_index=True))

    return task


def _then_none(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    """The batches that hold rows, then None."""
    for batch in batches:
        if len(batch):
            yield batch
    yield None


def _partial(rows: DataFrame, group_cols: Sequence[str], item: str, value: str | None, schema: str,
             parts: int | None = None) -> DataFrame:
    groups = list(group_cols)
    cols = [*groups, item] + ([value] if value else [])
    counted = (dealt(rows.select(*cols).dropna(subset=groups), parts, *groups)
               .withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(*groups))))
    narrow = (counted.where(F.col("_k") <= WIDE).drop("_k").sortWithinPartitions(*groups)
              .mapInPandas(_make_task(groups, item, value), schema))
    blocks = F.ceil(F.col("_k") / WIDE).cast("int")
    own = F.pmod(F.xxhash64(item), F.col("_b").cast("long")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("_b") - 1), lambda y: F.struct(
        F.least(F.col("_x"), y).alias("i"), F.greatest(F.col("_x"), y).alias("j"),
        (F.col("_x") > y).cast("int").alias("s")))
    wide = (counted.where(F.col("_k") > WIDE).withColumn("_b", blocks).withColumn("_x", own)
            .select(*cols, F.explode(cells).alias("c"))
            .select(*cols, F.col("c.i").alias("_i"), F.col("c.j").alias("_j"), F.col("c.s").alias("_side"),
                    (F.col("c.i") != F.col("c.j")).alias("_cross"))
            .repartition(*groups, "_i", "_j").sortWithinPartitions(*groups, "_i", "_j")
            .mapInPandas(_make_task([*groups, "_i", "_j"], item, value), schema))
    return narrow.unionByName(wide)


def pair_counts(rows: DataFrame, group_cols: Sequence[str], item: str, parts: int | None = None) -> DataFrame:
    """(item_a, item_b, n) with item_a < item_b: groups that hold both items.
    ``rows``: one row for each (group, item), items numbered; their groups are
    dealt in ``parts`` partitions (default: as the session does)."""
    return _partial(rows, group_cols, item, None, _COUNTS, parts).groupBy("item_a", "item_b").agg(F.sum("n").alias("n"))


def pair_comoments(rows: DataFrame, group_cols: Sequence[str], item: str, value: str) -> DataFrame:
    """item_a, item_b, n, mean_a, mean_b, m2_a, m2_b, c_ab: centred co-moments
    of the two items' values over the groups that hold both."""
    partial = _partial(rows, group_cols, item, value, _MOMENTS)
    # A pair has at most one partial row for each task and flush.
    parts = F.collect_list(F.struct("n", *_STATS))
    merged = F.aggregate(parts, F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(s) for s in _STATS]), _merge)
    return partial.groupBy("item_a", "item_b").agg(merged.alias("m")).select("item_a", "item_b", "m.*")


def _merge(x: Column, y: Column) -> Column:
    """Pairwise update of two partial co-moment structs."""
    n = x["n"] + y["n"]
    da, db = y["mean_a"] - x["mean_a"], y["mean_b"] - x["mean_b"]
    share = y["n"] / n
    weight = x["n"] * share
    return F.struct(n.alias("n"), (x["mean_a"] + da * share).alias("mean_a"), (x["mean_b"] + db * share).alias("mean_b"),
                    (x["m2_a"] + y["m2_a"] + weight * da * da).alias("m2_a"),
                    (x["m2_b"] + y["m2_b"] + weight * db * db).alias("m2_b"),
                    (x["c_ab"] + y["c_ab"] + weight * da * db).alias("c_ab"))


def pearson(m2_a: Column, m2_b: Column, c_ab: Column) -> Column:
    """Pearson correlation from centred co-moments; NULL when a series is constant."""
    spread = F.sqrt(m2_a) * F.sqrt(m2_b)
    return F.when(spread > 0, c_ab / spread)
