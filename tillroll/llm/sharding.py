"""Sharding by minimax contiguous partition.

Documents with equal text form an atomic group; groups are ordered by the hash
of their text. The smallest capacity at which a greedy left-to-right filling
needs no more than n shards is found by binary search, and the order is cut
there: each cut as near to an equal share as that capacity leaves open.

The driver holds the sums of 2^16 hash ranges. Where a step of the search ends within a
range, the sums of its 256 parts are asked for, then of a part's parts, until a part
is one group. So the partition is exact over groups, and what comes to the driver is
256 sums a question, however many groups a range has.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.scratch import free_name, written

SHARDS = 8
BUCKET_BITS = 16
_MORE_BITS = 8
#: slots are numbered in cells of about so many rows, and at least so many cells a shard
CELL_ROWS, LEAST_CELLS = 20_000, 1024


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1)


class Node:
    """Groups whose keys share their first ``bits`` bits: where they begin in the order
    of all sizes, the sum of them, how many there are and the smallest key."""

    __slots__ = ("bits", "prefix", "begin", "size", "groups", "key", "parts")

    def __init__(self, bits: int, prefix: int, begin: int, size: int, groups: int, key: int):
        self.bits, self.prefix, self.begin, self.size, self.groups, self.key = bits, prefix, begin, size, groups, key
        self.parts: tuple[np.ndarray, list[Node]] | None = None


class Order:
    """Sums over the ordered groups, as fine as was asked for. ``parts_of`` maps nodes to
    the rows (prefix, size, groups, smallest key) of their parts with ``bits`` bits."""

    def __init__(self, coarse: list[tuple], parts_of):
        self.parts_of = parts_of
        top = Node(0, 0, 0, 0, 0, 0)
        self.total = self._set(top, BUCKET_BITS, coarse)
        self.top = top
        self.missing: list[Node] = []

    @staticmethod
    def _set(node: Node, bits: int, rows: list[tuple]) -> int:
        parts, at = [], node.begin
        for prefix, size, groups, key in sorted(rows):
            parts.append(Node(bits, prefix, at, size, groups, key))
            at += size
        node.parts = (np.array([p.begin for p in parts], np.int64), parts)
        return at

    def fetch(self) -> bool:
        """Get the parts that were asked for; whether there were any."""
        wanted, self.missing = list({id(n): n for n in self.missing}.values()), []
        for node, rows in self.parts_of(wanted) if wanted else ():
            self._set(node, node.bits + _MORE_BITS, rows)
        return bool(wanted)

    def around(self, position: int) -> tuple[int, int, int | None]:
        """The last group boundary at or before ``position``, that after it, and the key
        of the group between (None: not known yet, and asked for)."""
        node = self.top
        while True:
            begins, parts = node.parts
            node = parts[int(np.searchsorted(begins, position, "right")) - 1]
            if node.groups == 1:
                return node.begin, node.begin + node.size, node.key
            if node.parts is None:
                self.missing.append(node)
                return node.begin, node.begin + node.size, None

    def floor(self, position: int) -> int:
        """The last group boundary at or before ``position``."""
        return self.total if position >= self.total else self.around(position)[0]

    def ceil(self, position: int) -> int:
        """The first group boundary at or after ``position``."""
        if position <= 0 or position >= self.total:
            return max(0, min(position, self.total))
        low, high, _ = self.around(position)
        return low if low == position else high

    def key_at(self, boundary: int):
        """The key of the group that begins at ``boundary``."""
        return self.around(boundary)[2]


def reaches(order: Order, capacity: int, n: int) -> list[int]:
    """The furthest boundary that 1, 2, ... n shards of ``capacity`` reach."""
    out, at = [], 0
    for _ in range(n):
        at = order.floor(at + capacity)
        out.append(at)
    return out


def settled(order: Order, step):
    """The result of ``step`` once every range that it looks into is known."""
    while True:
        out = step()
        if not order.fetch():
            return out


def smallest_capacity(order: Order, n: int, largest: int) -> int:
    lo, hi = max(largest, -(-order.total // n)), order.total
    while lo < hi:
        mid = (lo + hi) // 2
        if settled(order, lambda: reaches(order, mid, n))[-1] >= order.total:
            hi = mid
        else:
            lo = mid + 1
    return lo


def boundaries(order: Order, n: int, largest: int) -> list[int]:
    """n - 1 cut positions with no shard above the smallest capacity."""
    if order.total == 0:
        return [0] * (n - 1)
    capacity = smallest_capacity(order, n, largest)
    latest = settled(order, lambda: reaches(order, capacity, n))

    def back():
        out, at = [], order.total
        for _ in range(n - 1):
            at = order.ceil(at - capacity)
            out.append(at)
        return out[::-1]

    earliest = settled(order, back)
    cuts, at = [], 0
    for j in range(n - 1):
        share = at + (order.total - at) // (n - j)
        low, high = settled(order, lambda: (order.floor(share), order.ceil(share)))
        near = low if share - low <= high - share else high
        at = int(min(max(near, earliest[j], at), latest[j], settled(order, lambda: order.floor(at + capacity))))
        cuts.append(at)
    return cuts


def _prefix(key: Column, bits: int) -> Column:
    """The first bits of a signed key, ordered like the key."""
    return F.shiftright(key, 64 - bits)


def cut_keys(keyed: DataFrame, n: int) -> list[int]:
    """The keys with which shards 1 ... n - 1 begin (``keyed``: key, size)."""
    spark = keyed.sparkSession
    groups = keyed.groupBy("key").agg(F.sum("size").alias("size"))
    groups = written(groups.repartitionByRange(spark.sparkContext.defaultParallelism, "key").sortWithinPartitions("key"), "groups")
    sums = [F.sum("size"), F.count("*"), F.min("key"), F.max("size")]
    coarse = [tuple(r) for r in groups.groupBy(_prefix(F.col("key"), BUCKET_BITS)).agg(*sums).collect()]

    def parts_of(nodes: list[Node]):
        """256 rows a node at most, for all nodes in one job."""
        jobs: dict[int, list[Node]] = {}
        for node in nodes:
            jobs.setdefault(node.bits, []).append(node)
        for bits, same in jobs.items():
            within = reduce(or_, [F.col("key").between(x.prefix << (64 - bits), ((x.prefix + 1) << (64 - bits)) - 1) for x in same])
            rows = groups.where(within).groupBy(_prefix(F.col("key"), bits + _MORE_BITS)).agg(*sums[:3]).collect()
            by_node: dict[int, list[tuple]] = {x.prefix: [] for x in same}
            for r in rows:
                by_node[r[0] >> _MORE_BITS].append(tuple(r))
            yield from ((x, by_node[x.prefix]) for x in same)

    if not coarse:
        return [None] * (n - 1)
    order = Order([r[:4] for r in coarse], parts_of)
    at = boundaries(order, n, max(r[4] for r in coarse))
    inner = [c for c in at if 0 < c < order.total]
    by_cut = dict(zip(inner, settled(order, lambda: [order.key_at(c) for c in inner])))
    return [by_cut.get(c, -(1 << 63) if c <= 0 else None) for c in at]


def shard(docs: DataFrame, n: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``shard`` (0 ... n - 1)
    and ``slot`` (gapless from 0 in each shard); where ``docs`` has a column of such
    a name, the new one gets underscores in front.

    Equal texts share a shard; null texts are one group, of size 1 each. Repeated
    rows get slots of their own. Fewer groups than shards leave shards empty, and
    an empty table gives an empty result. Slots follow a hash of id and text, in
    cells of about ``CELL_ROWS`` rows that are counted apart, so a group of equal texts
    is not numbered in one task; rows that repeat id and text share a cell.
    """
    size, crc, key, where, slot, cell = free_name(docs, "size", "text_crc32", "shard_key", "shard", "slot", "shard_cell")
    keyed = docs.withColumns({
        size: size_of(docs[text]),
        crc: F.crc32(F.coalesce(docs[text], F.lit(""))),
        key: F.xxhash64(docs[text]),
        cell: F.xxhash64(docs[doc_id], docs[text], F.lit(1)),
    })
    narrow = written(keyed.select(F.col(key).alias("key"), F.col(size).alias("size"), F.col(cell).alias("cell")), "shard-keys")
    cells = F.lit(max(LEAST_CELLS, -(-narrow.count() // (n * CELL_ROWS))))
    narrow, keyed = (df.withColumn(c, F.pmod(F.col(c), cells)) for df, c in ((narrow, "cell"), (keyed, cell)))
    cuts = cut_keys(narrow.select("key", "size"), n)

    def number(k: Column) -> Column:
        out = F.lit(0)
        for c in cuts:
            if c is not None:
                out = out + (k >= F.lit(c)).cast("int")
        return out

    counts = narrow.groupBy(number(F.col("key")).alias("s"), F.col("cell").alias("c")).agg(F.count("*").alias("rows"))
    before = Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.select("s", "c", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shard rows before")), "shard-cells")
    placed = keyed.withColumn(where, number(F.col(key)))
    w = Window.partitionBy(where, cell).orderBy(F.col(doc_id).asc_nulls_first(), key)
    placed = placed.withColumn(slot, F.row_number().over(w) - 1)
    out = placed.join(counts, (F.col(where) == F.col("s")) & (F.col(cell) == F.col("c")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(size), F.col(crc), F.col(where),
                      (F.col(slot) + F.col("shard rows before")).cast("long").alias(slot))
