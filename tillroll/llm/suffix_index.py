"""Removal of long repeated passages with a logarithmic family of suffix arrays.

A byte goes if a string of ``MATCH`` bytes that covers it also starts in a document
with a smaller id. Only suffixes that may begin such a string are indexed:

1. Every window of MATCH bytes has an anchor, the leftmost of its 24-byte grams with
   the smallest hash. Equal windows have equal anchors, so a gram that is an anchor in
   one document only can't lie in a repeated window. Neighbouring windows with one
   anchor are a run; the bytes they cover (at most 76) are the run's context.
2. Runs of grams that several documents share are kept with a digest of their
   context. Where contexts are equal the smallest id settles all their windows; most
   of a repeated passage ends here, at one row for about 14 bytes.
3. A gram with several contexts (passage borders, short common phrases) needs its
   windows. Contexts are dealt by gram and come in ascending order of document in
   batches. Each batch gets a suffix array (its windows, sorted) that is
   merge-scanned against the levels of the family; what no level holds becomes a level,
   and levels of about equal size are merged, so a partition of n windows has
   log n levels. A gram with more contexts than a partition's fair share is dealt by
   window instead, with equal windows combined before the shuffle, so no task gets all
   of them.
4. What was found goes back to the documents by id and text digest; runs are computed
   again from the text, so no position is ever shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import arrays as A
from tillroll.llm.membership import in_bitmap, sized_bitmap
from tillroll.llm.scratch import Temporary, ready, written

MATCH, GRAM = 50, 24
RUN = MATCH - GRAM + 1
#: a gram of more contexts than a partition's fair share, and than this, is dealt by window
HOT = 1024
CONTEXTS_A_PARTITION, _BATCH = 50_000, 4096
_PIECE, _FLUSH = 1 << 20, 1 << 20
_PLACE = np.uint64((1 << 21) - 1)  # places within a piece
_rng = np.random.RandomState(20250113)
_ODD = _rng.randint(0, 1 << 62, 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def hash_words(words, start) -> np.ndarray:
    """64-bit hashes of rows of 8-byte words, given column by column."""
    h = start
    with np.errstate(over="ignore"):
        for i, w in enumerate(words):
            h = (h ^ w) * _ODD[i % len(_ODD)]
            h = h ^ (h >> np.uint64(32))
    return h


def hash_rows(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The same of a matrix of bytes."""
    width = -(-rows.shape[1] // 8) * 8
    if width != rows.shape[1]:
        rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    return A.mix(hash_words(np.ascontiguousarray(rows).view(np.uint64).T, start))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every place."""
    n = len(raw) - GRAM + 1
    words = np.ndarray((len(raw) - 7,), np.uint64, np.ascontiguousarray(raw).data, strides=(1,))
    return hash_words((words[i : i + n] for i in range(0, GRAM, 8)), np.uint64(0))


def leftmost_least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest hash in each window of ``width``; hashes count by
    all but their low bits, which give way to the place."""
    least, size = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), 1
    while size < width:
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    return (least & _PLACE).astype(np.int64)


def runs(raw: np.ndarray, offsets: np.ndarray):
    """Pieces (row, first window, windows, hash of the anchor, anchor) of the rows' runs;
    places are bytes of ``raw``. A run that a piece's end cuts is two."""
    for lo in range(0, len(raw), _PIECE):
        part = raw[lo : lo + _PIECE + MATCH - 1]
        if len(part) < MATCH:
            return
        h = gram_hashes(part)
        at = leftmost_least(h, RUN)
        change = np.ones(len(at), bool)
        change[1:] = at[1:] != at[:-1]
        starts = offsets[(offsets >= lo) & (offsets < lo + len(at))] - lo
        change[starts] = True
        begin = np.flatnonzero(change)
        row = np.searchsorted(offsets, begin + lo, "right") - 1
        # windows that end beyond their row are the last of a run
        end = np.minimum(np.append(begin[1:], len(at)), offsets[row + 1] - lo - (MATCH - 1))
        some = end > begin
        begin, end, row = begin[some], end[some], row[some]
        anchor = at[begin]
        yield row, begin + lo, end - begin, h[anchor], anchor + lo


def contexts(piece, raw: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Digests of the contexts of the chosen runs, with the anchor's place in them."""
    _, start, count, _, anchor = (x[which] for x in piece)
    length = count + MATCH - 1
    place = np.arange(RUN + MATCH - 1)
    rows = raw[np.minimum(start[:, None] + place, len(raw) - 1)]
    rows[place >= length[:, None]] = 0
    return hash_rows(rows, A.mix((length * 256 + anchor - start).astype(np.uint64)))


class IndexFamily:
    """Sorted windows with the first document of each, in levels of geometric size."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Index a batch (no document smaller than any earlier one); flags of the windows
        that a smaller document has, in this batch or before."""
        order = np.lexsort((docs, windows.argsort(kind="stable").argsort())) if len(docs) and np.any(np.diff(docs) < 0) else windows.argsort(kind="stable")
        sorted_ = windows[order]
        new = np.ones(len(order), bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        array, first = sorted_[new], docs[order][new]
        known = np.zeros(len(array), bool)
        for level, level_docs in self.levels:
            at = np.minimum(np.searchsorted(level, array), len(level) - 1)
            same = level[at] == array
            first[same] = np.minimum(first[same], level_docs[at[same]])
            known |= same
        flags = np.empty(len(order), bool)
        flags[order] = first[np.cumsum(new) - 1] < docs[order] if len(order) else False
        if not known.all():
            self.levels.append((array[~known], first[~known]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            parts = [self.levels.pop() for _ in range(2)]
            merged, merged_docs = (np.concatenate(x) for x in zip(*parts))
            order = merged.argsort(kind="stable")
            self.levels.append((merged[order], merged_docs[order]))
        return flags


def _window_matrix(ctx: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a column of contexts, the context of each and its place there."""
    flat = pa.concat_arrays([ctx]).cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw = np.frombuffer(flat.buffers()[2], np.uint8)
    count = np.diff(offsets) - (MATCH - 1)
    owner = np.repeat(np.arange(len(flat)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return np.lib.stride_tricks.sliding_window_view(raw, MATCH)[offsets[owner] + place], owner, place


def _masks(owner: np.ndarray, place: np.ndarray, flags: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.bitwise_or.at(out, owner[flags], np.int64(1) << place[flags])
    return out


def _larger(batches, rows: int):
    """The same rows in batches of at least ``rows``, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _merge_scanned(mixed: DataFrame) -> DataFrame:
    """(_g, _c, _mask) of contexts that come dealt by gram, ascending by ``_first``."""
    def run(batches):
        family = IndexFamily()
        for batch in _larger(batches, _BATCH):
            windows, owner, place = _window_matrix(batch.column("_context"))
            docs = batch.column("_first").to_numpy(zero_copy_only=False)[owner]
            flags = family.add(np.ascontiguousarray(windows).view(f"S{MATCH}").ravel(), docs)
            mask = _masks(owner, place, flags, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("_g"), batch.column("_c"), pa.array(mask)], names=["_g", "_c", "_mask"])

    return mixed.select("_g", "_c", "_first", "_context").mapInArrow(run, "_g long, _c long, _mask long")


def _dealt_by_window(hot: DataFrame, kept=written) -> DataFrame:
    """The same for contexts of hot grams: a row for each window, combined by window."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            windows, owner, place = _window_matrix(batch.column("_context"))
            digest = [pa.array(hash_rows(windows, np.full(len(windows), i, np.uint64)).view(np.int64)) for i in (1, 2)]
            own = [batch.column(c).take(pa.array(owner)) for c in ("_g", "_c", "_first")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(place.astype(np.int32)), *digest], names=["_g", "_c", "_first", "_place", "_w1", "_w2"])

    schema = "_g long, _c long, _first long, _place int, _w1 long, _w2 long"
    windows = kept(hot.select("_g", "_c", "_first", "_context").mapInArrow(run, schema), "hot-windows")
    least = windows.groupBy("_w1", "_w2").agg(F.min("_first").alias("_least"), F.max("_first").alias("_most")).where("_least < _most")
    return (
        windows.join(least, ["_w1", "_w2"]).where("_least < _first")
        .groupBy("_g", "_c").agg(F.bit_or(F.expr("shiftleft(1L, _place)")).alias("_mask"))
    )


def _filter(keys: DataFrame) -> tuple:
    """Broadcast bitmap of a column of hashes, and its number of bits."""
    return keys.sparkSession.sparkContext.broadcast(sized_bitmap(keys))


def _scan(src: DataFrame, schema: str, make) -> DataFrame:
    """``make(part, raw, docs, piece)`` for the pieces of every block of texts."""
    def run(batches):
        for batch in batches:
            for part in A.blocks(batch, "_text", _PIECE):
                raw, offsets = A.utf8(part.column("_text"))
                docs = part.column("_doc").to_numpy(zero_copy_only=False)
                for piece in runs(raw, offsets):
                    if len(piece[0]):
                        yield make(part, raw, docs, piece)

    return src.mapInArrow(run, schema)


def _shared_grams(src: DataFrame) -> DataFrame:
    """``_g`` of anchors that two documents have; also some that two rows of one document
    have, which changes no result.

    Nearly all anchors are alone, so they travel as arrays: a row for each block of
    ``_FLUSH`` anchors and range of hashes, with those of one and of more documents.
    """
    spark = src.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * parts
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)

    def once(pieces):
        g, doc = (np.concatenate(x) for x in zip(*pieces))
        order = np.argsort(g)
        g, doc = g[order], doc[order]
        new = np.ones(len(g), bool)
        new[1:] = g[1:] != g[:-1]
        several = np.zeros(len(g), bool)
        several[1:] = ~new[1:] & (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        many = np.logical_or.reduceat(several, first)
        sides = []
        for own in (g[first[~many]], g[first[many]]):
            at = np.concatenate([[0], np.searchsorted(own, edges), [len(own)]])
            sides.append([own[a:b].tobytes() for a, b in zip(at[:-1], at[1:])])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(ranges, dtype=np.int32)), *[pa.array(x, pa.binary()) for x in sides]], names=["_range", "_one", "_many"])

    def deal(batches):
        held, n = [], 0
        for batch in batches:
            for part in A.blocks(batch, "_text", _PIECE):
                raw, offsets = A.utf8(part.column("_text"))
                docs = part.column("_doc").to_numpy(zero_copy_only=False)
                for piece in runs(raw, offsets):
                    held.append((piece[3], docs[piece[0]]))
                    n += len(piece[0])
            if n >= _FLUSH:
                yield once(held)
                held, n = [], 0
        if n:
            yield once(held)

    def meet(batches):
        ones, many = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            for name, to in (("_one", ones), ("_many", many)):
                to += [np.frombuffer(x, np.uint64) for x in batch.column(name).to_pylist() if x]
        one = np.sort(np.concatenate(ones))
        many = np.unique(np.concatenate(many))
        again = np.zeros(len(one), bool)
        again[1:] = one[1:] == one[:-1]
        shared = np.unique(np.concatenate([many, one[again]]))
        for i in range(0, len(shared), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(shared[i : i + (1 << 16)].view(np.int64))], names=["_g"])

    dealt = src.mapInArrow(deal, "_range int, _one binary, _many binary")
    return dealt.repartition(parts, "_range").mapInArrow(meet, "_g long")


def _runs_of(src: DataFrame, shared: tuple) -> DataFrame:
    """The runs of shared grams, once a row: _doc, _part, _g, _c."""
    def make(part, raw, docs, piece):
        pick = np.flatnonzero(in_bitmap(*shared.value, piece[3]))
        c, row = contexts(piece, raw, pick), piece[0][pick]
        order = np.lexsort((c, row))
        new = np.ones(len(order), bool)
        new[1:] = (c[order][1:] != c[order][:-1]) | (row[order][1:] != row[order][:-1])
        once = order[new]
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[row[once]]), part.column("_part").take(pa.array(row[once])), pa.array(piece[3][pick][once].view(np.int64)),
             pa.array(c[once].view(np.int64))], names=["_doc", "_part", "_g", "_c"])

    return _scan(src, "_doc long, _part int, _g long, _c long", make)


def _contexts_of(src: DataFrame, grams: tuple, wanted: tuple) -> DataFrame:
    """Contexts of the filter ``grams``; ``wanted`` is a filter of digest ^ first document, so
    little else than a context's first occurrence passes."""
    def make(part, raw, docs, piece):
        pick = np.flatnonzero(in_bitmap(*grams.value, piece[3]))
        c, doc = contexts(piece, raw, pick), docs[piece[0][pick]]
        ok = in_bitmap(*wanted.value, c ^ doc.view(np.uint64))
        pick, c, doc = pick[ok], c[ok], doc[ok]
        start, end = piece[1][pick], piece[1][pick] + piece[2][pick] + MATCH - 1
        text = raw.tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array(piece[3][pick].view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc),
             pa.array([text[s:e] for s, e in zip(start, end)], pa.binary())], names=["_g", "_c", "_first", "_context"])

    return _scan(src, "_g long, _c long, _first long, _context binary", make)


def _passing(seen: DataFrame, wanted: tuple) -> DataFrame:
    """The rows whose ``_c`` passes a filter."""
    def run(batches):
        for batch in batches:
            c = batch.column("_c").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(in_bitmap(*wanted.value, c)))

    return seen.mapInArrow(run, seen.schema)


def most_contexts(total: int, parts: int) -> int:
    """The contexts up to which a gram is one partition's work."""
    return max(HOT, total // parts)


def repeats(src: DataFrame) -> DataFrame:
    """(_doc, _part, _marks) of the rows of ``src`` (_doc, _part, _text) with repeated
    windows; a mark is a context's digest and the windows of it that go."""
    spark = src.sparkSession
    with Temporary(spark) as kept:
        grams = kept(_shared_grams(src), "shared-grams")
        seen = kept(_runs_of(src, _filter(grams)), "runs")
        kept.drop("shared-grams")
        # equal contexts: all documents after the first one
        firsts = kept(seen.groupBy("_g", "_c").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")), "contexts")
        several = kept(
            firsts.groupBy("_g").agg(F.count("*").alias("_n"), F.min("_first").alias("_lo"), F.max("_first").alias("_hi"))
            .where("_n > 1 and _lo < _hi").select("_g", "_n"), "mixed-grams")
        # different contexts of a gram: window by window, each context once
        wanted = kept(firsts.join(several, "_g").select("_g", "_n", "_c", "_first"), "wanted")
        some = _contexts_of(src, _filter(several.select("_g")), _filter(wanted.select(F.col("_c").bitwiseXOR(F.col("_first")).alias("_k"))))
        mixed = kept(
            some.join(wanted, ["_g", "_c", "_first"]).groupBy("_g", "_c", "_first", "_n").agg(F.any_value("_context").alias("_context")), "mixed-contexts")
        kept.drop("mixed-grams", "wanted")
        total = mixed.count()
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / CONTEXTS_A_PARTITION))
        most = most_contexts(total, parts)
        dealt = mixed.where(F.col("_n") <= most).repartition(parts, "_g").sortWithinPartitions("_first")
        masks = kept(_merge_scanned(dealt).where("_mask <> 0").union(_dealt_by_window(mixed.where(F.col("_n") > most), kept)), "masks")
        kept.drop("mixed-contexts", "hot-windows")
        repeated = firsts.join(masks, ["_g", "_c"], "left").where("_first < _last or _mask is not null")
        repeated = kept(repeated.select("_g", "_c", "_first", "_mask"), "repeated")
        kept.drop("contexts", "masks")
        found = _passing(seen, _filter(repeated.select("_c"))).join(repeated, ["_g", "_c"])
        mark = F.when(F.col("_doc") > F.col("_first"), F.lit(-1)).otherwise(F.col("_mask"))
        marks = (
            found.select("_doc", "_part", F.struct("_c", mark.alias("_windows")).alias("_mark")).where("_mark._windows is not null")
            .groupBy("_doc", "_part").agg(F.collect_set("_mark").alias("_marks"))
        )
        return written(marks, "marks")


def removed_bytes(raw: np.ndarray, offsets: np.ndarray, rows: np.ndarray, digests: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Flags of the bytes of a block of texts that its marks remove; the marks are
    arrays of row, context's digest and windows."""
    if not len(rows):
        return np.zeros(len(raw), bool)
    key = digests ^ A.mix((rows + 1).astype(np.uint64))
    order = np.argsort(key)
    key, rows, digests, windows = key[order], rows[order], digests[order], windows[order]
    marked = np.zeros(len(offsets) - 1, bool)
    marked[rows] = True
    depth = np.zeros(len(raw) + 1, np.int32)
    for piece in runs(raw, offsets):
        pick = np.flatnonzero(marked[piece[0]])
        c, row = contexts(piece, raw, pick), piece[0][pick]
        at = np.minimum(np.searchsorted(key, c ^ A.mix((row + 1).astype(np.uint64))), len(key) - 1)
        hit = (digests[at] == c) & (rows[at] == row)
        start, count, mask = piece[1][pick][hit], piece[2][pick][hit], windows[at[hit]]
        whole = mask == -1
        some = ~whole
        at, place = np.nonzero((mask[some, None] >> np.arange(RUN) & 1).astype(bool) & (np.arange(RUN) < count[some, None]))
        begin = np.concatenate([start[whole], start[some][at] + place])
        end = np.concatenate([start[whole] + count[whole] - 1, start[some][at] + place]) + MATCH
        depth += np.bincount(begin, minlength=len(depth)).astype(np.int32) - np.bincount(end, minlength=len(depth)).astype(np.int32)
    return np.cumsum(depth[:-1]) > 0


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``n_removed``, ``spans`` (start and
    end of each maximal removed run of the text's UTF-8 bytes) and ``kept``, the bytes
    that stay (binary: a cut may fall within a character).

    Matches never cross documents, and are judged on the input. Rows that share an id
    are one document: they remove nothing from each other, and each loses what a smaller
    id has. A row with a null id neither loses nor removes anything. Null and empty
    texts, and texts under 50 bytes, lose nothing. Ids are integers. Empty tables give
    empty results; other columns of ``docs`` aren't read.
    """
    ready(docs.sparkSession)
    # rows of one id fall apart by text, should an id have very many
    part_of = F.hash(docs[text]).alias("_part")
    src = docs.select(docs[doc_id].cast("long").alias("_doc"), part_of, docs[text].alias("_text")).where(
        "_doc is not null and octet_length(_text) >= " + str(MATCH))
    marks = repeats(src)
    rows = docs.select(docs[doc_id].alias("_id"), docs[doc_id].cast("long").alias("_doc"), part_of, docs[text].alias("_text"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        T.StructField("_id", docs.schema[doc_id].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("spans", span), T.StructField("kept", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part in A.blocks(batch, "_text", _PIECE):
                raw, offsets = A.utf8(part.column("_text"))
                found = part.column("_marks")
                flat = found.flatten()
                n_marks = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
                gone = removed_bytes(raw, offsets, np.repeat(np.arange(part.num_rows), n_marks),
                                     flat.field("_c").to_numpy(zero_copy_only=False).view(np.uint64),
                                     flat.field("_windows").to_numpy(zero_copy_only=False))
                start, end, first = A.spans(gone, offsets)
                row = np.repeat(np.arange(part.num_rows), np.diff(first))
                spans = pa.StructArray.from_arrays([pa.array(start - offsets[row]), pa.array(end - offsets[row])], names=["start", "end"])
                before = np.concatenate([[0], np.cumsum(~gone)])[offsets]
                kept = pa.BinaryArray.from_buffers(
                    pa.binary(), part.num_rows, [None, pa.py_buffer(before.astype(np.int32)), pa.py_buffer(raw[~gone])])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(np.diff(offsets)), pa.array(np.diff(offsets) - np.diff(before)),
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), spans), kept], names=schema.names)

    both = rows.join(marks, ["_doc", "_part"], "left").select("_id", "_text", "_marks")
    return both.mapInArrow(run, schema).withColumnRenamed("_id", doc_id)
