"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so the similarity of whole sets says
nothing; what counts is containment, the share of an item's shingles that a
document holds. Items are partitioned by set size into classes (2^i, 2^(i+1)].
An item's signature is its bottom-m MinHash sketch, the m smallest shingle
hashes, with m = u - ceil(threshold * u) + 1 for the upper size u of its class.
A document that holds ``threshold`` of the item lacks at most q - ceil(threshold * q)
of its q <= u shingles and so holds at least one of the m smallest: no
containment is missed. Candidates are then verified by exact counts of shared
shingles.

An item of q words, fewer than a shingle has, is one shingle of q words. Documents
are searched for windows of those lengths too, of which there are k - 1 at most.

Documents are scanned once. Two bitmaps, of all signature hashes and of all item
hashes, are broadcast; they are sized by the items, up to 8 MB each. A document
without a signature hit emits nothing; others emit the item shingles they hold, and
an equi-join with the item table does the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import arrays as A
from tillroll.llm.membership import in_bitmap, sized_bitmap
from tillroll.llm.scratch import free_name, ready, written

SHINGLE = 5
PERCENT = 80
#: the item shingles are broadcast to the join up to so many rows (about 20 MB)
BROADCAST_ROWS = 200_000
#: bytes that make words, after lower-casing: a-z, 0-9 and every non-ASCII byte
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _windows(column: pa.Array, k: int, shorter: tuple[int, ...] = ()):
    """Hashes of the k-word windows of all rows of a block, and each row's part of them.
    Of a row with fewer words its whole sequence is one. ``shorter``: lengths below k
    whose windows every row has as well."""
    raw, offsets = A.utf8(pc.utf8_lower(pc.cast(column, pa.large_string())))
    starts, ends, first = A.spans(_WORD[raw], offsets)
    h = A.span_hash(raw, starts, ends)
    win, row = [], []
    for q in (*sorted(shorter), k):
        hashes, count = A.windows(h, first, q)
        with np.errstate(over="ignore"):
            win.append(hashes if q == k else A.mix(hashes + np.uint64(q)))
        row.append(np.repeat(np.arange(len(count)), count))
    n = np.diff(first)
    for i in np.flatnonzero((n > 0) & (n < k)):
        few = h[first[i] : first[i + 1]]
        whole, _ = A.windows(few, np.array([0, len(few)]), len(few))
        win.append(A.mix(whole + np.uint64(len(few))))
        row.append(np.array([i]))
    win, row = np.concatenate(win), np.concatenate(row)
    if len(row) and np.any(row[1:] < row[:-1]):
        order = np.argsort(row, kind="stable")
        win, row = win[order], row[order]
    return win, np.searchsorted(row, np.arange(len(n) + 1)), n


def item_shingles(items: DataFrame, item_id: str, text: str, k: int, percent: int) -> DataFrame:
    """_item, _set, _q, _h, _minimum (whether _h is in the item's signature), _words
    (how many words its shingle has)."""
    src = items.select(items[item_id].alias("_item"), items[text].alias("_text"))
    schema = T.StructType([src.schema["_item"], T.StructField("_set", T.BinaryType()), T.StructField("_q", T.LongType()),
                           T.StructField("_h", T.LongType()), T.StructField("_minimum", T.BooleanType()), T.StructField("_words", T.IntegerType())])

    def run(batches):
        import hashlib

        for batch in batches:
            for part in A.blocks(batch, "_text"):
                win, at, n_words = _windows(part.column("_text"), k)
                rows, sets, sizes, hashes, minimum = [], [], [], [], []
                for i in range(part.num_rows):
                    s = np.unique(win[at[i] : at[i + 1]])
                    if not len(s):
                        continue
                    upper = 1 << (len(s) - 1).bit_length()
                    m = upper - (percent * upper + 99) // 100 + 1
                    rows.append(np.full(len(s), i))
                    sets += [hashlib.blake2b(s.tobytes(), digest_size=16).digest()] * len(s)
                    sizes.append(np.full(len(s), len(s)))
                    hashes.append(s)
                    minimum.append(np.arange(len(s)) < m)
                if rows:
                    row = np.concatenate(rows)
                    ids = part.column("_item").take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(sets, pa.binary()), pa.array(np.concatenate(sizes), pa.int64()),
                         pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(minimum)),
                         pa.array(np.minimum(n_words[row], k).astype(np.int32))],
                        names=schema.names)

    return src.mapInArrow(run, schema).distinct()


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
              k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment, text_hash): every
    pair in which the document holds ``percent`` or more of the item's shingles.

    Words are runs of letters and digits of the lower-cased text (ASCII signs and
    white space separate). An item of fewer than k words is one shingle of all its
    words, found wherever a document has those words in a row. Null and empty
    texts hold nothing and are found nowhere. Repeated rows of either side give a
    pair once; rows that share an id but not a text are searched apart. Empty
    tables give an empty result; other columns aren't read.
    """
    ready(docs.sparkSession)
    table = written(item_shingles(items, item_id, text, k, percent), "item-shingles")
    sc = docs.sparkSession.sparkContext
    minima = sc.broadcast(sized_bitmap(table.where("_minimum").select("_h").distinct()))
    whole = sc.broadcast(sized_bitmap(table.select("_h").distinct()))
    shorter = tuple(r[0] for r in table.where(F.col("_words") < k).select("_words").distinct().collect())
    src = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text"), F.xxhash64(docs[text]).alias("_hash"))
    schema = T.StructType([src.schema["_id"], T.StructField("_hash", T.LongType()), T.StructField("_held", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            for part in A.blocks(batch, "_text"):
                win, at, _ = _windows(part.column("_text"), k, shorter)
                found = np.flatnonzero(in_bitmap(*minima.value, win))
                rows = np.unique(np.searchsorted(at, found, "right") - 1)
                held = []
                for i in rows:
                    s = win[at[i] : at[i + 1]]
                    held.append(np.unique(s[in_bitmap(*whole.value, s)]).view(np.int64))
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(take), part.column("_hash").take(take), pa.array(held, pa.list_(pa.int64()))],
                    names=schema.names)

    hits = src.mapInArrow(run, schema).select("_id", "_hash", F.explode("_held").alias("_h"))
    wanted = table.drop("_words")
    pairs = (
        hits.join(F.broadcast(wanted) if table.count() <= BROADCAST_ROWS else wanted, "_h")
        .groupBy("_id", "_hash", "_item", "_set", "_q")
        .agg(F.countDistinct("_h").alias("_shared"), F.max("_minimum").alias("_candidate"))
        .where(F.col("_candidate") & (100 * F.col("_shared") >= percent * F.col("_q")))
    )
    return pairs.groupBy("_id", "_hash", "_item").agg(F.max(F.struct((F.col("_shared") / F.col("_q")).alias("c"), "_q", "_shared")).alias("m")).select(
        F.col("_id").alias(doc_id), F.col("_item").alias(item_id), F.col("m._q").alias("n_item_shingles"),
        F.col("m._shared").alias("n_shared"), F.col("m.c").alias("containment"), F.col("_hash").alias("text_hash"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, columns as they were. Null and empty
    texts hold none and stay; rows that repeat stay or go together, and rows that share
    an id but not a text are judged apart; with no items, or no rows, nothing goes."""
    ident, digest = free_name(docs, "leaked_id", "leaked_text")
    leaked = contained(docs, items, doc_id, item_id, text, **options).select(
        F.col(doc_id).alias(ident), F.col("text_hash").alias(digest)).distinct()
    leaked = written(leaked, "leaked")
    return docs.join(leaked, docs[doc_id].eqNullSafe(leaked[ident]) & (F.xxhash64(docs[text]) == leaked[digest]), "left_anti")
