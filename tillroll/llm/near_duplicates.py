"""Near-duplicate components by banded MinHash with odd sketches.

1. A scan turns every whole text into its set of k-word shingles, a MinHash
   signature of ``BANDS`` x ``ROWS`` values, band keys, and an odd sketch: sample i
   with value v flips bit h(i, v) of a bitmap, so equal samples of two documents
   cancel in the XOR and the population count z of the XOR estimates the
   similarity, J ~ 1 + n / (4 s) * ln(1 - 2 z / n) for s samples and n bits.
   A second odd sketch takes every shingle as a sample. The XOR then has at most
   as many bits as the sets differ in shingles, so a count above the difference
   that the threshold allows, (100 - p) / (100 + p) of both sizes, is proof that
   the pair is no link.
2. Documents with the same shingle set are one node, named by the smallest id.
3. Nodes that share a band key are candidates. Of each bucket the smallest node
   is the centre; each node is first paired with the smallest centre whose odd
   sketch leaves J >= 0.8 possible. Pairs are confirmed on full shingle sets.
4. Then every pair of one bucket whose ends are not in one component yet is
   compared: odd sketches first, full sets for what they leave. So no candidate
   link between different components is skipped, and a large group of copies
   costs one pair for each copy, not all pairs.

At J = 0.8 two nodes share no band with probability (1 - 0.8^4)^32 < 1e-7; the
sketch bound rejects J below an estimate of 0.55, over five standard deviations
under 0.8.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import arrays as A
from tillroll.llm.components import components
from tillroll.llm.membership import bitmap, has, position
from tillroll.llm.scratch import free_name, ready, written

PERCENT = 80
SHINGLE = 5
BANDS, ROWS = 32, 4
SKETCH_BITS = 512
_SAMPLES = BANDS * ROWS
SET_BITS = 2048
_LONGS = (SKETCH_BITS + SET_BITS) // 64
_CHUNK = 256
_LEAST_ESTIMATE = 0.55
_rng = np.random.RandomState(20240607)
_MUL = _rng.randint(0, 1 << 62, _SAMPLES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.randint(0, 1 << 62, _SAMPLES).astype(np.uint64)


def most_flips(samples: int = _SAMPLES, bits: int = SKETCH_BITS, least: float = _LEAST_ESTIMATE) -> int:
    """The XOR population count above which the estimate is below ``least``."""
    return math.floor(bits / 2 * (1 - math.exp(-4 * samples * (1 - least) / bits)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples (32-bit values as uint64); in blocks, so memory is bounded."""
    out = np.full(_SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 512):
            part = shingles[i : i + 512]
            np.minimum(out, (_MUL[:, None] * part + _ADD[:, None]).min(axis=1), out=out)
    return out >> np.uint64(32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(documents, samples) -> (documents, bands) hashes of band number and values."""
    part = sig.reshape(len(sig), BANDS, ROWS)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(A.mix(np.arange(1, BANDS + 1, dtype=np.uint64)), part.shape[:2]).copy()
        for r in range(ROWS):
            h = A.mix((h ^ part[:, :, r]) * np.uint64(0x9FB21C651E98DF25))
    return h


def odd_sketches(sig: np.ndarray) -> np.ndarray:
    """(documents, samples) -> (documents, longs): bit h(i, v_i) flipped per sample."""
    i = np.arange(_SAMPLES, dtype=np.uint64) << np.uint64(32)
    bit = (A.mix(sig ^ i) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flat = bit + np.arange(len(sig))[:, None] * SKETCH_BITS
    odd = (np.bincount(flat.ravel(), minlength=len(sig) * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sig), SKETCH_BITS), axis=1, bitorder="little").view(np.uint64)


def set_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity bitmap of a whole shingle set."""
    bits = (A.mix(shingles) % np.uint64(SET_BITS)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=SET_BITS) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def sketch(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """_id, _n, _set (digest of the shingle set), _bands, _odd (the odd
    sketches of samples and of the set, joined) of every document."""
    ready(docs.sparkSession)
    src = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        src.schema["_id"], T.StructField("_n", T.LongType()), T.StructField("_set", T.BinaryType()),
        T.StructField("_bands", longs), T.StructField("_odd", T.BinaryType()),
    ])

    def run(batches):
        import hashlib

        for batch in batches:
            for part in A.blocks(batch, "_text"):
                raw, offsets = A.utf8(part.column("_text"))
                n, digests, sigs, sets = [], [], [], []
                for s in A.shingles(A.lower_ascii(raw), offsets, k):
                    n.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sigs.append(signature(s))
                    sets.append(set_sketch(s))
                sig = np.stack(sigs)

                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sig) + 1, dtype=np.int32) * BANDS), pa.array(band_keys(sig).view(np.int64).ravel()))
                odd = np.concatenate([odd_sketches(sig), np.stack(sets)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), bands,
                     pa.array([x.tobytes() for x in odd], pa.binary())],
                    names=schema.names,
                )

    return src.mapInArrow(run, schema)


def _sketch_matrix(column: pa.Array) -> np.ndarray:
    """A binary column of sketches as (rows, longs)."""
    flat = pa.concat_arrays([column]).cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    return np.frombuffer(flat.buffers()[2], np.uint64, len(flat) * _LONGS, int(offsets[0])).reshape(len(flat), _LONGS) if len(flat) else np.zeros((0, _LONGS), np.uint64)


def possible(na, a: np.ndarray, nb, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether set sizes and sketches (last axis: longs) leave a link possible."""
    flips = np.bitwise_count(a ^ b).astype(np.int64)
    of_samples = flips[..., : SKETCH_BITS // 64].sum(axis=-1)
    of_sets = flips[..., SKETCH_BITS // 64 :].sum(axis=-1)
    return (of_samples <= most_flips()) & (of_sets <= (na + nb) * (100 - percent) // (100 + percent))


def _near(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches _na, _sa, _nb, _sb leave a link possible."""
    def run(batches):
        for batch in batches:
            n = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_na", "_nb")]
            m = [_sketch_matrix(batch.column(c)) for c in ("_sa", "_sb")]
            yield batch.select(["a", "b"]).filter(pa.array(possible(n[0], m[0], n[1], m[1], percent)))

    return pairs.mapInArrow(run, pairs.select("a", "b").schema)


def _near_across(blocks: DataFrame, ids: T.StructType, percent: int) -> DataFrame:
    """Pairs (a, b, _ca, _cb) across components of each row's ``_left`` and ``_right``
    (arrays of _id, _c, _n, _odd), of which ``_left`` is outside ``_main``."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = (batch.column(c)[i].values for c in ("_left", "_right"))
                main = batch.column("_main")[i]
                lm, rm = _sketch_matrix(left.field("_odd")), _sketch_matrix(right.field("_odd"))
                ln, rn = (x.field("_n").to_numpy(zero_copy_only=False) for x in (left, right))
                lc, rc = left.field("_c").to_numpy(zero_copy_only=False), right.field("_c").to_numpy(zero_copy_only=False)
                ok = (rc[None, :] == main.as_py()) | (rc[None, :] < lc[:, None])
                x, y = np.nonzero(ok)
                near = np.concatenate([possible(ln[x[j : j + 65536]], lm[x[j : j + 65536]], rn[y[j : j + 65536]], rm[y[j : j + 65536]], percent)
                                       for j in range(0, len(x), 65536)] or [np.zeros(0, bool)])
                x, y = pa.array(x[near]), pa.array(y[near])
                yield pa.RecordBatch.from_arrays(
                    [left.field("_id").take(x), right.field("_id").take(y), left.field("_c").take(x), right.field("_c").take(y)],
                    names=["a", "b", "_ca", "_cb"])

    return blocks.mapInArrow(run, ids)


def _texts_of(docs: DataFrame, doc_id: str, text: str, ids: DataFrame) -> DataFrame:
    """(_id, _text) of a superset of ``ids``, filtered while scanning by a bitmap."""
    words = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select(position(F.col(ids.columns[0])))))
    src = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text"), position(docs[doc_id]).alias("_at"))

    def run(batches):
        for batch in batches:
            at = batch.column("_at").to_numpy(zero_copy_only=False).astype(np.uint64)
            yield batch.select(["_id", "_text"]).filter(pa.array(has(words.value, at)))

    return src.where("_id is not null").mapInArrow(run, src.select("_id", "_text").schema)


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of full sets."""
    both = (
        pairs.join(texts.select(F.col("_id").alias("a"), F.col("_text").alias("_ta")), "a")
        .join(texts.select(F.col("_id").alias("b"), F.col("_text").alias("_tb")), "b")
        .select("a", "b", "_ta", "_tb")
    )

    def run(batches):
        for batch in batches:
            for part in A.blocks(batch, "_ta"):
                sets = []
                for c in ("_ta", "_tb"):
                    raw, offsets = A.utf8(part.column(c))
                    sets.append(list(A.shingles(A.lower_ascii(raw), offsets, k)))
                ok = []
                for x, y in zip(*sets):
                    union = np.sort(np.concatenate([x, y]))
                    common = int(np.count_nonzero(union[1:] == union[:-1]))
                    ok.append(100 * common >= percent * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, pairs.select("a", "b").schema)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles``, ``component_id``, ``kept``,
    and ``set_digest``.

    Words are runs of other than ASCII white space, A-Z in lower case; a text of
    fewer than k words is one shingle; a text without words (null, empty) has none
    and is linked with nothing. component_id is the smallest id reachable over
    links with similarity of ``percent`` or more; kept marks the row that bears
    it. Repeated rows have one set and so one component (each is marked alike);
    rows that share an id are one node. A row with a null id is linked with
    nothing: component_id null, kept. Empty tables give empty results, and other
    columns of ``docs`` aren't read.
    """
    all_sketches = written(sketch(docs, doc_id, text, k), "sketches")
    linkable = all_sketches.where("_n > 0 and _id is not null")
    # one node for each distinct shingle set, named by its smallest id; copies and
    # repeated rows combine before the shuffle
    nodes = linkable.groupBy("_set").agg(F.min_by(F.struct("_id", "_n", "_bands", "_odd"), "_id").alias("_first"))
    nodes = written(nodes.select("_set", "_first.*"), "nodes")
    by_set = nodes.select("_set", F.col("_id").alias("_node"))
    members = written(linkable.select("_id", "_set").join(by_set, "_set").select("_id", "_set", "_node"), "members")

    banded = nodes.select("_id", F.explode("_bands").alias("_key"))
    shared = banded.groupBy("_key").agg(F.min("_id").alias("_centre"), F.max("_id").alias("_last")).where("_centre <> _last")
    buckets = written(banded.join(shared, "_key").select("_key", "_id", "_centre"), "buckets")
    odd = written(nodes.join(buckets.select("_id").distinct(), "_id", "left_semi").select("_id", "_n", "_odd"), "odd")
    # once each: repeated rows must not multiply pairs
    texts = written(_texts_of(docs, doc_id, text, odd.select("_id")).distinct(), "texts")

    starred = buckets.where("_id <> _centre").select(F.col("_id").alias("a"), F.col("_centre").alias("b")).distinct()
    starred = starred.join(odd.toDF("a", "_na", "_sa"), "a").join(odd.toDF("b", "_nb", "_sb"), "b")
    first = written(_near(starred, percent).groupBy("a").agg(F.min("b").alias("b")), "first-pairs")
    links = written(_confirmed(first, texts, k, percent), "first-links")
    label = written(components(links), "components")

    named = buckets.select("_key", "_id").join(label.withColumnRenamed("id", "_id"), "_id", "left").select(
        "_key", "_id", F.coalesce("component", "_id").alias("_c"))
    # of a bucket with more than one component, pairs with an end outside its
    # largest one are compared, in blocks of about 256 x 256 nodes: a component that
    # fills a bucket is not compared with itself, and no task holds a whole bucket
    split = (
        named.groupBy("_key", "_c").agg(F.count("*").alias("_size"))
        .groupBy("_key").agg(F.max(F.struct("_size", "_c")).alias("_most"), F.sum("_size").alias("_all"), F.count("*").alias("_parts"))
        .where("_parts > 1").select("_key", F.col("_most._c").alias("_main"), "_all", (F.col("_all") - F.col("_most._size")).alias("_rest"))
    )
    open_ = written(named.join(split, "_key").join(odd, "_id"), "open-buckets")

    def dealt(df: DataFrame, size: str, name: str) -> DataFrame:
        part = F.pmod(F.xxhash64("_id"), F.call_function("div", F.col(size) + _CHUNK - 1, F.lit(_CHUNK)))
        return df.groupBy("_key", "_main", part.alias(f"{name}_part")).agg(F.collect_list(F.struct("_id", "_c", "_n", "_odd")).alias(name))

    blocks = dealt(open_.where("_c <> _main"), "_rest", "_left").drop("_left_part").join(
        dealt(open_, "_all", "_right").select("_key", "_right"), "_key")
    kind = docs.schema[doc_id].dataType
    fields = T.StructType([T.StructField(c, kind) for c in ("a", "b", "_ca", "_cb")])
    cross = (
        _near_across(blocks.select("_main", "_left", "_right"), fields, percent).distinct()
        .join(first, ["a", "b"], "left_anti")
        .join(first.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    )
    cross = written(cross, "cross-pairs")
    more = cross.join(_confirmed(cross.select("a", "b"), texts, k, percent), ["a", "b"]).select(
        F.col("_ca").alias("a"), F.col("_cb").alias("b"))
    merged = components(more).select(F.col("id").alias("component"), F.col("component").alias("_final"))
    final = label.join(merged, "component", "left").select("id", F.coalesce("_final", "component").alias("component")).union(
        merged.join(label, "component", "left_anti").select(F.col("component").alias("id"), F.col("_final").alias("component")))

    placed = members.join(final, members["_node"] == final["id"], "left").groupBy("_id").agg(
        F.min(F.coalesce("component", "_node")).alias("_component"))
    return (
        all_sketches.select("_id", "_n", "_set").join(placed, "_id", "left")
        .select(
            F.col("_id").alias(doc_id),
            F.col("_n").alias("n_shingles"),
            F.coalesce("_component", "_id").alias("component_id"),
            F.coalesce(F.coalesce("_component", "_id") == F.col("_id"), F.lit(True)).alias("kept"),
            F.hex("_set").alias("set_digest"),
        )
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept, columns as they were; of rows that repeat
    id and text one stays. Rows with a null id all stay, as they can't be named."""
    ident, row_hash = free_name(docs, "gone_id", "gone_text")
    found = near_duplicates(docs, doc_id, text, k, percent)
    gone = written(found.where(~F.col("kept")).select(F.col(doc_id).alias(ident)).distinct(), "gone")
    again = written(
        docs.where(docs[doc_id].isNotNull()).groupBy(docs[doc_id].alias(ident), F.xxhash64(docs[text]).alias(row_hash))
        .agg(F.count("*").alias("n")).where("n > 1").select(ident, row_hash), "repeated")
    left = docs.join(gone, docs[doc_id] == gone[ident], "left_anti")
    same = (left[doc_id] == again[ident]) & (F.xxhash64(left[text]) == again[row_hash])
    once = left.join(again, same, "left_semi").dropDuplicates([doc_id, text])
    return left.join(again, same, "left_anti").unionByName(once)
