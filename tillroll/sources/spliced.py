"""Records that span pieces of a file, put together in parallel.

A quoted CSV field may hold line ends, and an element of a JSON list takes as many
lines as it likes, so whether a piece of text begins a record depends on all the text
before it. Such files were one task's work. Here they are split like any text:

1. Every block of a file (a split, a byte range) is read by a task, which runs a small
   state machine over its pieces once for each state that the block may begin in, and
   returns where those end: a function from state to state.
2. The driver composes these functions in file order: a state for each block of a
   file, no more than the list of splits that it holds anyway.
3. Every block is read again from its true state. Records that lie in it are complete;
   the piece before its first record's end and the open piece at its end are fragments.
4. Fragments, two a block, are joined in file order.

A stray quote inside a bare field opens nothing, so it costs nothing; one that does
open a field takes the text up to the next quote with it, as in any CSV reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3
_ORDER = {HEAD: 0, MIDDLE: 1, TAIL: 2}


class QuotedLines:
    """CSV: a piece is a line; the state is whether a quoted field is open."""

    separator, starts, first = "\n", (0, 1), 0
    _close = re.compile(r'(?:[^"]|"")*"(?!")')
    _field = re.compile(r'"(?:[^"]|"")*("?)[^,]*(?:,|$)|[^,]*(?:,|$)', re.DOTALL)

    @classmethod
    def after(cls, state: int, line: str) -> int:
        if '"' not in line:
            return state
        at = 0
        if state:
            m = cls._close.match(line)
            if m is None:
                return 1
            at = line.find(",", m.end()) + 1  # what follows the quote belongs to the field
            if not at:
                return 0
        while at < len(line):
            m = cls._field.match(line, at)
            if m.group(1) == "":
                return 1
            at = m.end()
        return 0

    @staticmethod
    def ends(state: int) -> bool:
        return not state

    @staticmethod
    def then(state: int, results: dict) -> int:
        """The state after a block that begins in ``state``; ``results`` are its ends from
        each of ``starts``."""
        return results[state]


class ListElements:
    """A JSON list: a piece ends with a closing brace; the state is whether a string is
    open and the depth. A record ends where the depth is that of the list."""

    separator, starts, first = "}", ((0, 0), (1, 0)), (0, 0)
    _close = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
    _token = re.compile(r'"(?:[^"\\]|\\.)*("?)|[{}\[\]]', re.DOTALL)

    @classmethod
    def after(cls, state: tuple[int, int], piece: str) -> tuple[int, int]:
        text, at = piece + "}", 0
        open_, depth = state
        if open_:
            m = cls._close.match(text)
            if m is None:
                return 1, depth
            at = m.end()
        for m in cls._token.finditer(text, at):
            c = m.group()[0]
            if c == '"':
                if not m.group(1):
                    return 1, depth
            else:
                depth += 1 if c in "{[" else -1
        return 0, depth

    @staticmethod
    def ends(state: tuple[int, int]) -> bool:
        return state[0] == 0 and state[1] == 1

    @staticmethod
    def then(state: tuple[int, int], results: dict) -> tuple[int, int]:
        open_, more = results[(state[0], 0)]
        return open_, state[1] + more


def pieces(spark: SparkSession, path, separator: str) -> DataFrame:
    """file, block (where its split begins) and value of every piece, in file order
    within a block."""
    m = F.col("_metadata")
    df = spark.read.option("lineSep", separator).text(path)
    return df.select(m["file_path"].alias("file"), m["file_block_start"].cast("long").alias("block"), "value")


def _blocks(batches) -> Iterator[tuple[str, int, list[str], bool]]:
    """(file, block, values, whether the block begins here) of a partition's pieces."""
    last = None
    for batch in batches:
        file, block, value = (batch.column(c).to_pylist() for c in ("file", "block", "value"))
        i = 0
        while i < len(value):
            j = i
            while j < len(value) and (file[j], block[j]) == (file[i], block[i]):
                j += 1
            yield file[i], block[i], value[i:j], (file[i], block[i]) != last
            last, i = (file[i], block[i]), j


def _block_ends(parts: DataFrame, machine) -> dict:
    """{(file, block): {start: end}}; a row for each block comes to the driver."""
    def run(batches):
        done, at = [], None
        for file, block, values, new in _blocks(batches):
            if new:
                if at is not None:
                    done.append(at)
                at = (file, block, list(machine.starts))
            for v in values:
                at = (file, block, [machine.after(s, v) for s in at[2]])
        if at is not None:
            done.append(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([repr(d[2]) for d in done], pa.string())],
            names=["file", "block", "ends"])

    import ast

    rows = parts.mapInArrow(run, "file string, block long, ends string").collect()
    return {(r["file"], r["block"]): dict(zip(machine.starts, ast.literal_eval(r["ends"]))) for r in rows}


def block_states(ends: dict, machine) -> dict:
    """{(file, block): state in which the block begins}."""
    out, file, state = {}, None, None
    for key in sorted(ends):
        if key[0] != file:
            file, state = key[0], machine.first
        out[key] = state
        state = machine.then(state, ends[key])
    return out


def file_ends(parts: DataFrame, machine) -> dict:
    """{file: state at its end}."""
    ends = _block_ends(parts, machine)
    states = block_states(ends, machine)
    return {key[0]: machine.then(states[key], ends[key]) for key in sorted(ends)}  # the last block of a file stays


def _fragments(batches, machine, states: dict):
    """(file, block, pos, kind, value): whole records, and the fragments of a block."""
    def batch_of(rows):
        file, block, pos, kind, value = map(list, zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(file, pa.string()), pa.array(block, pa.int64()), pa.array(pos, pa.int64()), pa.array(kind, pa.int32()), pa.array(value, pa.string())],
            names=["file", "block", "pos", "kind", "value"])

    def close(at):
        # what is open at the end of a block
        file, block, pos, held, inside, _ = at
        return [(file, block, pos, MIDDLE if inside else TAIL, machine.separator.join(held))] if held else []

    at, rows = None, []
    for file, block, values, new in _blocks(batches):
        if new:
            if at is not None:
                rows += close(at)
            state = states[(file, block)]
            # inside: the open record began in an earlier block
            at = (file, block, 0, [], state != machine.first and not machine.ends(state), state)
            n = 0
        _, _, pos, held, inside, state = at
        for v in values:
            if not held:
                pos = n
            held.append(v)
            n += 1
            state = machine.after(state, v)
            if machine.ends(state):
                rows.append((file, block, pos, HEAD if inside else WHOLE, machine.separator.join(held)))
                held, inside = [], False
        at = (file, block, pos, held, inside, state)
        if len(rows) >= 4096:
            yield batch_of(rows)
            rows = []
    if at is not None:
        rows += close(at)
    if rows:
        yield batch_of(rows)


def splice(parts: DataFrame, machine) -> DataFrame:
    """Records (file, block, pos, value) of ``parts`` (file, block, value), where block
    and pos are those of a record's first piece. A record that the file leaves open is
    returned as it is."""
    spark = parts.sparkSession
    states = spark.sparkContext.broadcast(block_states(_block_ends(parts, machine), machine))
    schema = "file string, block long, pos long, kind int, value string"
    cut = parts.mapInArrow(lambda batches: _fragments(batches, machine, states.value), schema)
    whole = cut.where(F.col("kind") == WHOLE).drop("kind")
    loose = cut.where(F.col("kind") != WHOLE)
    turn = F.element_at(F.create_map(*[F.lit(x) for k, v in _ORDER.items() for x in (k, v)]), F.col("kind"))
    in_file = Window.partitionBy("file").orderBy("block", "turn")
    numbered = loose.withColumn("turn", turn).withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(in_file))
    joined = numbered.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "turn", "pos", "value"))).alias("of"))
    return whole.unionByName(joined.select(
        "file", F.col("of")[0]["block"].alias("block"), F.col("of")[0]["pos"].alias("pos"),
        F.array_join(F.col("of.value"), machine.separator).alias("value")))
