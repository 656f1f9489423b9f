"""One huge CSV member parsed by many tasks.

A DEFLATE stream can only be inflated from its beginning, by one task; cutting
records and cells can be spread. The member is inflated once into blocks of
fixed size. What a block does to a reader that enters it is a function of the
state the reader is in (at the start of a line, inside quotes, ...): the state
it leaves in, and how many records end on the way. These functions are small,
are computed for all blocks in parallel, and compose; a scan over them tells
the true state at every block's edge, so that every block can then be cut at
its first line end and parsed by itself.
"""

from __future__ import annotations

import codecs
import io
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from drydock.session import scratch
from drydock.sources.archives import (
    BAD_DATA, BLOCK_BYTES, MAX_RECORD_BYTES, ROW_SCHEMA, dealt, error_row, member_headers, open_path, parse_records)

# States of a reader: at the start of a line or of a field, in a bare or a quoted field, after a quote in a
# quoted field, after a carriage return that has ended a line.
LINE, FIELD, BARE, QUOTED, QUOTE, RETURN = range(6)
# Kinds of bytes.
OTHER, MARK, COMMA, FEED, CARRIAGE = range(5)
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[ord('"'), ord(","), ord("\n"), ord("\r")]] = [MARK, COMMA, FEED, CARRIAGE]
#: For each kind and state: the next state, whether a record ends, whether a line ends.
_NEXT = np.array([[BARE, BARE, BARE, QUOTED, BARE, BARE], [QUOTED, QUOTED, BARE, QUOTE, QUOTED, QUOTED],
                  [FIELD, FIELD, FIELD, QUOTED, FIELD, FIELD], [LINE, LINE, LINE, QUOTED, LINE, LINE],
                  [RETURN, RETURN, RETURN, QUOTED, RETURN, RETURN]], dtype=np.int8)
_RECORD = np.array([[0] * 6, [0] * 6, [0] * 6, [0, 1, 1, 0, 1, 0], [0, 1, 1, 0, 1, 0]], dtype=np.int64)
_LINE = np.array([[0] * 6, [0] * 6, [0] * 6, [1, 1, 1, 0, 1, 0], [1, 1, 1, 0, 1, 1]], dtype=np.int64)
_LANES = 2048


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of the bytes that matter and where they are: of a run of other bytes the first will do."""
    kind = _KIND[data]
    keep = kind != OTHER
    keep[:1] = True
    keep[1:] |= kind[:-1] != OTHER
    at = np.flatnonzero(keep)
    return kind[at], at


def _lanes(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The functions of consecutive pieces of equal length, all of which advance together."""
    size = max(1, -(-len(kind) // _LANES))
    padded = np.full(size * -(-len(kind) // size), 5, dtype=np.int64)  # kind 5 changes nothing
    padded[:len(kind)] = kind
    table = padded.reshape(-1, size)
    following = np.concatenate((_NEXT, np.arange(6, dtype=np.int8)[None]))
    records, lines = (np.concatenate((t, np.zeros((1, 6), np.int64))) for t in (_RECORD, _LINE))
    state = np.tile(np.arange(6, dtype=np.int64), (len(table), 1))
    n_records, n_lines = np.zeros_like(state), np.zeros_like(state)
    for column in table.T:
        n_records += records[column[:, None], state]
        n_lines += lines[column[:, None], state]
        state = following[column[:, None], state].astype(np.int64)
    return state, n_records, n_lines, size


def block_function(data: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """For each state a reader may enter in: the state it leaves in, and the records and lines that end on the way."""
    kind, _ = tokens(data)
    now, done, ended = np.arange(6), np.zeros(6, dtype=np.int64), np.zeros(6, dtype=np.int64)
    if len(kind):
        state, records, lines, _ = _lanes(kind)
        for after, n, m in zip(state, records, lines, strict=True):
            done, ended = done + n[now], ended + m[now]
            now = after[now]
    return now.tolist(), done.tolist(), ended.tolist()


def first_cut(data: np.ndarray, state: int) -> tuple[int, int] | None:
    """Where the first line after an edge begins, and the records (0 or 1) that end before it."""
    kind, at = tokens(data)
    if not len(kind):
        return None
    after, _, lines, size = _lanes(kind)
    for lane in range(len(after)):
        if lines[lane, state]:
            for k in range(lane * size, len(kind)):
                if _LINE[kind[k], state]:
                    return int(at[k]) + 1, int(_RECORD[kind[k], state])
                state = int(_NEXT[kind[k], state])
        state = int(after[lane, state])
    return None


# -- stages -------------------------------------------------------------------

_BLOCKS = pa.schema([("path", pa.string()), ("member", pa.string()), ("block", pa.int64()), ("bytes", pa.binary()),
                     ("wide", pa.bool_()), ("error", pa.string())])


def _inflater(opener, block: int):
    """Blocks of each member; ``wide`` says that the member cannot be UTF-8 up to the block's end."""
    def inflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path, name, number = row["path"], row["member"], 0
                decoder, wide = codecs.getincrementaldecoder("utf-8")(), False
                with opener(path) as handle:
                    try:
                        with zipfile.ZipFile(handle) as archive, archive.open(name) as raw:
                            while True:
                                data = raw.read(block)
                                try:
                                    wide = wide or decoder.decode(data, final=not data) is None
                                except UnicodeDecodeError:
                                    wide = True
                                if not data and number:
                                    yield pa.RecordBatch.from_pylist([dict(path=path, member=name, block=None, bytes=None,
                                                                           wide=wide, error=None)], _BLOCKS)
                                    break
                                if number == 0:
                                    data = data.removeprefix(codecs.BOM_UTF8)
                                yield pa.RecordBatch.from_pylist([dict(path=path, member=name, block=number, bytes=data,
                                                                       wide=wide, error=None)], _BLOCKS)
                                number += 1
                    except BAD_DATA as fault:
                        yield pa.RecordBatch.from_pylist([dict(path=path, member=name, block=None, bytes=None, wide=False,
                                                               error=f"{type(fault).__name__}: {fault}")], _BLOCKS)
    return inflate


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            data = batch.column("bytes")[k].as_buffer()
            found = block_function(np.frombuffer(data, np.uint8))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).slice(k, 1) for n in ("path", "member", "block")]
                + [pa.array([x], pa.list_(pa.int64())) for x in found],
                names=["path", "member", "block", "ends", "records", "lines"])


def _composed(group: pd.DataFrame) -> pd.DataFrame:
    """The state at each block's edge, the records before it, and the block in which the record that is open
    there begins: a few numbers for each block of a member."""
    group = group.sort_values("block")
    state, done, begun, found = LINE, 0, 0, []
    for block, ends, records, lines in zip(*(group[c] for c in ("block", "ends", "records", "lines")), strict=True):
        found.append((state, done, begun))
        if lines[state]:
            begun = block
        state, done = int(ends[state]), done + int(records[state])
    states, before, open_in = zip(*found, strict=True)
    return pd.DataFrame({"path": group["path"], "member": group["member"], "block": group["block"],
                         "state": states, "before": before, "open_in": open_in})


_PIECES = "path string, member string, unit bigint, block bigint, first bigint, piece binary"


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block in two pieces: what ends the record that is open at its edge, and what begins in it."""
    for batch in batches:
        for k in range(batch.num_rows):
            path, member, block, data, state, before, open_in = (
                batch.column(n)[k].as_py() for n in ("path", "member", "block", "bytes", "state", "before", "open_in"))
            cut = (0, 0) if block == 0 else first_cut(np.frombuffer(data, np.uint8), state)
            at, ended = cut or (len(data), 0)
            pieces = [(open_in, None, data[:at])] * (at > 0) + [(block, before + ended, data[at:])] * (cut is not None)
            for unit, first, piece in pieces:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], kind) for x, kind in (
                        (path, pa.string()), (member, pa.string()), (unit, pa.int64()), (block, pa.int64()),
                        (first, pa.int64()), (piece, pa.binary()))],
                    names=["path", "member", "unit", "block", "first", "piece"])


class _Whole:
    """Bytes at hand, as often as they are asked for."""

    def __init__(self, data: bytes) -> None:
        self.data = data

    def open(self) -> io.BytesIO:
        return io.BytesIO(self.data)


def _parser(most: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        told: tuple = ()

        def finished() -> Iterator[pa.RecordBatch]:
            path, member, _, first, names, layout, encoding = told
            whole = b"".join(held)
            if not whole.strip(b"\r\n"):
                return
            try:  # a unit before which no record ends has the header
                yield from parse_records(path, member, _Whole(whole), encoding, names, layout, most, first, first == 0)
            except BAD_DATA as fault:
                yield error_row(path, member, None, None, f"{type(fault).__name__}: {fault}")

        for batch in batches:  # in order of unit, then of block
            for row in batch.to_pylist():
                if told and (row["path"], row["member"], row["unit"]) != told[:3]:
                    yield from finished()
                    held = []
                if not held:
                    told = (row["path"], row["member"], row["unit"], row["first"], row["names"], row["layout"],
                            "latin-1" if row["wide"] else "utf-8")
                held.append(row["piece"])
        if held:
            yield from finished()
    return parse


def expand_large_members(members: DataFrame, opener: Callable = open_path, block_bytes: int = BLOCK_BYTES,
                         max_record_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """``ROW_SCHEMA`` of the CSV members ``(path, member)``, each parsed by as many tasks as it has blocks.

    The rows are those ``expand_archives`` gives. One task inflates a member,
    block by block, into the shared folder; a few numbers for each block are
    composed in order; a record that spans blocks, however many, is put together
    by the task of the block it begins in. A member that breaks off gives the
    records before the fault, and the fault.
    """
    spark = members.sparkSession
    base = scratch(spark, "blocks")
    files = dealt(members.select("path", "member"), "path", "member")
    files.mapInArrow(_inflater(opener, block_bytes),
                     "path string, member string, block bigint, bytes binary, wide boolean, error string").write.option(
        "parquet.block.size", str(max(block_bytes, 1 << 20))).option("compression", "lz4_raw").parquet(f"{base}/inflated")
    inflated = spark.read.parquet(f"{base}/inflated")
    blocks = inflated.filter("block IS NOT NULL")
    spread = blocks.select("path", "member", "block", "bytes").repartition(F.col("path"), F.col("member"), F.col("block"))
    spread.mapInArrow(_functions, "path string, member string, block bigint, ends array<bigint>, records array<bigint>, "
                                  "lines array<bigint>").write.parquet(f"{base}/functions")
    edges = spark.read.parquet(f"{base}/functions").groupBy("path", "member").applyInPandas(
        _composed, "path string, member string, block bigint, state bigint, before bigint, open_in bigint")
    edges.write.parquet(f"{base}/edges")
    edges = spark.read.parquet(f"{base}/edges")
    wide = inflated.groupBy("path", "member").agg(F.max("wide").alias("wide"))
    headers, on = member_headers(files, opener), ["path", "member"]
    known = headers.filter("error IS NULL").select(*on, F.col("fields").alias("names"), "layout").join(wide, on)
    pieces = blocks.select(*on, "block", "bytes").join(edges, [*on, "block"]).mapInArrow(_cutter, _PIECES)
    # the task of a unit puts its pieces together: what begins in a block, and what ends it in later ones
    rows = pieces.join(known, on).repartition(*on, "unit").sortWithinPartitions(*on, "unit", "block").select(
        *on, "unit", "first", "piece", "names", "layout", "wide").mapInArrow(_parser(max_record_bytes), ROW_SCHEMA)
    faults = inflated.filter("error IS NOT NULL").select(
        *on, *[F.lit(None).cast(t).alias(n) for n, t in (("row_no", "bigint"), ("layout", "bigint"),
                                                         ("fields", "array<string>"))], "error")
    return headers.unionByName(rows).unionByName(faults)
