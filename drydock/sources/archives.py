"""ZIP archives of CSV members as rows.

Opening a ZIP and cutting CSV records are the only steps Spark has no reader
for, so they run in Arrow batches inside the tasks. A member is streamed block
by block and never held as a whole; every record leaves as an array of texts,
and all typing happens afterwards in Spark.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from drydock.session import scratch

ROW_SCHEMA = ("path string, member string, row_no bigint, layout bigint, "
              "fields array<string>, error string")
MEMBER_SCHEMA = "path string, member string, error string, length bigint"
DIGEST_SCHEMA = "path string, digest string"

_ROWS = pa.schema([
    ("path", pa.string()), ("member", pa.string()), ("row_no", pa.int64()),
    ("layout", pa.int64()), ("fields", pa.list_(pa.string())), ("error", pa.string())])
_MEMBERS = pa.schema([("path", pa.string()), ("member", pa.string()), ("error", pa.string()), ("length", pa.int64())])

# Faults of the data itself. Faults of the file system are left to Spark, which
# retries the task: a lost connection must not mark an archive as broken.
BAD_DATA = (zipfile.BadZipFile, zlib.error, EOFError, csv.Error, ValueError,
             NotImplementedError, RuntimeError)

_LIST = pa.list_(pa.string())
_BLOCK = 4 << 20
TASKS_PER_CORE = 3
MAX_RECORD_BYTES = 1 << 30
# A member beyond the first bound is cut into blocks of the second, parsed side by side.
SPLIT_ABOVE = 1 << 30
BLOCK_BYTES = 8 << 20
# A member up to this size is decompressed once and read from memory, a larger
# one is streamed twice: for its encoding, and for its records.
_HELD_BYTES = 16 << 20


# -- opening ---------------------------------------------------------------


def open_path(path: str):
    """A file opened by the task itself, in any store Arrow knows."""
    for old, new in (("s3a://", "s3://"), ("s3n://", "s3://")):
        path = path.replace(old, new, 1) if path.startswith(old) else path
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.replace("file:", "file://", 1)
    system, inner = pafs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _csv_members(archive: zipfile.ZipFile) -> list[str]:
    return [name for name in archive.namelist() if name.lower().endswith(".csv")]


# -- one member --------------------------------------------------------------


class _Member:
    """A member's bytes, as often as they are asked for."""

    def __init__(self, archive: zipfile.ZipFile, name: str):
        self.archive, self.name = archive, name
        self.small = archive.getinfo(name).file_size <= _HELD_BYTES
        self.held: bytes | None = None

    def open(self, whole: bool = True):
        """``whole`` says that all of it will be read."""
        if self.small and whole and self.held is None:
            self.held = self.archive.read(self.name)
        return self.archive.open(self.name) if self.held is None else io.BytesIO(self.held)

    def encoding(self) -> str:
        """UTF-8 if every byte of the member fits, else latin-1 for all of it."""
        decoder = codecs.getincrementaldecoder("utf-8")()
        with self.open() as raw:
            try:
                while chunk := raw.read(1 << 20):
                    decoder.decode(chunk)
                decoder.decode(b"", final=True)
            except UnicodeDecodeError:
                return "latin-1"
        return "utf-8"

    def header(self, encoding: str, whole: bool = True) -> list[str]:
        csv.field_size_limit(sys.maxsize)
        with self.open(whole) as raw:
            text = io.TextIOWrapper(raw, "utf-8-sig" if encoding == "utf-8" else encoding, newline="")
            for record in csv.reader(text):
                if any(cell.strip() for cell in record) or len(record) > 1:
                    return record
        raise ValueError("no columns: the member is empty")


def column_names(header: list[str]) -> list[str]:
    """Header cells as unique names: blanks numbered, repeats suffixed."""
    taken, names = set(header), []
    seen: set[str] = set()
    for j, cell in enumerate(header):
        name = cell if cell else f"Unnamed: {j}"
        if name in seen:
            k = 1
            while f"{name}.{k}" in taken:
                k += 1
            name = f"{name}.{k}"
        seen.add(name)
        taken.add(name)
        names.append(name)
    return names


def _layout(names: list[str]) -> int:
    digest = hashlib.blake2b("\x1f".join(names).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


class _Ragged:
    """Records whose width differs from the header's, by record number."""

    def __init__(self) -> None:
        self.rows: dict[int, tuple[int, str]] = {}

    def __call__(self, row) -> str:
        self.rows[row.number - 1] = (row.actual_columns, row.text)
        return "skip"

    def take(self, start: int, stop: int | None) -> list[tuple[int, int, str]]:
        """Hand out, and forget, the records numbered below ``stop``."""
        ready = sorted(n for n in self.rows if stop is None or n < stop)
        return [(n, *row) for n, row in ((n, self.rows.pop(n)) for n in ready) if n >= start]


def _blocks(member: _Member, encoding: str, width: int, most: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch | None, list]]:
    """Good records as text columns with their record numbers, block by block,
    each with the ragged records met since the last block.

    A record longer than a block makes the reader start again with a larger
    one, up to ``most`` bytes; records below ``resume`` have been handed out
    already.
    """
    names = [f"f{i}" for i in range(width)]
    block, resume = _BLOCK, 0
    while True:
        ragged, following = _Ragged(), 0
        with member.open() as raw:
            try:
                reader = pacsv.open_csv(
                    raw,
                    read_options=pacsv.ReadOptions(use_threads=False, block_size=block,
                                                   column_names=names, encoding=encoding),
                    parse_options=pacsv.ParseOptions(newlines_in_values=True,
                                                     invalid_row_handler=ragged),
                    convert_options=pacsv.ConvertOptions(
                        column_types={n: pa.string() for n in names}, strings_can_be_null=False))
                for batch in reader:
                    span = np.arange(following, following + batch.num_rows + len(ragged.rows))
                    numbers = span[~np.isin(span, list(ragged.rows))][:batch.num_rows]
                    following = int(numbers[-1]) + 1 if len(numbers) else following
                    odd = ragged.take(resume, following)
                    fresh = int(np.searchsorted(numbers, resume))
                    yield numbers[fresh:], batch.slice(fresh), odd
                    resume = max(resume, following)
                yield np.empty(0, dtype=np.int64), None, ragged.take(resume, None)
                return
            except pa.ArrowInvalid as fault:
                if "straddl" not in str(fault):
                    raise
                if block >= most:
                    raise ValueError(f"a record is longer than max_record_bytes = {most}") from fault
                block = min(block * 4, most)


def _as_lists(batch: pa.RecordBatch) -> pa.Array:
    """Text columns side by side, turned into one list per record."""
    rows, width = batch.num_rows, batch.num_columns
    flat = pa.concat_arrays(batch.columns)
    order = np.arange(rows * width).reshape(width, rows).T.ravel()
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, rows * width + 1, width, dtype=np.int32)), flat.take(pa.array(order)))


def _batch(path, member, row_no, layout, fields, error) -> pa.RecordBatch:
    n = len(row_no)
    return pa.RecordBatch.from_arrays([
        pa.array([path] * n, pa.string()), pa.array([member] * n, pa.string()),
        pa.array(row_no, pa.int64()), pa.array([layout] * n, pa.int64()),
        fields, pa.array(error, pa.string())], schema=_ROWS)


def error_row(path, member, row_no, layout, message) -> pa.RecordBatch:
    return _batch(path, member, [row_no], layout, pa.array([None], _LIST), [message])


def _mend(number: int, actual: int, text: str, width: int) -> tuple[list[str | None] | None, str | None]:
    """A short record padded with nulls, or the fault of one beyond mending."""
    if actual > width:
        return None, f"record {number}: {actual} fields, expected {width}"
    try:
        cells = next(csv.reader(io.StringIO(text, newline=""), strict=True))
    except csv.Error as fault:
        if "end of data" in str(fault):
            return None, f"record {number}: quoted field never closed"
        cells = next(csv.reader(io.StringIO(text, newline="")))
    return cells + [None] * (width - len(cells)), None


def _mended(path, member, layout, width, odd) -> pa.RecordBatch | None:
    """The ragged records of a block as one batch."""
    found = [(number, *_mend(number, actual, text, width)) for number, actual, text in odd
             if text.strip()]  # a line of blanks is no record
    if not found:
        return None
    numbers, cells, faults = zip(*found, strict=True)
    return _batch(path, member, list(numbers), layout, pa.array(list(cells), _LIST), list(faults))


def _expand_member(path, archive, name, header_only, most) -> Iterator[pa.RecordBatch]:
    member = _Member(archive, name)
    if header_only:  # an all-ASCII header reads the same in either encoding
        names = member.header("latin-1", whole=False)
        if not all(cell.isascii() for cell in names):
            names = member.header(member.encoding())
        names = column_names(names)
        yield _batch(path, name, [0], _layout(names), pa.array([names], _LIST), [None])
        return
    encoding = member.encoding()
    names = column_names(member.header(encoding))
    layout = _layout(names)
    yield _batch(path, name, [0], layout, pa.array([names], _LIST), [None])
    yield from parse_records(path, name, member, encoding, names, layout, most)


def parse_records(path, name, source, encoding, names, layout, most, first: int = 0,
                  skip_header: bool = True) -> Iterator[pa.RecordBatch]:
    """The records of a member, or of a part of it which begins with record ``first``.

    ``source.open()`` gives the bytes, as often as they are asked for. Record 0
    of a whole member is the header, and left out.
    """
    width, header_seen = len(names), not skip_header
    for numbers, batch, odd in _blocks(source, encoding, width, most):
        mended = _mended(path, name, layout, width, [(n + first, actual, text) for n, actual, text in odd])
        if mended is not None:
            yield mended
        if batch is None:
            return
        keep = np.ones(batch.num_rows, dtype=bool)
        if width == 1:
            line = batch.column(0)
            bare = pc.equal(pc.utf8_trim_whitespace(line), "")
            keep = ~pc.and_(bare, pc.greater(pc.utf8_length(line), 0)).to_numpy(zero_copy_only=False)
        if not header_seen and keep.any():
            keep[keep.argmax()] = False
            header_seen = True
        if not keep.all():
            numbers, batch = numbers[keep], batch.filter(pa.array(keep))
        if batch.num_rows:
            yield _batch(path, name, numbers + first, layout, _as_lists(batch), [None] * batch.num_rows)


# -- Spark stages ------------------------------------------------------------


def _handle(batch: pa.RecordBatch, i: int, opener):
    """An archive's bytes: those that came with it, else those the task opens.

    Opening stands outside of all fault handling: an unknown scheme or a store
    that does not answer fails the task, and says nothing about the archive.
    """
    if "content" in batch.schema.names:
        return io.BytesIO(batch.column("content")[i].as_py() or b"")
    return opener(batch.column("path")[i].as_py())


def _expander(opener, header_only: bool, most: int):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path = batch.column("path")[i].as_py()
                wanted = batch.column("member")[i].as_py()
                member = None
                with _handle(batch, i, opener) as handle:
                    try:
                        with zipfile.ZipFile(handle) as archive:
                            members = [wanted] if wanted else _csv_members(archive)
                            if not members:
                                raise ValueError("no CSV members in the archive")
                            for member in members:
                                yield from _expand_member(path, archive, member, header_only, most)
                    except BAD_DATA as fault:
                        yield error_row(path, member, None, None, f"{type(fault).__name__}: {fault}")
    return expand


def _member_lister(opener):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                with _handle(batch, i, opener) as handle:
                    try:
                        with zipfile.ZipFile(handle) as archive:
                            members, message = _csv_members(archive), None
                            sizes = [archive.getinfo(name).file_size for name in members]
                        if not members:
                            message = "ValueError: no CSV members in the archive"
                    except BAD_DATA as fault:
                        members, message = [], f"{type(fault).__name__}: {fault}"
                path, rows = batch.column("path")[i].as_py(), members or [None]
                lengths = sizes if members else [None]
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(rows), pa.string()), pa.array(rows, pa.string()),
                    pa.array([message] * len(rows), pa.string()), pa.array(lengths, pa.int64())], schema=_MEMBERS)
    return listed


def _digester(opener):
    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                digest = hashlib.sha256()
                with _handle(batch, i, opener) as handle:
                    while chunk := handle.read(_BLOCK):
                        digest.update(chunk)
                yield pa.RecordBatch.from_pydict({"path": [batch.column("path")[i].as_py()], "digest": [digest.hexdigest()]})
    return digested


def dealt(units: DataFrame, *keys: str) -> DataFrame:
    """Paths, of archives or members, dealt out by key to some tasks for each core.

    They are few bytes that stand for much work, so their number of tasks is
    given: by their bytes Spark would put thousands of archives into one task.
    """
    return units.repartition(TASKS_PER_CORE * units.sparkSession.sparkContext.defaultParallelism, *keys)


def _units(archives: DataFrame) -> DataFrame:
    """Archives as units of work. Those that bring their bytes are spread by these, and stay where they are."""
    units = archives.select(*_carried(archives))
    return units if "content" in units.columns else dealt(units, "path")


def _carried(archives: DataFrame) -> list[str]:
    return ["path", "content"] if "content" in archives.columns else ["path"]


def list_members(archives: DataFrame, opener: Callable = open_path) -> DataFrame:
    """CSV members ``(path, member, error, length)``, with their inflated length; reads only each archive's index."""
    return _units(archives).mapInArrow(_member_lister(opener), MEMBER_SCHEMA)


def archive_digests(archives: DataFrame, opener: Callable = open_path) -> DataFrame:
    """``path, digest``: the SHA-256 of each archive's bytes, which the tasks read in blocks."""
    return _units(archives).mapInArrow(_digester(opener), DIGEST_SCHEMA)


def expand_archives(archives: DataFrame, header_only: bool = False, opener: Callable = open_path,
                    max_record_bytes: int = MAX_RECORD_BYTES, split_above: int | None = None,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Records of all CSV members: ``(path, member, row_no, layout, fields, error)``.

    Record 0 is the header as column names; ``layout`` identifies it. A broken
    archive gives rows with ``error`` set instead of failing the job.

    Archives given by path, whatever their number and size, are opened by the
    tasks: their indexes are read first, and then every member is a unit of work
    of its own, spread over the cluster and streamed. ``opener`` turns a path
    into a seekable binary file; the one given here knows the schemes Arrow
    knows, and a caller with another store passes one for it. A table with a
    ``content`` column brings the bytes along, one archive a unit of work.

    Members which inflate to more than ``split_above`` bytes are staged in blocks
    of ``block_bytes`` and parsed by many tasks each (``blocks.expand_large_members``).
    """
    stage = _expander(opener, header_only, max_record_bytes)
    if "content" in archives.columns:
        return archives.select("path", F.lit(None).cast("string").alias("member"), "content").mapInArrow(
            stage, ROW_SCHEMA)
    units = list_members(archives, opener)
    if split_above is not None and not header_only:
        from drydock.sources.blocks import expand_large_members  # which parses by what is here
        spark, listed = archives.sparkSession, scratch(archives.sparkSession, "members")
        units.write.parquet(listed)  # every index is read once
        units = spark.read.schema(MEMBER_SCHEMA).parquet(listed)
        large = units.filter(F.col("length") > split_above).select("path", "member")
        if not large.isEmpty():
            small = units.filter(F.col("member").isNull() | (F.col("length") <= split_above))
            return _members_expanded(small, stage).unionByName(expand_large_members(
                large, opener, block_bytes, max_record_bytes))
    return _members_expanded(units, stage)


def _members_expanded(units: DataFrame, stage) -> DataFrame:
    rows = dealt(units.filter(F.col("member").isNotNull()).select("path", "member"), "path", "member").mapInArrow(
        stage, ROW_SCHEMA)
    failed = units.filter(F.col("member").isNull()).select(
        "path", "member", F.lit(None).cast("bigint").alias("row_no"),
        F.lit(None).cast("bigint").alias("layout"),
        F.lit(None).cast("array<string>").alias("fields"), "error")
    return rows.unionByName(failed)


def member_headers(members: DataFrame, opener: Callable = open_path) -> DataFrame:
    """The header, or the fault, of each member ``(path, member)``."""
    return members.select("path", "member").mapInArrow(_expander(opener, True, MAX_RECORD_BYTES), ROW_SCHEMA)


def archive_faults(rows: DataFrame) -> DataFrame:
    """One row per archive ``(path, rows, faults, error)``: its sound records, the
    number of its faults, and the first message."""
    fault = F.struct(F.coalesce("member", F.lit("")).alias("member"),
                     F.coalesce("row_no", F.lit(0)).alias("row_no"), "error")
    bad = F.col("error").isNotNull()
    return rows.groupBy("path").agg(
        F.count_if((F.col("row_no") > 0) & ~bad).alias("rows"), F.count_if(bad).alias("faults"),
        F.min(F.when(bad, fault))["error"].alias("error"))


def layouts(rows: DataFrame) -> DataFrame:
    """Distinct headers ``(layout, names)`` among expanded rows."""
    return (rows.filter((F.col("row_no") == 0) & F.col("error").isNull())
            .groupBy("layout").agg(F.min("fields").alias("names")))


def stored_layouts(rows: DataFrame) -> DataFrame:
    """``layouts``, kept in the shared folder. Their size is known then: where they are few, as headers mostly are,
    records need not be dealt by layout, which would leave a task for each header."""
    spark, place = rows.sparkSession, scratch(rows.sparkSession, "layouts")
    found = layouts(rows)
    found.write.parquet(place)
    return spark.read.schema(found.schema).parquet(place)


def errors_by_archive(rows: DataFrame) -> DataFrame:
    """One row per broken archive: number of faults and the first message."""
    return archive_faults(rows.filter(F.col("error").isNotNull())).select("path", "faults", "error")
