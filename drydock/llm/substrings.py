"""Removal of repeated byte strings by a distributed, prefix-aware sort of suffixes.

A suffix is worth sorting only if its first bytes occur again. Each window of
``length`` bytes is owned by its anchor, the least of its hashed grams; equal
windows have equal anchors at the same place. So grams are exchanged first, and
only suffixes at anchors whose gram occurs twice, with different text around
them, are cut into sorted runs, front-coded, exchanged and merged. A gram which
a large share of all documents holds would bring too many suffixes to one task:
its windows are compared one by one instead, as hashes in a grouping by Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from drydock.llm.common import chunks, mixed, rolled, runs, spans_hash, staged, whole_groups

LENGTH = 100
GRAM = 32
BATCH_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
HOT_ANCHORS = 32

_KEY = T.StructType([T.StructField("id", T.LongType()), T.StructField("text_hash", T.LongType())])


# -- anchors ------------------------------------------------------------------


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, in log(width) passes."""
    n, size, least = len(values) - width + 1, 1, values
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[:n], least[width - size:width - size + n])


def window_hashes(data: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the windows of ``length`` bytes at the given places."""
    twice = rolled(mixed(data.astype(np.uint64) + np.uint64(977)))
    return spans_hash(rolled(data), start, start + length), spans_hash(twice, start, start + length)


def spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which interval, and which place in it, for all places of lo..hi."""
    n = hi - lo + 1
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def find_anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Anchors of the texts: ``doc, at, lo, hi, gram, chunk``.

    Windows starting at lo..hi are owned by the anchor at ``at``; ``gram`` is the
    hash of its gram, ``chunk`` that of all bytes its windows cover. Among equal
    grams of a window the first is the anchor.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    offset = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    names = ("doc", "at", "lo", "hi", "gram", "chunk")
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.any():
        return {n: np.zeros(0, np.uint64 if n in ("gram", "chunk") else np.int64) for n in names}
    prefix = rolled(data)
    start = np.arange(len(data) - gram + 1)
    grams = spans_hash(prefix, start, start + gram)
    least = sliding_least((grams & np.uint64(0xFFFFFFFF00000000)) | start.astype(np.uint64), length - gram + 1)
    doc = np.repeat(np.arange(len(texts)), windows)
    begin = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + offset[doc]
    at = (least[begin] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    lo, hi, at, doc = begin[first], begin[last], at[first], doc[first]
    return {"doc": doc, "at": at - offset[doc], "lo": lo - offset[doc], "hi": hi - offset[doc],
            "gram": grams[at], "chunk": spans_hash(prefix, lo, hi + length)}


def pieces_of(texts: list[bytes], most: int, length: int) -> list[tuple[int, int, bytes]]:
    """``(text, offset, bytes)``: long texts in pieces that between them hold each window once."""
    out = []
    for k, text in enumerate(texts):
        if len(text) >= length:
            for at in range(0, len(text) - length + 1, most):
                out.append((k, at, text[at:at + most + length - 1]))
    return out


def pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], dtype=np.int64)
    return head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(blob: bytes, dtypes: list) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, np.int64, len(dtypes)), 8 * len(dtypes), []
    for n, kind in zip(sizes.tolist(), dtypes, strict=True):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def later_copies(place: np.ndarray, lo: np.ndarray, gram: np.ndarray, chunk: np.ndarray, heads: bool = False):
    """Sort by gram, chunk and place. Gives the order, whether each (in it) is a later
    copy of its chunk, and whether it is the first of a chunk whose gram has several
    (with ``heads`` also whether it is the first of any)."""
    order = np.lexsort((lo, place, chunk, gram))
    g, c, p, x = gram[order], chunk[order], place[order], lo[order]
    new_gram, new_chunk = np.ones(len(g), dtype=bool), np.ones(len(g), dtype=bool)
    new_gram[1:] = g[1:] != g[:-1]
    new_chunk[1:] = new_gram[1:] | (c[1:] != c[:-1])
    head = np.flatnonzero(new_chunk)[np.cumsum(new_chunk) - 1] if len(g) else np.zeros(0, np.int64)
    later = (p != p[head]) | (x != x[head])  # a repeated row is not its own copy
    which = np.cumsum(new_gram) - 1
    several = np.bincount(which, new_chunk)[which] > 1 if len(g) else np.zeros(0, bool)
    return (order, later, new_chunk & several, new_chunk) if heads else (order, later, new_chunk & several)


_DOCS = [np.uint8, np.int64, np.int64]
_ANCHORS = _DOCS + [np.uint32, np.uint32, np.uint8, np.uint8, np.uint64, np.uint64]
_DONE = _DOCS + [np.uint32, np.uint32, np.uint32]
_WINDOWS = _DOCS + [np.uint32, np.uint32, np.uint64, np.uint64]
_ANCHOR, _SETTLED, _WINDOW, _HOT = 0, 1, 2, 3


def _ids(column: pa.Array) -> list[np.ndarray]:
    ids = column.field("id")
    return [ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
            ids.fill_null(0).to_numpy(zero_copy_only=False), column.field("text_hash").to_numpy(zero_copy_only=False)]


def _own_docs(ids: list[np.ndarray], doc: np.ndarray) -> list[np.ndarray]:
    """The documents named in ``doc``, and their places among them."""
    used, place = np.unique(doc, return_inverse=True)
    return [x[used] for x in ids] + [place.astype(np.uint32)]


def merged(place: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of window starts, joined where they touch."""
    order = np.lexsort((lo, place))
    place, lo, hi = place[order], lo[order], hi[order]
    new = np.ones(len(lo), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (lo[1:] > hi[:-1] + 1)
    first = np.flatnonzero(new)
    return place[first], lo[first], np.maximum.reduceat(hi, first) if len(first) else hi[:0]


def _hot_windows(pieces: list, found: dict, own: np.ndarray, length: int):
    """All windows of some anchors: document, start and hash."""
    sizes = np.array([len(p[2]) for p in pieces], dtype=np.int64)
    offset = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    which, start = spread(found["lo"][own], found["hi"][own])
    piece = found["doc"][own][which]
    low, high = window_hashes(np.frombuffer(b"".join(p[2] for p in pieces), np.uint8), start + offset[piece], length)
    doc, base = (np.array([p[k] for p in pieces])[piece] for k in (0, 1))
    return doc, start + base, low, high


def _scanner(buckets: int, length: int, gram: int, hot: int):
    """Anchors of each batch, dealt by gram; copies inside the batch are settled at once.

    A gram at ``hot`` anchors of the batch, with other text around each, is dealt
    by its windows, and its name is sent to its bucket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            rank = np.lexsort(ids[::-1])
            order = np.empty(len(rank), dtype=np.int64)
            order[rank] = np.arange(len(rank))
            for x in range(1, len(rank)):  # repeated rows share a rank
                if all(i[rank[x]] == i[rank[x - 1]] for i in ids):
                    order[rank[x]] = order[rank[x - 1]]
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            pieces = pieces_of(texts, BATCH_BYTES, length)
            for some in chunks(pieces, [len(p[2]) for p in pieces], BATCH_BYTES):
                found = find_anchors([p[2] for p in some], length, gram)
                doc = np.array([p[0] for p in some])[found["doc"]]
                base = np.array([p[1] for p in some])[found["doc"]]
                at, lo, hi = (found[n] + base for n in ("at", "lo", "hi"))
                where, later, _ = later_copies(order[doc], lo, found["gram"], found["chunk"])
                out_bucket, out_kind, out_blob = [], [], []

                def deal(kind: int, bucket: int, blob: bytes) -> None:
                    out_kind.append(kind)
                    out_bucket.append(bucket)
                    out_blob.append(blob)

                def anywhere(owners: list[np.ndarray]) -> int:
                    return int(mixed(owners[2][:1].view(np.uint64))[0] % np.uint64(buckets))

                gone = where[later]
                done = [(doc[gone], lo[gone], hi[gone])]
                keep = np.sort(where[~later])
                names, which, times = np.unique(found["gram"][keep], return_inverse=True, return_counts=True)
                is_hot = times >= hot
                if is_hot.any():
                    owner, start, low, high = _hot_windows(some, found, keep[is_hot[which]], length)
                    sort, repeated, _ = later_copies(order[owner], start, low, high)
                    own = sort[repeated]
                    done.append((owner[own], start[own], start[own]))
                    own = np.sort(sort[~repeated])
                    for x in range(0, len(own), 100_000):
                        part = own[x:x + 100_000]
                        owners = _own_docs(ids, owner[part])
                        deal(_WINDOW, anywhere(owners), pack(*owners, start[part].astype(np.uint32), low[part], high[part]))
                    for name in names[is_hot]:
                        deal(_HOT, int(mixed(name[None])[0] % np.uint64(buckets)), pack(name[None]))
                    keep = keep[~is_hot[which]]
                place, a, b = merged(*(np.concatenate(x) for x in zip(*done, strict=True)))
                if len(place):
                    owners = _own_docs(ids, place)
                    deal(_SETTLED, anywhere(owners), pack(*owners, a.astype(np.uint32), b.astype(np.uint32)))
                bucket = (mixed(found["gram"][keep]) % np.uint64(buckets)).astype(np.int64)
                sort = np.argsort(bucket, kind="stable")
                keep, bucket = keep[sort], bucket[sort]
                edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
                for x, y in zip(edges[:-1], edges[1:], strict=True):
                    own = keep[x:y]
                    deal(_ANCHOR, int(bucket[x]), pack(
                        *_own_docs(ids, doc[own]), at[own].astype(np.uint32), (at[own] - lo[own]).astype(np.uint8),
                        (at[own] - hi[own]).astype(np.uint8), found["gram"][own], found["chunk"][own]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_bucket, pa.int32()), pa.array(out_kind, pa.int32()), pa.array(out_blob, pa.binary())],
                    names=["bucket", "kind", "blob"])
    return run


def _joined(blobs: list[bytes], dtypes: list) -> list[np.ndarray]:
    """The arrays of several blobs on end, document places moved to the joined table of documents."""
    parts, before = [], 0
    for blob in blobs:
        arrays = unpack(blob, dtypes)
        arrays[3] = arrays[3].astype(np.int64) + before
        before += len(arrays[0])
        parts.append(arrays)
    return [np.concatenate(x) if x else np.zeros(0, d) for x, d in
            zip(zip(*parts, strict=True) if parts else [()] * len(dtypes), dtypes, strict=True)]


def doc_ranks(none: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Places of documents in the order of id (null last) and text hash, equal for equal ones."""
    order = np.lexsort((ties, ids, none))
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = ((none[order][1:] != none[order][:-1]) | (ids[order][1:] != ids[order][:-1])
               | (ties[order][1:] != ties[order][:-1]))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank


#: at: -1 for windows lo..hi that are repeats, -2 for one with its hash, else that of an open anchor.
_FOUND = "key struct<id: bigint, text_hash: bigint>, at long, lo long, hi long, hot boolean, low long, high long"


def _found(docs: list[np.ndarray], place: np.ndarray, at, lo: np.ndarray, hi: np.ndarray, hot=False,
           low=0, high=0) -> pa.RecordBatch:
    none, ids, ties = (x[place] for x in docs)
    key = pa.StructArray.from_arrays([pa.array(ids, pa.int64(), mask=none.astype(bool)), pa.array(ties, pa.int64())],
                                     names=["id", "text_hash"])
    def column(values, kind) -> pa.Array:
        return pa.array(np.broadcast_to(np.asarray(values).astype(kind), place.shape))

    return pa.RecordBatch.from_arrays(
        [key, *(column(x, np.int64) for x in (at, lo, hi)), column(hot, bool),
         *(column(x, np.uint64).view(pa.int64()) for x in (low, high))],
        names=["key", "at", "lo", "hi", "hot", "low", "high"])


def _told_windows(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
    for blob in blobs:
        none, ids, ties, place, start, low, high = unpack(blob, _WINDOWS)
        yield _found([none, ids, ties], place, -2, start, start, False, low, high)


def _settler():
    """By bucket: which anchors are later copies of their whole chunk (at = -1), and
    which first ones must be compared with other text around the same gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("bucket",), 1, 1):
            by: list[list[bytes]] = [[], [], [], []]
            for blob, kind in zip(rows.column("blob").to_pylist(), rows.column("kind").to_pylist(), strict=True):
                by[kind].append(blob)
            yield from _told_windows(by[_WINDOW])
            none, ids, ties, place, a, b = _joined(by[_SETTLED], _DONE)
            if len(place):
                yield _found([none, ids, ties], place, -1, a, b)
            none, ids, ties, place, at, left, right, gram, chunk = _joined(by[_ANCHOR], _ANCHORS)
            hot = np.isin(gram, np.array([unpack(x, [np.uint64])[0][0] for x in by[_HOT]], dtype=np.uint64))
            at = at.astype(np.int64)
            lo, hi = at - left, at - right
            order, later, first, head = later_copies(doc_ranks(none, ids, ties)[place], lo, gram, chunk, heads=True)
            gone, open_ = order[later], order[first | (head & hot[order])]
            if len(gone):
                docs, x, y = merged(place[gone], lo[gone], hi[gone])
                yield _found([none, ids, ties], docs, -1, x, y)
            if len(open_):
                yield _found([none, ids, ties], place[open_], at[open_], lo[open_], hi[open_], hot[open_])
    return run


# -- sorted runs --------------------------------------------------------------

_RUN = _DOCS + [np.uint32, np.uint32, np.uint8, np.uint8, np.uint8, np.uint8, np.uint8]


def prefix_lengths(strings: list[bytes]) -> np.ndarray:
    """The common prefix of each string (of at most 255 bytes) with the one before it."""
    if not strings:
        return np.zeros(0, np.uint8)
    width = max(1, max(len(s) for s in strings))
    size = np.array([len(s) for s in strings])
    table = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.concatenate(([0], np.minimum(common, np.minimum(size[1:], size[:-1])))).astype(np.uint8)


def front_code(docs: list[np.ndarray], place: np.ndarray, at: np.ndarray, rights: list[bytes],
               lefts: list[bytes]) -> bytes:
    """A run sorted by its suffixes, each held as the length it shares with the one before and the rest."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    rights, lefts = [rights[k] for k in order], [lefts[k] for k in order]
    shared = prefix_lengths(rights)
    tails = b"".join(s[n:] for s, n in zip(rights, shared.tolist(), strict=True))
    return pack(*docs, place[order].astype(np.uint32), at[order].astype(np.uint32), shared,
                np.array([len(s) for s in rights], np.uint8), np.frombuffer(tails, np.uint8),
                np.array([len(s) for s in lefts], np.uint8), np.frombuffer(b"".join(lefts), np.uint8))


def decode_run(shared: np.ndarray, size: np.ndarray, tails: np.ndarray) -> list[bytes]:
    data, at, last, out = tails.tobytes(), 0, b"", []
    for n, m in zip(shared.tolist(), size.tolist(), strict=True):
        last = last[:n] + data[at:at + m - n]
        at += m - n
        out.append(last)
    return out


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """The common prefix of two strings that agree on their first ``known`` bytes."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def merge_runs(strings: list[list[bytes]], shared: list[list[int]]) -> Iterator[tuple[int, int, int]]:
    """Merge sorted runs by a loser tree: ``(run, place in it, prefix shared with the string put out before)``.

    A loser remembers the prefix it shares with the string that beat it. When
    two strings share different lengths with the last one put out, the longer
    comes first and no byte is looked at; else comparison begins behind the
    shared length. So no byte of a known prefix is compared again.
    """
    many = len(strings)
    if not many:
        return
    leaves = 1
    while leaves < many:
        leaves *= 2
    place, known = [0] * leaves, [0] * leaves
    losers = [-1] * leaves
    head: list = [strings[r][0] if r < many and strings[r] else None for r in range(leaves)]

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's known length becomes that with the winner."""
        if head[a] is None:
            return b, a
        if head[b] is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        x, y = head[a], head[b]
        n = common_prefix(x, y, known[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        winner, loser = play(build(2 * node), build(2 * node + 1))
        losers[node] = loser
        return winner

    winner = build(1)
    while head[winner] is not None:
        yield winner, place[winner], known[winner]
        place[winner] += 1
        if place[winner] < len(strings[winner]):
            head[winner] = strings[winner][place[winner]]
            known[winner] = shared[winner][place[winner]]
        else:
            head[winner] = None
        node = (winner + leaves) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def repeated_windows(rank: np.ndarray, at: np.ndarray, size: np.ndarray, left: np.ndarray, left_size: np.ndarray,
                     shared: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that also start earlier, among anchors sorted by the suffix at them.

    For each distance between a window's start and its anchor: suffixes which
    share the rest of the window are neighbours; of those with the same bytes
    before the anchor all but the first in the order of documents are repeats.
    Gives ``(anchor, lo, hi)``, distances from the anchor.
    """
    ends = np.cumsum(left_size.astype(np.int64))
    prefix = rolled(left)
    order = np.lexsort((at, rank))
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = (rank[order][1:] != rank[order][:-1]) | (at[order][1:] != at[order][:-1])
    turn = np.empty(len(order), dtype=np.int64)
    turn[order] = np.cumsum(new)
    repeats = np.zeros((len(at), length - gram + 1), dtype=bool)
    for back in range(length - gram + 1):
        rest = length - back
        own = np.flatnonzero((left_size >= back) & (size >= rest))
        if len(own) < 2:
            continue
        group = np.cumsum(shared < rest)[own]
        before = spans_hash(prefix, ends[own] - back, ends[own])
        sort = np.lexsort((turn[own], before, group))
        g, h, t = group[sort], before[sort], turn[own][sort]
        fresh_one = np.ones(len(g), dtype=bool)
        fresh_one[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
        first = t[np.flatnonzero(fresh_one)[np.cumsum(fresh_one) - 1]]
        repeats[own[sort[t != first]], back] = True
    flat = np.zeros((len(at), length - gram + 2), dtype=bool)  # a false column parts the rows
    flat[:, :-1] = repeats
    a, b = runs(flat.reshape(-1))
    width = flat.shape[1]
    return a // width, (b - 1) % width, a % width


def _runner(buckets: int, length: int, gram: int):
    """Sorted, front-coded runs of the suffixes at open anchors, dealt by gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            doc, at, rights, lefts = [], [], [], []
            for k, (text, spans) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                own = [s for s in spans or () if s["hot"]]
                if own:
                    _, start = spread(*(np.array([s[n] for s in own]) for n in ("lo", "hi")))
                    low, high = window_hashes(np.frombuffer(text, np.uint8), start, length)
                    table = _own_docs(ids, np.full(len(start), k))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(low[0] % np.uint64(buckets))], pa.int32()), pa.array([_WINDOW], pa.int32()),
                         pa.array([pack(*table, start.astype(np.uint32), low, high)], pa.binary())],
                        names=["bucket", "kind", "blob"])
                for s in spans or ():
                    if s["hot"]:
                        continue
                    doc.append(k)
                    at.append(s["at"])
                    rights.append(text[s["at"]:s["hi"] + length])
                    lefts.append(text[s["lo"]:s["at"]])
            if not doc:
                continue
            grams = b"".join(r[:gram] for r in rights)
            start = np.arange(len(doc)) * gram
            bucket = (mixed(spans_hash(rolled(np.frombuffer(grams, np.uint8)), start, start + gram))
                      % np.uint64(buckets)).astype(np.int64)
            doc, at = np.array(doc), np.array(at)
            sort = np.argsort(bucket, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(bucket[sort], prepend=-1)), len(sort))
            blobs, names = [], []
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                own = sort[x:y]
                *table, place = _own_docs(ids, doc[own])
                blobs.append(front_code(table, place, at[own], [rights[k] for k in own], [lefts[k] for k in own]))
                names.append(int(bucket[own[0]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array([_ANCHOR] * len(names), pa.int32()), pa.array(blobs, pa.binary())],
                names=["bucket", "kind", "blob"])
    return run


def _merger(length: int, gram: int):
    """Merge the runs of a bucket and tell the repeated windows of its anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("bucket",), 1, 1):
            told, kinds = rows.column("blob").to_pylist(), rows.column("kind").to_pylist()
            yield from _told_windows([b for b, k in zip(told, kinds, strict=True) if k == _WINDOW])
            blobs = [b for b, k in zip(told, kinds, strict=True) if k == _ANCHOR]
            strings, known, base = [], [], [0]
            for blob in blobs:
                _, _, _, _, _, shared, size, tails, _, _ = unpack(blob, _RUN)
                strings.append(decode_run(shared, size, tails))
                known.append(shared.tolist())
                base.append(base[-1] + len(size))
            order, common = [], []
            for r, place, n in merge_runs(strings, known):
                order.append(base[r] + place)
                common.append(n)
            order = np.array(order, dtype=np.int64)
            none, ids, ties, place, at, _, size, _, left_size, left = _joined(blobs, _RUN)
            begin = np.concatenate(([0], np.cumsum(left_size.astype(np.int64))))
            sorted_size = left_size[order].astype(np.int64)
            bytes_at = (np.arange(int(sorted_size.sum())) - np.repeat(np.cumsum(sorted_size) - sorted_size, sorted_size)
                        + np.repeat(begin[order], sorted_size))
            at, place = at[order].astype(np.int64), place[order]
            which, far, near = repeated_windows(
                doc_ranks(none, ids, ties)[place], at, size[order], left[bytes_at], left_size[order],
                np.array(common, dtype=np.int64), length, gram)
            if len(which):
                docs, lo, hi = merged(place[which], at[which] - far, at[which] - near)
                yield _found([none, ids, ties], docs, -1, lo, hi)
    return run


def repeated_by_hash(windows: DataFrame) -> DataFrame:
    """Of windows with equal hashes all but the first in the order of documents.
    Grouped in Spark, so a window that very many share is combined before the shuffle."""
    place = F.struct(F.col("key.id").isNull().alias("none"), "key.id", "key.text_hash", "lo")
    own = windows.select("key", "at", "lo", "hi", "hot", "low", "high", place.alias("place"))
    first = own.groupBy("low", "high").agg(F.min("place").alias("first"), F.max("place").alias("last")).filter(
        F.col("first") != F.col("last"))
    return own.join(first, ["low", "high"]).filter(F.col("place") != F.col("first"))


# -- removal ------------------------------------------------------------------


def cut(text: bytes, starts: list[tuple[int, int]], length: int = LENGTH) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes that stay, and the maximal removed runs, for intervals of repeated window starts."""
    spans: list[list[int]] = []
    for lo, hi in sorted(starts):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi + length)
        else:
            spans.append([lo, hi + length])
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join(out) + text[at:], [(a, b) for a, b in spans]


def _cutter(schema: pa.Schema, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans, size, digest = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text = text or b""
                left, gone = cut(text, [(s["lo"], s["hi"]) for s in found or ()], length)
                kept.append(left)
                spans.append([{"start": a, "stop": b} for a, b in gone])
                size.append(len(text))
                digest.append(hashlib.sha256(left).hexdigest())
            columns = {"key": batch.column(0), "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(size, pa.int64()),
                       "kept_sha256": pa.array(digest, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [pa.array(spans, f.type) if f.name == "removed" else columns[f.name].cast(f.type) for f in schema],
                schema=schema)
    return run


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                    gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, removed, kept_sha256`` (and ``kept``): every text's bytes without repeats.

    A byte goes if it is covered by a string of ``length`` bytes that also starts
    earlier: in a document with a smaller id (null comes last; among equal ids
    the text's hash decides) or earlier in the same one. Overlaps count, and
    strings are judged on the input. ``removed`` lists the maximal runs of bytes
    that go; ``kept`` are the others, which need not be valid UTF-8.

    A null text is empty; texts shorter than ``length`` have no repeats of it.
    Rows which repeat id and text are one document and get the same result.
    Other columns are left aside; an empty table gives an empty result.

    Copies are settled inside each batch first, then by gram over all batches;
    of a chunk that very many documents share, each batch sends one anchor. A
    gram with ``HOT_ANCHORS`` different chunks in one batch is hot: wherever it
    occurs, its windows are grouped by hash. A text is read in pieces of bounded
    size, however long.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    if not 2 <= gram <= length <= 255:
        raise ValueError("2 <= gram <= length <= 255 is needed")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))
    own = docs.select(F.struct(F.col(doc_id).cast("long").alias("id"),
                               F.xxhash64(F.col(text).cast("string")).alias("text_hash")).alias("key"), body.alias("body"))
    total = own.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))

    dealt = own.mapInArrow(_scanner(buckets, length, gram, HOT_ANCHORS), "bucket int, kind int, blob binary")
    settled = staged(dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                     .mapInArrow(_settler(), _FOUND), "settled")

    def listed(found: DataFrame) -> DataFrame:
        return found.groupBy("key").agg(F.collect_list(F.struct("at", "lo", "hi", "hot")).alias("found"))

    open_ = listed(settled.filter("at >= 0"))
    runs_ = own.join(open_, "key").select("key", "body", "found").mapInArrow(
        _runner(buckets, length, gram), "bucket int, kind int, blob binary")
    repeats = staged(runs_.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                     .mapInArrow(_merger(length, gram), _FOUND), "repeats")

    windows = settled.filter("at = -2").union(repeats.filter("at = -2"))
    gone = listed(settled.filter("at = -1").union(repeats.filter("at = -1")).unionByName(
        repeated_by_hash(windows).select(*settled.columns)))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    schema = T.StructType([T.StructField("key", _KEY), T.StructField("n_bytes", T.LongType()),
                           T.StructField("removed", T.ArrayType(span)), T.StructField("kept_sha256", T.StringType())]
                          + ([T.StructField("kept", T.BinaryType())] if with_text else []))
    result = own.join(gone, "key", "left").select("key", "body", "found").mapInArrow(
        _cutter(to_arrow_schema(schema), length), schema)
    return result.select(F.col("key.id").alias("doc_id"), *[f.name for f in schema.fields[1:]])
