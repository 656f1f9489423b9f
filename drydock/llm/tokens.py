"""Token counts by a linear longest-match automaton."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from drydock.llm.common import chunks, rolled, runs, spans_hash

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
LONG_WORD = 64


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file (one base64 piece and its rank per line) of bounded size."""
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@dataclass(frozen=True)
class Automaton:
    """A trie over bytes: ``child[at]`` is reached from node ``edge[at] >> 8`` by
    byte ``edge[at] & 255``; ``fail`` and ``popped`` say where a node falls back
    to and how many pieces are complete by then."""

    edge: np.ndarray
    child: np.ndarray
    fail: np.ndarray
    popped: np.ndarray
    root_child: np.ndarray


def build_automaton(pieces: list[bytes]) -> Automaton:
    """Trie, failure links and popped counts; every single byte counts as a piece.

    A node that is a piece falls back to the root, popping itself. Any other
    pops what its parent pops and follows the parent's fall-back until a node
    with its byte is found; as single bytes are pieces, the root always has it.
    """
    whole = [bytes([b]) for b in range(256)] + [p for p in pieces if p]
    children: list[dict[int, int]] = [{}]
    is_piece, order = [False], [[0]]
    depth = [0]
    for piece in whole:
        node = 0
        for byte in piece:
            step = children[node].get(byte)
            if step is None:
                step = children[node][byte] = len(children)
                children.append({})
                is_piece.append(False)
                depth.append(depth[node] + 1)
                if depth[step] == len(order):
                    order.append([])
                order[depth[step]].append(step)
            node = step
        is_piece[node] = True
    fail, popped = [0] * len(children), [0] * len(children)
    for level in order:
        for node in level:
            for byte, step in children[node].items():
                if is_piece[step]:
                    fail[step], popped[step] = 0, 1
                    continue
                back, n = fail[node], popped[node]
                while byte not in children[back]:
                    n += popped[back]
                    back = fail[back]
                fail[step], popped[step] = children[back][byte], n
    edges = sorted((node << 8 | byte, step) for node, at in enumerate(children) for byte, step in at.items())
    return Automaton(np.array([e for e, _ in edges], np.int64), np.array([s for _, s in edges], np.int64),
                     np.array(fail, np.int64), np.array(popped, np.int64),
                     np.array([children[0][b] for b in range(256)], np.int64))


def _steps(auto: Automaton, node: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Take one byte from each node: the next nodes, and the pieces popped on the way."""
    node, popped = node.copy(), np.zeros(len(node), dtype=np.int64)
    out, todo = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
    while len(todo):
        at_root = node[todo] == 0
        out[todo[at_root]] = auto.root_child[byte[todo[at_root]]]
        todo = todo[~at_root]
        key = node[todo] << 8 | byte[todo]
        at = np.minimum(np.searchsorted(auto.edge, key), len(auto.edge) - 1)
        known = auto.edge[at] == key
        out[todo[known]] = auto.child[at[known]]
        todo = todo[~known]
        popped[todo] += auto.popped[node[todo]]
        node[todo] = auto.fail[node[todo]]
    return out, popped


def count_words(auto: Automaton, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Pieces of each word ``blank + data[start:end]``, all words taking one byte at a time together."""
    total = np.zeros(len(start), dtype=np.int64)
    length = end - start
    for w in np.flatnonzero(length > LONG_WORD):  # one long word would keep all others waiting
        total[w] = _count_long(auto, data[start[w]:end[w]])
    short = np.flatnonzero(length <= LONG_WORD)
    order = short[np.argsort(-length[short], kind="stable")]
    node = np.full(len(order), auto.root_child[32], dtype=np.int64)
    counts = np.zeros(len(order), dtype=np.int64)
    first, longest = start[order], length[order]
    for step in range(int(longest[0]) if len(order) else 0):
        active = int(np.searchsorted(-longest, -step, "left"))  # lengths fall: those above step
        node[:active], popped = _steps(auto, node[:active], data[first[:active] + step].astype(np.int64))
        counts[:active] += popped
    while node.any():
        counts += np.where(node > 0, auto.popped[node], 0)
        node = np.where(node > 0, auto.fail[node], 0)
    total[order] = counts
    return total


def _count_long(auto: Automaton, word: np.ndarray) -> int:
    edge, child, fail, popped = auto.edge, auto.child, auto.fail, auto.popped
    memo: dict[int, tuple[int, int]] = {}
    node, n = int(auto.root_child[32]), 0
    for byte in word.tolist():
        key = node << 8 | byte
        known = memo.get(key)
        if known is None:
            back, pops = node, 0
            while True:
                at = int(np.searchsorted(edge, back << 8 | byte))
                if at < len(edge) and edge[at] == back << 8 | byte:
                    known = memo[key] = (int(child[at]), pops)
                    break
                pops += int(popped[back])
                back = int(fail[back])
        node, n = known[0], n + known[1]
    while node:
        n += int(popped[node])
        node = int(fail[node])
    return n


def count_texts(auto: Automaton, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens of each text; each distinct word of the batch is matched once."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    start, end = runs(~((data == 32) | ((data >= 9) & (data <= 13))))
    if not len(start):
        return np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    _, first, which = np.unique(spans_hash(rolled(data), start, end), return_index=True, return_inverse=True)
    tokens = count_words(auto, data, start[first], end[first])[which]
    doc = np.searchsorted(offsets, start, "right") - 1
    return (np.bincount(doc, minlength=len(texts)),
            np.bincount(doc, weights=tokens, minlength=len(texts)).astype(np.int64))


def _counter(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).to_pylist()]
            parts = [count_texts(shared.value, some)
                     for some in chunks(texts, [len(t) for t in texts], BATCH_BYTES)]
            words, tokens = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*parts, strict=True)) \
                if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(schema.field(0).type), pa.array(np.array([len(t) for t in texts], np.int64)),
                 pa.array(words.astype(np.int64)), pa.array(tokens)], schema=schema)
    return run


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_bytes, n_words, n_tokens`` of every text.

    A word is a run of bytes other than blank, tab, line feed to carriage
    return; with one blank before it, it is cut into the longest pieces of the
    vocabulary from left to right. Only counts are kept: the automaton reads
    each byte of a word once, and a failure link adds the number of pieces that
    are complete, so time is linear in the text and no piece is built.
    A byte that is no piece itself counts as one.

    Null and empty texts have no bytes, words or tokens. Every row is counted
    for itself, so repeated rows and ids repeat in the result; other columns are
    left aside. One pass, no shuffle: the vocabulary, of checked size, is all
    that is sent to the executors.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    shared = docs.sparkSession.sparkContext.broadcast(build_automaton(read_vocabulary(vocabulary)))
    own = docs.select(F.col(text).cast("string").cast("binary").alias("text"), F.col(doc_id).alias("doc_id"))
    schema = T.StructType([T.StructField("doc_id", own.schema["doc_id"].dataType)]
                          + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_words", "n_tokens")])
    return own.mapInArrow(_counter(shared, to_arrow_schema(schema)), schema)
