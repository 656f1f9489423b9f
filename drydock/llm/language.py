"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from drydock.llm.common import chunks, code_points, fresh, is_kind, mixed, rolled, runs, slices, spans_hash

UNKNOWN = "und"
FEATURE_BITS = 18
SAMPLE_PER_LABEL = 300
SAMPLE_CHARS = 20_000
PASSES = 25
SEGMENT = 12
BATCH_CHARS = 1_000_000
ROWS = 2048
LEARN_CHARS = 250_000
LEARN_WORDS = 50_000


@dataclass(frozen=True)
class Model:
    """Weights by hashed feature and label, lexicon entries by hash, transition scores."""

    labels: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    entries: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray


# -- words and their features -------------------------------------------------


@dataclass
class Words:
    """The words of some texts in order: their text, and which distinct word each is."""

    doc: np.ndarray
    which: np.ndarray
    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray


def split_words(texts: list[str]) -> Words:
    """Words are runs of letters, in lower case."""
    lowered = [t.lower() for t in texts]
    offsets = np.concatenate(([0], np.cumsum(np.array([len(t) for t in lowered], dtype=np.int64) + 1)))
    points = code_points("\n".join(lowered) + "\n")
    start, end = runs(is_kind(points, "isalpha"))
    hashes, first, which = np.unique(spans_hash(rolled(points), start, end), return_index=True, return_inverse=True)
    return Words(np.searchsorted(offsets, start, "right") - 1, which, points, start[first], end[first], hashes)


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the distinct words, and where each word's begin.

    Features are the word, its first and last one to three letters, and all
    pairs and triples of letters with the word's ends marked.
    """
    n = words.end - words.start
    base = np.concatenate(([0], np.cumsum(n + 2)))
    marked = np.ones(int(base[-1]), dtype=np.uint32)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    marked[np.repeat(base[:-1] + 1, n) + inner] = words.points[np.repeat(words.start, n) + inner]
    prefix, last = rolled(marked), base[1:]
    owner, feature = [], []

    def add(kind: int, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        owner.append(word)
        feature.append(mixed(spans_hash(prefix, start, end) + np.uint64(kind)) >> np.uint64(64 - FEATURE_BITS))

    every = np.arange(len(n))
    add(1, every, base[:-1] + 1, last - 1)
    for size in (1, 2, 3):
        long = np.flatnonzero(n >= size)
        add(1 + size, long, base[long] + 1, base[long] + 1 + size)
        add(4 + size, long, last[long] - 1 - size, last[long] - 1)
    for size in (2, 3):
        count = n + 3 - size
        word = np.repeat(every, count)
        at = np.repeat(base[:-1], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        add(7 + size, word, at, at + size)
    owners = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    order = np.argsort(owners, kind="stable")
    starts = np.searchsorted(owners[order], every)
    return np.concatenate(feature)[order].astype(np.int64), starts


def lexicon_rows(hashes: np.ndarray, model: Model) -> np.ndarray:
    """For each word the labels whose lexicon holds it (0 or 1)."""
    if not len(model.lexicon):
        return np.zeros((len(hashes), len(model.labels)), dtype=np.float32)
    at = np.minimum(np.searchsorted(model.lexicon, hashes), len(model.lexicon) - 1)
    return model.entries[at] * (model.lexicon[at] == hashes)[:, None]


def emissions(words: Words, model: Model) -> np.ndarray:
    """Scores of every label for each distinct word."""
    feature, starts = word_features(words)
    if not len(starts):
        return np.zeros((0, len(model.labels)))
    summed = np.add.reduceat(model.weights[feature], starts, axis=0)
    return summed.astype(np.float64) + lexicon_rows(words.hashes, model) @ model.lexicon_weights


# -- forward-backward ---------------------------------------------------------


def forward_backward(scores: np.ndarray, start: np.ndarray, length: np.ndarray, transitions: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each word of all sequences, which take one step at a time together.

    ``scores`` holds the words of all sequences, each in a row of its own span
    ``start, length``. Also gives expected label pairs (if asked for) and the
    log of the normalisers, summed.
    """
    order = np.argsort(-length, kind="stable")
    begin, size = start[order], length[order]
    top = scores.max(axis=1, keepdims=True) if len(scores) else scores
    local, move = np.exp(scores - top), np.exp(transitions)
    ahead, back = np.zeros_like(local), np.ones_like(local)
    scale = np.ones(len(scores))
    steps = int(size[0]) if len(size) else 0
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(steps)]
    state = None
    for t in range(steps):
        n = active[t]
        at = begin[:n] + t
        state = local[at] if t == 0 else (state[:n] @ move) * local[at]
        total = state.sum(axis=1)
        state = state / total[:, None]
        ahead[at], scale[at] = state, total
    expected = np.zeros_like(transitions)
    state = None
    for t in range(steps - 1, 0, -1):
        n = active[t]
        at = begin[:n] + t
        here = np.ones((n, local.shape[1]))
        if state is not None:
            here[:len(state)] = state
        back[at] = here
        out = here * local[at] / scale[at][:, None]
        if pairs:
            expected += (ahead[at - 1].T @ out) * move
        state = out @ move.T
    if steps and state is not None:
        back[begin[:len(state)]] = state
    marginal = ahead * back
    total = marginal.sum(axis=1, keepdims=True)
    logs = float(np.log(scale).sum() + top.sum()) if len(scores) else 0.0
    return marginal / np.where(total > 0, total, 1), expected, logs


# -- learning -----------------------------------------------------------------


def _joined_words(texts: list[str]) -> Words:
    """``split_words`` of many texts, a part of them in memory at a time."""
    docs, hashes, seen, letters, spans, before = [], [], np.zeros(0, np.uint64), [], [], 0
    for some in chunks(texts, [len(t) for t in texts], LEARN_CHARS):
        words = split_words(some)
        docs.append(words.doc.astype(np.int32) + before)
        before += len(some)
        hashes.append(words.hashes[words.which])
        new = np.flatnonzero(~np.isin(words.hashes, seen))
        seen = np.concatenate((seen, words.hashes[new]))
        n = words.end[new] - words.start[new]
        spans.append(n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        letters.append(words.points[np.repeat(words.start[new], n) + inner])
    n = np.concatenate(spans) if spans else np.zeros(0, np.int64)
    end, order = np.cumsum(n), np.argsort(seen)
    known = seen[order]
    return Words(np.concatenate(docs) if docs else np.zeros(0, np.int32),
                 np.searchsorted(known, np.concatenate(hashes)).astype(np.int32) if hashes else np.zeros(0, np.int32),
                 np.concatenate(letters) if letters else np.zeros(0, np.uint32), (end - n)[order], end[order], known)


def _all_features(words: Words, most: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """``word_features`` of many distinct words, a part of them at a time."""
    features, counts = [], []
    for at in range(0, len(words.hashes), most):
        part = slice(at, at + most)
        feature, starts = word_features(Words(words.doc, words.which, words.points, words.start[part], words.end[part],
                                              words.hashes[part]))
        features.append(feature.astype(np.int32))
        counts.append(np.diff(np.append(starts, len(feature))).astype(np.int32))
    return np.concatenate(features), np.concatenate(counts)


def fit(rows: list[tuple[str, str]], passes: int = PASSES, seed: int = 4, rate: float = 0.3,
        decay: float = 1e-4) -> Model:
    """Learn from ``(text, label)``.

    Segments of a few words from different texts are strung together, so
    sequences switch language and the transitions are learned with the rest.
    All weights climb the regularised log-likelihood by Adam on all sequences;
    the gradient is observed minus expected counts from forward-backward, summed
    over parts of the sequences, which bounds the memory of the driver.
    """
    rows = sorted(rows)
    words = _joined_words([text for text, _ in rows])
    labels = sorted({label for _, label in rows}) if len(words.doc) else []  # without a word nothing is learned
    n_labels = len(labels)
    empty = Model(labels, np.zeros((1 << FEATURE_BITS, n_labels), np.float32), np.zeros(0, np.uint64),
                  np.zeros((0, n_labels), np.float32), np.zeros((n_labels, n_labels)), np.zeros((n_labels, n_labels)))
    if n_labels < 2:
        return empty
    truth = np.array([labels.index(label) for _, label in rows], dtype=np.int8)[words.doc]
    # words which one label uses at least nine times in ten, and more than once, form its lexicon
    n_words = len(words.hashes)
    seen = np.stack([np.bincount(words.which, truth == k, n_words) for k in range(n_labels)], axis=1)
    entries = ((seen >= 0.9 * seen.sum(axis=1, keepdims=True)) & (seen >= 2)).astype(np.float32)
    held = np.flatnonzero(entries.any(axis=1))
    base = Model(labels, empty.weights, words.hashes[held], entries[held], empty.lexicon_weights, empty.transitions)
    lexical = lexicon_rows(words.hashes, base)
    # segments of one text in order; shuffled; three at a time make a sequence
    within = np.arange(len(truth)) - np.searchsorted(words.doc, words.doc)
    first = np.flatnonzero(within % SEGMENT == 0)
    sizes = np.diff(np.append(first, len(truth)))
    shuffled = np.random.default_rng(seed).permutation(len(first))
    size = sizes[shuffled]
    picked = np.arange(len(truth)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[shuffled], size)
    length = np.add.reduceat(size, np.arange(0, len(size), 3))
    start = np.concatenate(([0], np.cumsum(length)[:-1]))
    which, truth = words.which[picked], truth[picked]
    inside = np.ones(len(truth), dtype=bool)
    inside[start] = False
    observed_pairs = np.zeros((n_labels, n_labels))
    np.add.at(observed_pairs, (truth[np.flatnonzero(inside) - 1], truth[inside]), 1)
    feature, counts = _all_features(words)
    del words, picked, within
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(n_words, dtype=np.int32), counts)
    used = np.flatnonzero(np.bincount(feature, minlength=1 << FEATURE_BITS))
    place = np.zeros(1 << FEATURE_BITS, dtype=np.int32)
    place[used] = np.arange(len(used))
    compact = place[feature]
    del feature
    params = [np.zeros((n_labels, len(used))), np.zeros((n_labels, n_labels)), np.zeros((n_labels, n_labels))]
    first_moment, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for turn in range(1, passes + 1):
        scores = np.stack([np.add.reduceat(params[0][k][compact], starts) for k in range(n_labels)], axis=1)
        scores += lexical @ params[1]
        by_word, pairs = np.zeros((n_labels, n_words)), np.zeros((n_labels, n_labels))
        for some in chunks(np.arange(len(start)), length, LEARN_WORDS):
            a, b = start[some[0]], start[some[-1]] + length[some[-1]]
            marginal, met, _ = forward_backward(scores[which[a:b]], start[some] - a, length[some], params[2], pairs=True)
            pairs += met
            for k in range(n_labels):
                by_word[k] += np.bincount(which[a:b], (truth[a:b] == k) - marginal[:, k], n_words)
        gradient = [np.stack([np.bincount(compact, by_word[k][owner], len(used)) for k in range(n_labels)]),
                    lexical.T @ by_word.T, observed_pairs - pairs]
        for k, g in enumerate(gradient):
            g = g / len(truth) - decay * params[k]
            first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] + rate * (first_moment[k] / (1 - 0.9 ** turn)) / (
                np.sqrt(second[k] / (1 - 0.999 ** turn)) + 1e-8)
    weights = np.zeros((1 << FEATURE_BITS, n_labels), np.float32)
    weights[used] = params[0].T
    return Model(labels, weights, base.lexicon, base.entries, params[1], params[2])


def training_rows(docs: DataFrame, text: str, label: str, eligible: Column, per_label: int = SAMPLE_PER_LABEL,
                  most_chars: int = SAMPLE_CHARS, seed: int = 4) -> list[tuple[str, str]]:
    """About ``per_label`` distinct texts of each label, drawn by hash from the eligible rows:
    the documented bound of what is learned from.

    Copies count once, so a label with up to ``per_label`` distinct texts is
    learned from all of them. Of a text longer than ``most_chars`` that many
    characters are taken, from a place drawn by hash.
    """
    own = docs.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label"),
                      eligible.alias("eligible")).filter("eligible AND label IS NOT NULL AND text IS NOT NULL").select(
        "text", "label", F.xxhash64(F.lit(seed), "text").alias("hash"))
    counts = {r[0]: r[1] for r in own.groupBy("label").agg(F.countDistinct("hash")).collect()}
    if not counts:
        return []
    wanted = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, per_label / n))])
    draw = F.pmod(F.col("hash"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    places = F.greatest(F.length("text") - most_chars, F.lit(0)) + 1
    begin = (F.pmod(F.xxhash64("hash"), places.cast("long")) + 1).cast("int")
    rows = own.filter(draw < F.element_at(wanted, F.col("label"))).select(
        F.col("text").substr(begin, F.lit(most_chars)).alias("text"), "label").distinct().collect()
    return sorted((r[0], r[1]) for r in rows)


# -- predicting ---------------------------------------------------------------


def label_texts(texts: list[str], model: Model) -> tuple[list[str], np.ndarray, list[list[tuple]]]:
    """For each text its language, that language's share of all word marginals, and
    the runs of words in one language ``(label, n_words)``."""
    words = split_words(texts)
    labels, score, spans = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
    if not len(words.which) or not model.labels:
        return labels, score, spans
    docs, begin = np.unique(words.doc, return_index=True)
    length = np.diff(np.append(begin, len(words.doc)))
    marginal, _, _ = forward_backward(emissions(words, model)[words.which], begin, length, model.transitions)
    share = np.add.reduceat(marginal, begin, axis=0) / length[:, None]
    best = share.argmax(axis=1)
    score[docs] = np.clip(share[np.arange(len(docs)), best], 0.0, 1.0)
    word_label = marginal.argmax(axis=1)
    new = np.ones(len(word_label), dtype=bool)
    new[1:] = (np.diff(word_label) != 0) | (np.diff(words.doc) != 0)
    opened = np.flatnonzero(new)
    size = np.diff(np.append(opened, len(word_label)))
    for d, k, n in zip(words.doc[opened].tolist(), word_label[opened].tolist(), size.tolist(), strict=True):
        spans[d].append((model.labels[k], n))
    for d, k in zip(docs.tolist(), best.tolist(), strict=True):
        labels[d] = model.labels[k]
    return labels, score, spans


def _labeller(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels: list[str] = []
            scores: list[np.ndarray] = [np.zeros(0)]
            spans: list = []
            for texts in slices(batch.column(0), ROWS):
                for some in chunks(texts, [len(t) for t in texts], BATCH_CHARS):
                    a, b, c = label_texts(some, shared.value)
                    labels += a
                    scores.append(b)
                    spans += c
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(schema.field(0).type), pa.array(labels, pa.string()),
                 pa.array(np.concatenate(scores)),
                 pa.array([[{"label": k, "n_words": n} for k, n in s] for s in spans], schema.field(3).type)],
                schema=schema)
    return run


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, spans``: the language of every whole text.

    ``score`` is the predicted language's share of the word marginals, and
    ``spans`` are the runs of words in one language. Only the text is looked at.
    A null text or one without a letter is ``und`` with score 0 and no spans; so
    is every text where nothing could be learned. Each row is labelled for
    itself. A text is one chain however long, in memory proportional to it.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.col(text).cast("string").alias("text"), F.col(key).alias("key"))
    span = T.StructType([T.StructField("label", T.StringType()), T.StructField("n_words", T.LongType())])
    schema = T.StructType([T.StructField(key, own.schema["key"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    return own.mapInArrow(_labeller(shared, to_arrow_schema(schema)), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text leaves 1 when divided by 3 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", **options) -> Model:
    """A model of the labelled rows that are not held out (a null id teaches nothing)."""
    return fit(training_rows(docs, text, label, ~held_out(doc_id) & F.col(doc_id).isNotNull(), **options))


def _teller(shared, least: float):
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found: list[str | None] = []
            for texts in slices(batch, ROWS):
                for some in chunks(texts, [len(t) for t in texts], BATCH_CHARS):
                    labels, scores, _ = label_texts(some, shared.value)
                    found += [label if label != UNKNOWN and score >= least else None
                              for label, score in zip(labels, scores, strict=True)]
            yield pa.array(found, pa.string())
    return arrow_udf(told, T.StringType())


def _told(docs: DataFrame, model: Model, text: str, least: float):
    if not model.labels:  # one label for whatever has a word
        model = Model([""], np.zeros((1 << FEATURE_BITS, 1), np.float32), np.zeros(0, np.uint64),
                      np.zeros((0, 1), np.float32), np.zeros((1, 1)), np.zeros((1, 1)))
    return _teller(docs.sparkSession.sparkContext.broadcast(model), least), F.col(f"`{text}`").cast("string")


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language could be told
    (not ``und``, score at least ``least``). Where nothing could be learned, those with a letter.
    Only the text goes to Python, and only the answer comes back."""
    told, own = _told(docs, model, text, least)
    return docs.filter(told(own).isNotNull())


def relabelled(docs: DataFrame, model: Model, text: str = "text", label: str = "lang", least: float = 0.0) -> DataFrame:
    """The rows that ``accepted`` keeps, their ``label`` replaced by the language that was told.
    Where nothing could be learned, labels stay. All other columns, and the order of columns, are those of ``docs``."""
    told, own = _told(docs, model, text, least)
    name = fresh(docs, "told")
    # Spark would compute a deterministic function once for the filter and once for the column
    found = docs.withColumn(name, told.asNondeterministic()(own)).filter(F.col(name).isNotNull())
    new = F.col(name).cast(docs.schema[label].dataType) if model.labels else F.col(f"`{label}`")
    return found.select(*[new.alias(c) if c == label else F.col(f"`{c}`") for c in docs.columns])
