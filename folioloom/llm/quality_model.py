"""Quality classifier from supervised subword embeddings.

Every word and each of its character n-grams (taken over the word between two boundary marks) is
hashed to a row of one embedding table. A document is the mean of its rows, a softmax layer on top
gives the classes, and both are learned by numpy stochastic gradient descent on a bounded sample of
labelled rows. The layer is linear in
the mean, so for scoring the table shrinks to one number per row, the row's share of the
log-odds: 2**bits floats, whatever the corpus. Scoring is one pass inside Spark tasks, no exchange.

The sample is chosen from ids and lengths, and only chosen texts move. A labelled text above ``row_bytes`` is
passed over, and the next one takes its place; of the others, the ``sample_rows`` with the lowest hashes of
their ids are taken, up to ``sample_bytes`` together. So long texts cannot crowd others out: the sample has
``sample_bytes / row_bytes`` rows at least (128 by default), or all that are usable. Below ``least_rows``, or
without both classes, the driver warns.

Null and empty texts have no features and get the learned prior. Sums run per document, so scores
do not depend on how rows are batched. A sample of one class only gives that class's share as score.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.llm import words
from folioloom.llm.frames import fresh

_BASE = 0xA0761D6478BD642F
_INVERSE = pow(_BASE, -1, 1 << 64)
MARK = 0x20


@dataclass(frozen=True)
class Settings:
    """Bounds of the labelled sample, shape of the model, and the course of training."""

    sample_rows: int = 6000
    sample_bytes: int = 32 << 20
    row_bytes: int = 256 << 10
    least_rows: int = 100
    bits: int = 18
    dims: int = 16
    grams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 6
    rate: float = 20.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Log-odds share of every feature row, and of the prior; labels it has learned from, and those that are 1."""

    settings: Settings
    weight: np.ndarray
    prior: float
    rows: int = 0
    ones: int = 0

    @property
    def both_classes(self) -> bool:
        return 0 < self.ones < self.rows


def features(p: words.Piece, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words, repeats and each n-gram length: (feature rows, first of each document among them).

    Words are laid out anew with one mark between neighbours; a feature belongs to the document in
    whose span it begins. A word equal to the one before it also gives the row of the repeat mark.
    """
    n_words = len(p.starts)
    length = p.ends - p.starts
    # word w begins after its mark: all letters before it plus w + 1 marks
    before = np.concatenate([[0], np.cumsum(length)])
    letters = int(before[-1])
    word_of = np.repeat(np.arange(n_words), length)
    laid = np.full(letters + n_words + 1, MARK, np.uint8)
    laid[np.arange(letters) + word_of + 1] = words.LOWER[p.buf[np.arange(letters) + (p.starts - before[:-1])[word_of]]]
    marks = before + np.arange(n_words + 1)
    n = len(laid)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((laid.astype(np.uint64) + np.uint64(1)) * words.powers(_BASE, n), out=total[1:])
    back = words.powers(_INVERSE, n + 1)
    edges = marks[p.word_at]

    def rows(first: np.ndarray, last: np.ndarray, salt: int) -> np.ndarray:
        h = (total[last] - total[first]) * back[first]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93 + 2 * salt)
        h >>= np.uint64(64 - s.bits)
        return h.view(np.int64)

    whole = rows(marks[:-1], marks[1:] + 1, 0)
    yield whole, p.word_at
    again = np.flatnonzero(whole[1:] == whole[:-1]) + 1
    again = again[~np.isin(again, p.word_at)]
    yield np.full(len(again), (1 << s.bits) - 1), np.searchsorted(again, p.word_at)
    inner = np.zeros(n + 1, np.int32)
    np.cumsum(laid == MARK, out=inner[1:])
    for k in s.grams:
        if (m := n - k + 1) > 0:
            here = np.flatnonzero(inner[k - 1 : k - 1 + m] == inner[1 : m + 1])  # no mark inside, only at the ends
            yield rows(here, here + k, k), np.searchsorted(here, edges)


def spans(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring edges; empty spans give 0."""
    out = np.zeros(len(edges) - 1)
    full = edges[1:] > edges[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, edges[:-1][full])
    return out


def fit(rows: DataFrame, s: Settings = Settings()) -> Model:
    """Learn from all rows of a bounded sample (_text binary, _y, _rank, _hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = list(batches)
        texts = pa.chunked_array([b.column(0) for b in seen], pa.binary()).combine_chunks()
        labels = np.concatenate([np.zeros(0, int), *(b.column(1).to_numpy() for b in seen)])
        m = train(texts, labels, s)
        columns = [pa.array([m.weight.astype("<f4").tobytes()], pa.binary()), *(pa.array([x]) for x in (m.prior, m.rows, m.ones))]
        yield pa.RecordBatch.from_arrays(columns, ["weight", "prior", "n", "ones"])

    # one task holds the bounded sample; only the weights come to the driver
    held = rows.repartition(1).sortWithinPartitions("_rank", "_hash", "_y").select("_text", F.col("_y").cast("int"))
    got = held.mapInArrow(run, "weight binary, prior double, n bigint, ones bigint").collect()
    if not got:
        return train(pa.array([], pa.binary()), np.zeros(0, int), s)
    return Model(s, np.frombuffer(bytes(got[0].weight), "<f4").copy(), got[0].prior, got[0].n, got[0].ones)


def train(texts: pa.Array, labels: np.ndarray, s: Settings = Settings()) -> Model:
    bags: list[tuple[np.ndarray, np.ndarray]] = []
    for p in words.pieces(texts):
        found = list(features(p, s))
        for i in range(len(p)):
            ids, count = np.unique(np.concatenate([f[e[i] : e[i + 1]] for f, e in found]), return_counts=True)
            bags.append((ids.astype(np.int32), (count / max(1, count.sum())).astype(np.float32)))
    y = np.asarray(labels)
    ones = int((y == 1).sum())
    share = (y == 1).mean() if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        odds = np.log((share * len(y) + 1) / ((1 - share) * len(y) + 1)) if len(y) else 0.0
        return Model(s, np.zeros(1 << s.bits, np.float32), float(odds), len(y), ones)
    random = np.random.default_rng(s.seed)
    table = ((random.random((1 << s.bits, s.dims)) - 0.5) / s.dims).astype(np.float32)
    layer, bias = np.zeros((s.dims, 2), np.float32), np.zeros(2, np.float32)
    steps, done = s.epochs * len(bags), 0
    for _ in range(s.epochs):
        for i in random.permutation(len(bags)):
            ids, share_of = bags[i]
            rate = s.rate * (1 - done / steps)
            done += 1
            rows = table[ids]
            mean = share_of @ rows
            z = mean @ layer + bias
            z = np.exp(z - z.max())
            wrong = (z / z.sum()).astype(np.float32)
            wrong[1 if y[i] == 1 else 0] -= 1
            pull = layer @ wrong
            layer -= 0.05 * rate * np.outer(mean, wrong)
            bias -= 0.002 * rate * wrong
            table[ids] = rows - rate * share_of[:, None] * pull
    return Model(s, table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]), len(y), ones)


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    out = []
    for p in words.pieces(texts):
        total, count = np.zeros(len(p)), np.zeros(len(p))
        for rows, edges in features(p, model.settings):
            total += spans(model.weight[rows].astype(np.float64), edges)
            count += np.diff(edges)
        out.append(1 / (1 + np.exp(-(total / np.maximum(count, 1) + model.prior))))
    return np.concatenate(out) if out else np.zeros(0)


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 added."""
    (raw,) = fresh(df, "raw")
    keep = [c for c in df.columns if c.lower() != name.lower()]
    held = df.sparkSession.sparkContext.broadcast(model)  # 2**bits floats
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.array(scores(batch.column(len(keep)), held.value))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], got], names=[*keep, name])

    return df.select(*keep, F.col(text).cast("binary").alias(raw)).mapInArrow(run, f"{fields}, `{name}` double")


def held_out(doc_id) -> F.Column:
    """A fixed quarter of ids, whose labels are never learned from; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def chosen(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(_id, _hash, _y, _rank) of the sample: at most ``sample_rows`` short rows, small by that bound.

    Only ids, hashes and lengths are joined and ordered. Copies with one id, text and label count once.
    """
    usable = labels.filter(labels["quality"].isNotNull() & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
    usable = usable.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_y")).distinct()
    sized = docs.select("doc_id", F.xxhash64("text").alias("_hash"), F.octet_length("text").cast("bigint").alias("_bytes"))
    sized = sized.filter(F.col("_bytes") <= s.row_bytes).distinct()  # null has no length
    both = usable.join(sized, F.col("_id") == F.col("doc_id")).withColumn("_rank", F.xxhash64("_id"))
    order = ["_rank", "_id", "_hash", "_y"]
    first = both.select(*order, "_bytes").orderBy(*order).limit(s.sample_rows)
    # at most sample_rows short rows meet in this window
    first = first.withColumn("_so_far", F.sum("_bytes").over(W.orderBy(*order)))
    return first.filter(F.col("_so_far") <= s.sample_bytes).select(*order)


def from_labels(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Learn ``quality`` of ``labels`` on the texts of ``docs``, without held-out ids."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_text"), F.xxhash64("text").alias("_h"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_h") == F.col("_hash"))
    rows = rows.join(F.broadcast(chosen(docs, labels, s)), same).dropDuplicates(["_id", "_hash", "_y"])
    model = fit(rows.select("_text", "_y", "_rank", "_hash"), s)
    if model.rows < s.least_rows or not model.both_classes:
        warnings.warn(
            f"quality: {model.rows} labelled texts to learn from, {model.ones} of them with label 1; below "
            f"{s.least_rows}, or without both labels, scores say little",
            stacklevel=2,
        )
    return model
