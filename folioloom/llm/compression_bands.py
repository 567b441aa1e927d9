"""Quality rules: zstandard compression bands beside base statistics.

A text that compresses far better than prose of its length repeats itself; one that hardly
compresses is noise. The ratio (compressed / raw bytes) depends on the length, since a short text
has little to refer back to, so limits come in length classes. Whole documents and fixed chunks
are both measured: a long document can hide a repetitive or random stretch in a normal average.

Ratios of prose fall with length, so a class's highest ratio is what running text reaches at the class's
shortest length: the largest of 1.5 MB of general text (technical English, licences, manuals), rounded up.
Text with more than a quarter of its bytes outside ASCII (Greek, Cyrillic, Chinese, ...) compresses
differently and has highest ratios of its own, from translated messages of such languages. Noise below these
limits cannot be told from prose by a ratio; the README says which.

One pass over whole texts inside Spark tasks; no exchange. Null counts as an empty text: all
figures 0, ``base_failed`` true, ``kept`` false. Repeated rows get the same answer each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from folioloom.llm import words
from folioloom.llm.frames import fresh

STATISTICS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, ratio double, n_chunks int, n_low_chunks int, n_high_chunks int, kept boolean"
)
#: Characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Bands:
    """(up to so many bytes, lowest ratio, highest ratio, highest if mostly outside ASCII), and the chunk rule.

    A text is rejected if its ratio is outside its band, or if more than ``chunk_share`` of its
    chunks are outside ``chunk_band``. Chunks are full; if some bytes are left over, one more ends at the end of
    the text and overlaps the one before. Texts of one chunk or less have no chunk rule.
    """

    whole: tuple[tuple[float, float, float, float], ...] = (
        (128, 0.0, 1.35, 1.35),
        (256, 0.35, 1.08, 1.08),
        (512, 0.35, 0.91, 1.05),
        (1024, 0.30, 0.79, 0.92),
        (2048, 0.30, 0.70, 0.78),
        (4096, 0.28, 0.61, 0.67),
        (8192, 0.28, 0.56, 0.60),
        (16384, 0.22, 0.52, 0.56),
        (float("inf"), 0.22, 0.46, 0.54),
    )
    chunk: int = 4096
    chunk_band: tuple[float, float, float] = (0.25, 0.56, 0.60)
    chunk_share: float = 0.25
    level: int = 3
    #: Share of bytes outside ASCII above which the last limit holds.
    wide: float = 0.25


def score(df: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """``df`` without its text, plus the statistics and the verdict.

    Of columns whose names clash with a result, the result stays.
    """
    result = [c.split()[0] for c in STATISTICS.split(", ")]
    keep = [c for c in df.columns if c != text and c.lower() not in result]
    (raw,) = fresh(df, "raw")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = measure(batch.column(len(keep)), bands)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], names=[*keep, *result])

    narrow = df.select(*[df[c] for c in keep], df[text].cast("binary").alias(raw))
    return narrow.mapInArrow(run, ", ".join(x for x in (fields, STATISTICS) if x))


def measure(texts: pa.Array, bands: Bands) -> list[pa.Array]:
    out = [[] for _ in STATISTICS.split(", ")]
    press = zstandard.ZstdCompressor(level=bands.level)
    for p in words.pieces(texts):
        n_words = np.diff(p.word_at)
        # code points: bytes that do not continue one
        chars = p.per_document(((p.buf & 0xC0) != 0x80) & ~words.SPACE[p.buf])
        symbols = p.per_document(SYMBOLS[p.buf])
        repeat = repeat_words(p)
        raw = p.buf.tobytes()
        for i in range(len(p)):
            doc = raw[p.at[i] : p.at[i + 1]]
            failed = bool(n_words[i] < 20 or 100 * repeat[i] > 30 * n_words[i])
            ratio, n, low, high, fits = compression(doc, press, bands)
            row = (n_words[i], chars[i], symbols[i], dup_lines(doc), repeat[i], failed, ratio, n, low, high,
                   fits and not failed)
            for column, value in zip(out, row, strict=True):
                column.append(value)
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
    return [pa.array(v, kinds[c.split()[1]]) for v, c in zip(out, STATISTICS.split(", "), strict=True)]


def compression(doc: bytes, press: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, int, int, int, bool]:
    """(ratio, chunks, repetitive chunks, incompressible chunks, inside all bands); empty texts fit."""
    if not doc:
        return 0.0, 0, 0, 0, True
    far = np.frombuffer(doc, np.uint8) >= 0x80

    def highest(limits: tuple[float, ...], first: int, last: int) -> float:
        return limits[-1] if far[first:last].mean() > bands.wide else limits[-2]

    ratio = len(press.compress(doc)) / len(doc)
    _, lowest, *most = next(x for x in bands.whole if len(doc) <= x[0])
    starts = [*range(0, len(doc) - bands.chunk, bands.chunk), len(doc) - bands.chunk] if len(doc) > bands.chunk else []
    n = len(starts)
    each = [len(press.compress(doc[i : i + bands.chunk])) / bands.chunk for i in starts]
    low = sum(r < bands.chunk_band[0] for r in each)
    high = sum(r > highest(bands.chunk_band, i, i + bands.chunk) for i, r in zip(starts, each, strict=True))
    fits = lowest <= ratio <= highest(most, 0, len(doc)) and low + high <= bands.chunk_share * n
    return ratio, n, low, high, fits


def dup_lines(doc: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [x for x in doc.split(b"\n") if x.strip()]  # bytes.strip() knows exactly the six separators
    return len(lines) - len(set(lines))


def repeat_words(p: words.Piece, k: int = 8) -> np.ndarray:
    """Words per document inside k-word windows that the document has twice or more."""
    h = p.word_hashes()
    gram = words.grams(h, k)
    n = np.diff(p.word_at)
    out = np.zeros(len(p), np.int64)
    if not len(gram):
        return out
    ok = np.flatnonzero(words.inside(p.word_at, len(h), k))
    doc = np.searchsorted(p.word_at, ok, side="right") - 1
    # equal windows of one document are neighbours after the sort
    key = words.mix(gram[ok] + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(ok), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    if twice.any():
        hit = words.covered(ok[twice], k, len(h))
        total = np.concatenate([[0], np.cumsum(hit)])
        out = total[p.word_at[1:]] - total[p.word_at[:-1]]
    assert (out <= n).all()
    return out
