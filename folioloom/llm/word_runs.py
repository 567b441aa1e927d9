"""Periodic runs of words, found on a Re-Pair grammar of the word ids.

A run is a maximal stretch of words with smallest period q in which equal words recur q apart, at least
max(6, 4 q) words long. The documents of a piece are compressed together: in every round pairs of neighbouring
symbols that occur twice or more are replaced, the most frequent first, until none repeats; what is left of a
document is then paired neighbour by neighbour up to one root. Every symbol stands for a fixed stretch of words,
and every run crosses the inner boundary of exactly one lowest symbol that holds it whole. So runs across the
boundary are computed once per symbol, taken to all places where the symbol was made, and intervals of one
period that overlap by a period or more are merged to maximal ones.

Across a boundary, one side holds two full periods. Candidates for q are those whose first words agree and
whose two halves have equal hashes; each is then compared word by word, so hashes never decide. Words are told
apart by 64-bit hashes. Work is O(n log n) words of numpy per document and memory follows the longest text.

Null and empty texts have no words and no runs. Every row is judged on its own: ties, repeated rows and null ids
change nothing, and an empty table gives an empty one. Other columns pass through; a column with one of the
names made here is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm import words

RUN = "struct<start: bigint, length: bigint, period: bigint>"
RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SHORTEST, EXPONENT = 6, 4
#: Candidate periods looked at together.
CHUNK = 1 << 20


class Grammar:
    """Symbols of a text: ``first``, ``left`` and ``size`` are one place, the left part's and the whole length;
    occurrence i is of symbol ``symbol[i]`` at word ``place[i]``. Only symbols of two or more words are listed."""

    def __init__(self, ids: np.ndarray, word_at: np.ndarray):
        self.first, self.left, self.size, self.symbol, self.place = [], [], [], [], []
        self.made = 0
        self.sym = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        self.base = int(self.sym.max()) + 1 if len(ids) else 0
        self.length = np.ones(len(ids), np.int64)
        self.at = np.arange(len(ids), dtype=np.int64)
        self.doc = np.repeat(np.arange(len(word_at) - 1), np.diff(word_at))
        self._repeated_pairs()
        self._rest()
        self.first, self.left, self.size, self.symbol, self.place = (
            np.concatenate(x) if x else np.zeros(0, np.int64)
            for x in (self.first, self.left, self.size, self.symbol, self.place)
        )

    def _replace(self, chosen: np.ndarray, of: np.ndarray, n: int) -> None:
        """Put new symbols for the pairs that begin at ``chosen``; the i-th is of the new symbol ``of[i]`` of n."""
        one = np.zeros(n, np.int64)
        one[of] = chosen
        self.first.append(self.at[one])
        self.left.append(self.length[one])
        self.size.append(self.length[one] + self.length[one + 1])
        self.symbol.append(of + self.made)
        self.place.append(self.at[chosen])
        self.length[chosen] += self.length[chosen + 1]
        self.sym[chosen] = of + self.made + self.base
        self.made += n
        keep = np.ones(len(self.sym), bool)
        keep[chosen + 1] = False
        self.kept = keep
        self.sym, self.length, self.at, self.doc = (x[keep] for x in (self.sym, self.length, self.at, self.doc))

    def _repeated_pairs(self) -> None:
        """Rounds over pairs that may repeat; a pair of old symbols never becomes more frequent, so others rest."""
        live = np.flatnonzero(self.doc[1:] == self.doc[:-1])
        while len(live):
            code = self.sym[live] * np.int64(self.base + self.made) + self.sym[live + 1]
            # of a a a ... every second pair counts
            same = np.zeros(len(live), bool)
            same[1:] = (code[1:] == code[:-1]) & (live[1:] == live[:-1] + 1)
            begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(live))))
            even = (np.arange(len(live)) - begin) % 2 == 0
            live, code = live[even], code[even]
            _, pair, count = np.unique(code, return_inverse=True, return_counts=True)
            often = count[pair] > 1
            live, pair = live[often], pair[often]
            if not len(live):
                return
            rank = np.empty(len(count), np.int64)
            rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
            rank = rank[pair]
            # a pair gives way to a more frequent one that shares a symbol with it
            best = np.ones(len(live), bool)
            touch = live[1:] == live[:-1] + 1
            best[1:] &= ~touch | (rank[1:] < rank[:-1])
            best[:-1] &= ~touch | (rank[:-1] <= rank[1:])
            chosen = live[best]
            names, of = np.unique(pair[best], return_inverse=True)
            fresh = np.zeros(len(self.sym), bool)
            fresh[chosen] = True
            again = np.zeros(len(self.sym), bool)
            again[live] = True
            self._replace(chosen, of, len(names))
            fresh, again = fresh[self.kept], again[self.kept]
            again[:-1] |= fresh[1:]
            live = np.flatnonzero((again | fresh)[:-1] & (self.doc[1:] == self.doc[:-1]))

    def _rest(self) -> None:
        while len(self.doc) > 1:
            new = np.ones(len(self.doc), bool)
            new[1:] = self.doc[1:] != self.doc[:-1]
            index = np.arange(len(self.doc))
            index -= np.maximum.accumulate(np.where(new, index, 0))
            chosen = np.flatnonzero((index[:-1] % 2 == 0) & ~new[1:])
            if not len(chosen):
                return
            self._replace(chosen, np.arange(len(chosen)), len(chosen))


def candidates(ids: np.ndarray, begin: np.ndarray, mid: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbol, period, anchor): squares next to a boundary; words from the anchor agree with those a period on."""
    total = np.zeros(len(ids) + 1, np.uint64)
    power = words.powers(words._BASE, len(ids) + 1)
    np.cumsum(ids * power[:-1], out=total[1:])
    for after in (True, False):
        most = np.minimum((end - mid if after else mid - begin) // 2, (end - begin) // EXPONENT)
        upto = np.concatenate([[0], np.cumsum(most)])
        a = 0
        while a < len(most):
            b = max(a + 1, int(np.searchsorted(upto, upto[a] + CHUNK, side="right")) - 1)
            n = most[a:b]
            node = np.repeat(np.arange(a, b), n)
            q = np.arange(len(node)) - np.repeat(upto[a:b] - upto[a], n) + 1
            near = mid[node] - (0 if after else 1)
            ok = ids[near] == ids[near + q if after else near - q]
            node, q = node[ok], q[ok]
            x = mid[node] - (0 if after else 2 * q)
            ok = (total[x + q] - total[x]) * power[q] == total[x + 2 * q] - total[x + q]
            yield node[ok], q[ok], x[ok]
            a = b


def reach(ids: np.ndarray, at: int, q: int, begin: int, end: int) -> tuple[int, int]:
    """The longest stretch around ``at`` inside [begin, end) whose words agree with those q on."""
    low, step = at, 64
    while low > begin:
        a = max(begin, low - step)
        differ = np.flatnonzero(ids[a:low] != ids[a + q : low + q])
        if len(differ):
            low = a + int(differ[-1]) + 1
            break
        low, step = a, step * 2
    high, step = at, 64
    while high + q < end:
        b = min(end - q, high + step)
        differ = np.flatnonzero(ids[high:b] != ids[high + q : b + q])
        if len(differ):
            high += int(differ[0])
            break
        high, step = b, step * 2
    return low, high + q


def crossing(ids: np.ndarray, begin: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows (symbol, start within it, end within it, period): long stretches across the boundary, smallest periods."""
    found = set()
    for node, period, anchor in candidates(ids, begin, mid, end):
        order = np.lexsort((period, node))
        node, period, anchor = node[order], period[order], anchor[order]
        for x in np.split(np.arange(len(node)), np.flatnonzero(np.diff(node)) + 1):
            while len(x):
                k, q, at = int(node[x[0]]), int(period[x[0]]), int(anchor[x[0]])
                low, high = reach(ids, at, q, int(begin[k]), int(end[k]))
                if high - low >= max(SHORTEST, EXPONENT * q):
                    found.add((k, low - int(begin[k]), high - int(begin[k]), q))
                x = x[1:]
                if high - low >= 2 * q:  # multiples of q in the same stretch are no smallest periods
                    p = period[x]
                    x = x[(p % q > 0) | (anchor[x] < low) | (anchor[x] + 2 * p > high)]
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.array(sorted(found), np.int64)  # of one stretch the smallest period comes first
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[new]


def runs_of(ids: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) in the concatenated words, by start, then period."""
    g = Grammar(ids, word_at)
    long = np.flatnonzero(g.size >= SHORTEST)
    rows = crossing(ids, g.first[long], g.first[long] + g.left[long], g.first[long] + g.size[long])
    if not len(rows):
        return np.zeros((0, 3), np.int64)
    order = np.argsort(g.symbol, kind="stable")
    place, upto = g.place[order], np.searchsorted(g.symbol[order], np.arange(g.made + 1))
    of = long[rows[:, 0]]
    n = upto[of + 1] - upto[of]
    each = np.repeat(np.arange(len(rows)), n)
    where = place[np.repeat(upto[of] - (np.cumsum(n) - n), n) + np.arange(len(each))]
    start, end, q = where + rows[each, 1], where + rows[each, 2], rows[each, 3]
    order = np.lexsort((start, q))
    start, end, q = start[order], end[order], q[order]
    shift = np.cumsum(np.concatenate([[0], np.diff(q) > 0])) * np.int64(len(ids) + 1)
    upto = np.maximum.accumulate(end + shift)
    new = np.ones(len(start), bool)
    new[1:] = (start + shift)[1:] > upto[:-1] - q[1:]
    at = np.flatnonzero(new)
    start, q = start[at], q[at]
    length = upto[np.concatenate([at[1:], [len(new)]]) - 1] - shift[at] - start
    order = np.lexsort((q, start))
    return np.stack([start, length, q], axis=1)[order]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; then the first start, then the smallest period."""
    best = None
    for r in runs:  # they come by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def looped(doc_id: int, n: int) -> np.ndarray | None:
    """Source of every word where the id's checksum asks for a text that runs in circles from word a on."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


def joined(p: words.Piece, source: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Words ``source`` of a piece, one space between them; ``edges`` cut them into documents."""
    n = p.ends[source] - p.starts[source] + 1
    upto = np.concatenate([[0], np.cumsum(n)])
    buf = np.append(p.buf, np.uint8(32))
    out = buf[np.repeat(p.starts[source] - upto[:-1], n) + np.arange(upto[-1])]
    out[upto[1:] - 1] = 32
    raw, cut = out.tobytes(), upto[edges]
    return [raw[a : max(a, b - 1)] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def piece_rows(p: words.Piece, ids: list[int | None] | None) -> tuple[list, list, list, list]:
    """Per document of a piece: number of words, runs, the strongest run, and the text without repeats."""
    source = np.arange(len(p.starts))
    for i, doc_id in enumerate(ids or []):
        a, b = p.word_at[i], p.word_at[i + 1]
        if doc_id is not None and (other := looped(doc_id, int(b - a))) is not None:
            source[a:b] = a + other
    runs = runs_of(p.word_hashes()[source], p.word_at)
    change = np.zeros(len(source) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    cut = np.searchsorted(runs[:, 0], p.word_at)
    per_doc = []
    for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        own = runs[a:b] - [p.word_at[i], 0, 0]
        per_doc.append([tuple(r) for r in own.tolist()])
    return np.diff(p.word_at).tolist(), per_doc, [strongest(r) for r in per_doc], joined(p, source[kept], np.searchsorted(kept, p.word_at))


def collapse(docs: DataFrame, loops: bool = False) -> DataFrame:
    """``docs`` with ``text`` cut to one period of each run, and n_words, n_runs, runs, strongest.

    ``runs`` lists (start, length, period) by start, then period; ``strongest`` is the one of greatest
    length / period. With ``loops`` a tenth of the texts, chosen by doc_id, first runs in circles from some word on;
    a row without id is then left as it is.
    """
    made = ("text", "n_words", "n_runs", "runs", "strongest")
    other = [c for c in docs.columns if c not in made]
    row = F.struct(*(F.col(f"`{c}`") for c in other)) if other else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), F.col("text").cast("binary").alias("raw"), *([F.col("doc_id").alias("id")] if loops else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in words.pieces(batch.column(1)):
                own = batch.slice(p.first, len(p))
                n, runs, best, text = piece_rows(p, own.column(2).to_pylist() if loops else None)
                best = [None if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in best]
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in each] for each in runs]
                cols = [own.column(0), pa.array(text, pa.binary()), pa.array(n, pa.int64()), pa.array([len(r) for r in runs], pa.int64()),
                        pa.array(runs, pa.list_(RUN_ARROW)), pa.array(best, RUN_ARROW)]
                yield pa.RecordBatch.from_arrays(cols, ["row", "raw", "n_words", "n_runs", "runs", "strongest"])

    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(run, f"row {kind}, raw binary, n_words bigint, n_runs bigint, runs array<{RUN}>, strongest {RUN}")
    columns = [F.col("row")[c].alias(c) for c in other]
    return found.select(*columns, F.col("raw").cast("string").alias("text"), "n_words", "n_runs", "runs", "strongest")
