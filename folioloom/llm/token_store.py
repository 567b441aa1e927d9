"""Token ids in frequency-ranked, byte-aligned variable-length blocks.

A block holds the ids of consecutive documents. Ids are replaced by their rank of frequency in the
block, so frequent ids take one byte. The length of every rank (1 to 4 bytes) sits in two bits of
a separate stream of control bytes, four ranks each. Decoding looks the four lengths of each control
byte up in a table and gathers the bytes with numpy. Blocks carry their own rank table, are bounded in
size and can be read alone.

Image of a block, little-endian: ``FRV1``, then as uint32 the numbers of documents, ids, ranks and
data bytes; ids by rank (uint32); ids per document (uint32); control bytes; data bytes. Images
are rows of a Parquet table with (part, seq), because Spark then writes and reads them in any store.

Order is by document id, nulls last, then text hash: one range exchange of the texts. Null and empty
texts have only the end id. Repeated rows are stored each. An empty input gives an empty table.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.llm import words

MAGIC = b"FRV1"
BLOCK_IDS = 1 << 20
#: About 100 bytes each. Twice as many gain little, since most words that are not found are met once.
CACHED_WORDS = 1 << 20
#: Bytes kept for each word of a full table, on average.
WORD_BYTES = 64
#: A part above this, which is one word mostly, has its words encoded without the table.
MOST_AT_ONCE = 1 << 20
BLOCKS = "part int, seq int, doc_ids array<bigint>, n_ids bigint, image binary"
#: Lengths of the four ranks of every control byte.
LENGTHS = np.array([[1 + (c >> 2 * i & 3) for i in range(4)] for c in range(256)], np.int64)


# --- the block format ---


def pack(ids: np.ndarray, per_document: np.ndarray) -> bytes:
    """Image of one block."""
    count = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    distinct = np.flatnonzero(count)
    table = distinct[np.lexsort((distinct, -count[distinct]))]
    rank_of = np.zeros(len(count), "<u4")
    rank_of[table] = np.arange(len(table))
    ranks = rank_of[ids]
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    two_bits = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    two_bits[: len(ids)] = length - 1
    control = (two_bits.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    head = np.array([len(per_document), len(ids), len(distinct), len(data)], "<u4")
    table = table.astype("<u4")
    return b"".join([MAGIC, *(x.tobytes() for x in (head, table, np.asarray(per_document).astype("<u4"), control, data))])


def unpack(image: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids per document) of a block."""
    if image[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n_docs, n_ids, n_ranks, n_data = np.frombuffer(image, "<u4", 4, 4).astype(int)
    at = 20
    table = np.frombuffer(image, "<u4", n_ranks, at)
    per_document = np.frombuffer(image, "<u4", n_docs, at := at + 4 * n_ranks).astype(np.int64)
    control = np.frombuffer(image, np.uint8, -(-n_ids // 4), at := at + 4 * n_docs)
    data = np.zeros(n_data + 3, np.uint8)
    data[:n_data] = np.frombuffer(image, np.uint8, n_data, at + len(control))
    length = LENGTHS[control].ravel()[:n_ids]
    first = np.cumsum(length) - length
    ranks = data[first].astype(np.uint32)
    for i in (1, 2, 3):
        more = np.flatnonzero(length > i)
        ranks[more] |= data[first[more] + i].astype(np.uint32) << np.uint32(8 * i)
    return table[ranks], per_document


# --- encoding texts ---


def word_local(config: dict) -> bool:
    """Whether ids of a text are the ids of its words between ASCII white space, one after the other.

    True for a word-end vocabulary whose pieces never hold white space: it is dropped by the split,
    nothing is put before a word, and no setting looks across pieces.
    """
    added = config.get("added_tokens") or []
    split, *rest = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    kinds = [x["type"] for x in (config.get("normalizer") or {}).get("normalizers") or []]
    return (
        set(kinds) <= {"NFC", "Replace", "Lowercase"}
        and split.get("type") == "Split"
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and r"[\p{L}]+|" in split.get("pattern", {}).get("Regex", "")
        and r"[^\s\p{L}\p{N}]+" in split.get("pattern", {}).get("Regex", "")
        and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in rest)
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or " " in x["content"] for x in added)
        and config.get("post_processor") is None
    )


#: Letters whose case and composition are settled one by one: ASCII, and those of \xc3.
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
LETTER, TAIL, BLANK, OTHER = 1, 2, 3, 4
#: Kind of every byte, and of what follows a \xc3.
KIND = bytes(
    LETTER if re.match(rb"[A-Za-z]", x) else TAIL if re.match(rb"[!-/:-@\[-`{-~]", x) else BLANK if x.isspace() else OTHER
    for x in (bytes([i]) for i in range(256))
)
AFTER_C3 = np.array([LETTER if LETTERS.fullmatch(b"\xc3" + bytes([x])) else OTHER for x in range(256)], np.uint8)
LOWER = bytes(range(256)).lower()


def settle(text: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes with a space between letters and tail in each word that is letters and a tail of ASCII punctuation,
    those letters in lower case if asked for; and the old places before which a space was put. Other words stay.
    """
    buf, kind = np.frombuffer(text, np.uint8), np.frombuffer(bytearray(text.translate(KIND)), np.uint8)
    second = np.flatnonzero(buf[:-1] == 0xC3) + 1
    kind[second] = kind[second - 1] = AFTER_C3[buf[second]]
    ends = (kind[:-1] == LETTER) & (kind[1:] == TAIL)
    new = buf
    if lower:
        new = np.frombuffer(bytearray(text.translate(LOWER)), np.uint8)
        new[second[(kind[second] == LETTER) & (buf[second] < 0x9F)]] += 32
    out = kind == OTHER
    out[1:] |= (kind[:-1] == TAIL) & (kind[1:] == LETTER)
    if out.any():
        word = np.cumsum(kind == BLANK, dtype=np.int32)
        stays = np.zeros(word[-1] + 1, bool)
        stays[word[out]] = True
        stays = stays[word]
        ends &= ~stays[1:]
        new = np.where(stays, buf, new)
    at = np.flatnonzero(ends) + 1
    return np.insert(new, at, 32), at


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of stretches, one stretch after the other."""
    total = np.cumsum(lengths)
    return np.repeat(starts - total + lengths, lengths) + np.arange(total[-1] if len(total) else 0)


class WordTable:
    """Words and their ids in arrays, with open addressing by hash; a word is found by all its bytes."""

    def __init__(self):
        self.n = 0
        self.slots = np.full(1 << 12, -1, np.int32)
        self.hash = np.zeros(1, np.uint64)
        #: End of each word in ``raw`` and of its ids in ``ids``, after a 0.
        self.raw_at, self.ids_at = np.zeros((2, 2), np.int64)
        self.raw, self.ids = np.zeros(1, np.uint8), np.zeros(1, "<u4")

    def __len__(self) -> int:
        return self.n

    def n_bytes(self) -> int:
        return int(self.raw_at[self.n] + 4 * self.ids_at[self.n])

    def find(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of each word, -1 if it is not there."""
        found, left, mask = np.full(len(h), -1, np.int64), np.arange(len(h)), len(self.slots) - 1
        at = (h & np.uint64(mask)).astype(np.int64)
        while len(left):
            e = self.slots[at]
            go_on = e >= 0
            i = np.flatnonzero(go_on & (self.hash[e] == h[left]))
            first = self.raw_at[e[i]]
            as_long = self.raw_at[e[i] + 1] - first == lengths[left[i]]
            i, first = i[as_long], first[as_long]
            if len(i):
                n = lengths[left[i]]
                differ = buf[spread(starts[left[i]], n)] != self.raw[spread(first, n)]
                if differ.any():
                    i = i[np.add.reduceat(differ, np.cumsum(n) - n, dtype=np.int64) == 0]
            found[left[i]] = e[i]
            go_on[i] = False
            left, at = left[go_on], (at[go_on] + 1) & mask
        return found

    def add(self, h: np.ndarray, raw: list[bytes], ids: list[bytes]) -> None:
        """Words that are not there yet, each once."""
        before, self.n = self.n, self.n + len(raw)
        for name, values, size in (("raw", raw, 1), ("ids", ids, 4)):
            ends = np.cumsum([len(x) // size for x in values], dtype=np.int64) + getattr(self, f"{name}_at")[before]
            self._put(f"{name}_at", before + 1, ends)
            data = np.frombuffer(b"".join(values), getattr(self, name).dtype)
            self._put(name, int(ends[-1]) - len(data), data)
        self._put("hash", before, h)
        if 4 * self.n > len(self.slots):
            self.slots = np.full(1 << (8 * self.n).bit_length(), -1, np.int32)
            before = 0
        e, mask = np.arange(before, self.n, dtype=np.int32), len(self.slots) - 1
        at = (self.hash[before : self.n] & np.uint64(mask)).astype(np.int64)
        while len(e):
            free = self.slots[at] < 0
            self.slots[at[free]] = e[free]
            left = self.slots[at] != e
            e, at = e[left], (at[left] + 1) & mask

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        array, n = getattr(self, name), at + len(values)
        if n > len(array):
            longer = np.zeros(max(n, 3 * len(array) // 2), array.dtype)
            longer[: len(array)] = array
            setattr(self, name, array := longer)
        array[at:n] = values


def letters_are_pieces(config: dict) -> bool:
    """Whether a run of letters at the start of a word is one piece that goes to the model as it is.

    So it is, byte by byte, if a byte-level vocabulary has no setting that changes pieces and no added token
    lies inside letters followed by punctuation.
    """
    model, split = config.get("model") or {}, (config.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        model.get("type") == "BPE"
        and not model.get("dropout")
        and [x["type"] for x in split] == ["Split", "ByteLevel"]
        and all(re.match(r"[^\w\s].*\w", x["content"]) for x in config.get("added_tokens") or [])
    )


class WordIds:
    """Ids of texts as the ids of their words, each word encoded once and then looked up.

    The table has two generations of bounded size: when the younger is full it becomes the older, whose words
    return as they are met again, and the older one before goes.
    """

    def __init__(self, tokenizer, config: dict, most_words: int = CACHED_WORDS):
        self.tokenizer, self.most = tokenizer, most_words // 2
        self.lower = "Lowercase" in json.dumps(config.get("normalizer"))
        self.mark = "~"
        self.marked = self._ids(self.mark)
        self.model = tokenizer.model if letters_are_pieces(config) else None
        if self.model:
            from tokenizers.pre_tokenizers import ByteLevel

            level = ByteLevel(add_prefix_space=False, use_regex=False)
            self.bytes_of = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.young, self.old = WordTable(), WordTable()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        return [b"".join(x) for x in self.runs(texts)]

    def runs(self, texts: list[bytes], most: int = 1 << 18) -> Iterator[list[bytes]]:
        """Per text its ids in runs; texts meet the table together up to ``most`` bytes, longer ones in parts."""
        held, size = [], 0
        for text in texts:
            if size + len(text) > most and held:
                yield from ([x] for x in self._look_up(held))
                held, size = [], 0
            if len(text) <= most:
                held.append(text)
                size += len(text)
            else:
                yield [self._look_up([part])[0] if len(part) <= MOST_AT_ONCE else self._apart(part) for part in parts(text, most)]
        if held:
            yield from ([x] for x in self._look_up(held))

    def _look_up(self, texts: list[bytes]) -> list[bytes]:
        at = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])])
        joined = b" ".join([*texts, b""])
        if self.model:
            buf, put = settle(joined, self.lower)
            at += np.searchsorted(put, at)
        else:
            buf = np.frombuffer(joined, np.uint8)
        piece = words.Piece(buf, at, 0, len(texts), words.SPACE)
        h, starts, lengths = piece.word_hashes(), piece.starts, piece.ends - piece.starts
        e = self.young.find(h, buf, starts, lengths)
        new, number, first = self._missing(e, piece)
        if len(self.young) + len(first) > self.most or self.young.n_bytes() > WORD_BYTES * self.most:
            self.old, self.young = self.young, WordTable()
            e[:] = -1
            new, number, first = self._missing(e, piece)
        if len(first):
            raw = [buf[a:b].tobytes() for a, b in zip(starts[first].tolist(), piece.ends[first].tolist(), strict=True)]
            ids = self._recall(self.old.find(h[first], buf, starts[first], lengths[first]), raw)
            e[new] = len(self.young) + number
            self.young.add(h[first], raw, ids)
        n = self.young.ids_at[e + 1] - self.young.ids_at[e]
        raw = self.young.ids[spread(self.young.ids_at[e], n)].tobytes()
        cut = (4 * np.concatenate([[0], np.cumsum(n)])[piece.word_at]).tolist()
        return [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def _missing(self, e: np.ndarray, piece: words.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words without a number: where they are, which different word each is, and where each of these comes first."""
        new, seen, first = np.flatnonzero(e < 0), {}, []
        number = np.zeros(len(new), np.int64)
        raw = piece.buf.tobytes() if len(new) else b""
        for i, j, a, b in zip(range(len(new)), new.tolist(), piece.starts[new].tolist(), piece.ends[new].tolist(), strict=True):
            number[i] = k = seen.setdefault(raw[a:b], len(first))
            if k == len(first):
                first.append(j)
        return new, number, np.array(first, np.int64)

    def _recall(self, e: np.ndarray, raw: list[bytes]) -> list[bytes]:
        """Ids of words by their numbers in the older table, or else encoded."""
        out, others, old = [b""] * len(raw), [], self.old
        for i, k in enumerate(e.tolist()):
            if k >= 0:
                out[i] = old.ids[old.ids_at[k] : old.ids_at[k + 1]].tobytes()
            elif self.model and LETTERS.fullmatch(raw[i]):
                out[i] = self._piece(raw[i].decode())
            else:
                others.append(i)
        if others:
            for i, ids in zip(others, self._encode([raw[i] for i in others]), strict=True):
                out[i] = ids
        return out

    def _piece(self, letters: str) -> bytes:
        if self.lower:
            letters = letters.lower()
        found = [t.id for t in self.model.tokenize(letters if letters.isascii() else letters.translate(self.bytes_of))]
        return struct.pack(f"<{len(found)}I", *found)

    def _encode(self, raw: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "replace") for w in raw]
        plain = [i for i, t in enumerate(texts) if self.mark not in t] if len(self.marked) == 1 else []
        out = [b""] * len(raw)
        if plain:
            # one call for all: a mark after each word, which no word holds, tells their ids apart
            joined = f" {self.mark} ".join([texts[i] for i in plain] + [""])
            ids = np.array(self._ids(joined), "<u4")
            whole, first = ids.tobytes(), 0
            for i, end in zip(plain, (4 * np.flatnonzero(ids == self.marked[0])).tolist(), strict=True):
                out[i] = whole[first:end]
                first = end + 4
        for i in set(range(len(raw))).difference(plain):
            out[i] = np.array(self._ids(texts[i]), "<u4").tobytes()
        return out

    def _apart(self, text: bytes) -> bytes:
        """Ids of a text of long words, not kept."""
        found = text.split()
        ids = {w: self._encode([w])[0] for w in set(found)}
        return b"".join(map(ids.__getitem__, found))


def parts(text: bytes, most: int) -> Iterator[bytes]:
    """A text in parts of about ``most`` bytes that end where a word ends; a longer word is not cut."""
    first, n = 0, len(text)
    space = re.compile(rb"[\x20\x09-\x0d]")
    while first < n:
        found = space.search(text, first + most)
        last = found.end() if found else n
        yield text[first:last]
        first = last


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """From UTF-8 texts to their little-endian uint32 ids, without the end id; kept for the worker's later tasks.

    With a word-local vocabulary words are looked up (``WordIds``). Others get whole texts.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    if word_local(config):
        return WordIds(tokenizer, config)
    return lambda texts: [
        np.array(tokenizer.encode(x.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
        for x in texts
    ]


def vocabulary_path(name: str) -> str:
    """Place of a vocabulary file on this machine; a bare name is one of the installed public files."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


# --- tables ---


def write(docs: DataFrame, path: str, vocabulary: str = "word_bpe_49k.json", end_id: int = 1,
          block_ids: int = BLOCK_IDS) -> None:
    """Encode ``text`` of every row and store blocks in ascending order of ``doc_id``."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("_hash")]
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash"), F.col("text").cast("binary").alias("_raw"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "_raw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary_path(vocabulary)), np.array([end_id], "<u4").tobytes()
        part, seq, held = TaskContext.get().partitionId(), 0, []
        size = 0
        for batch in batches:
            for few in slices(batch, 1 << 22):
                texts = [x or b"" for x in few.column(1).to_pylist()]
                for doc_id, ids in zip(few.column(0).to_pylist(), encode(texts), strict=True):
                    held.append((doc_id, ids + end))
                    size += len(ids) // 4 + 1
                    if size >= block_ids:
                        yield block(part, seq, held)
                        held, size, seq = [], 0, seq + 1
        if held:
            yield block(part, seq, held)

    rows.mapInArrow(run, BLOCKS).write.parquet(path)


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``most`` bytes of text, or one row."""
    n = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    first = 0
    while first < len(n):
        before = n[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(n, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def block(part: int, seq: int, held: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
    image = pack(ids, np.array([len(x) // 4 for _, x in held]))
    values = [[part], [seq], [[d for d, _ in held]], [len(ids)], [image]]
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["part", "seq", "doc_ids", "n_ids", "image"]
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def digest(blocks: DataFrame) -> DataFrame:
    """Per document, from the images: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, doc_ids, image in zip(*batch.columns, strict=True):
                ids, n = unpack(image.as_py())
                at = np.concatenate([[0], np.cumsum(n)])
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                same = [pa.array(np.full(len(n), x.as_py(), np.int32)) for x in (part, seq)]
                columns = [*same, doc_ids.values, *(pa.array(x, pa.int64()) for x in (at[:-1], n, crc))]
                yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    fields = "part int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    docs = blocks.select("part", "seq", "doc_ids", "image").mapInArrow(run, fields)
    return docs.join(starts(blocks), ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def starts(blocks: DataFrame) -> DataFrame:
    """Ids before each block: before its part (one row per part meets) and before it within the part."""
    size = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = size.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_of_part"))
    earlier = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    within = blocks.select("part", "seq", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("earlier"))
    return within.join(parts, "part").select("part", "seq", (F.col("first_of_part") + F.col("earlier")).alias("first"))
