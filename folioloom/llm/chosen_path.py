"""MinHash near-duplicates by a chosen-path set similarity join.

A document is its set of distinct word shingles. Documents with equal sets form a class first, so copies
cost one row. For each class ``coordinates`` minwise tokens are kept, of which each independent tree
chooses one: classes that share it form a node. Nodes of up to ``leaf`` classes are compared exhaustively
by the low bytes of their tokens, 128 a class. Larger ones are dealt into such parts first, which joins most of a group
of near copies; then a node is settled if all its classes are joined, compared exhaustively in blocks if at most ``rest`` blocks are
outside its main component, and branches else: each child takes one more chosen token. ``branches`` children make pairs
below a similarity of 1 / ``branches`` die out. What is left in a node at ``depth`` is compared in blocks, whatever its size.

These comparisons only say which classes are joined by chains of pairs that pass the screen. Each such group is then
compared exactly, once, on full sets: whole up to ``block`` classes, else parts of it, which joins most of it, then blocks
of all pairs but those within the main component. So texts are read once, and a group's pairs are not met again in every tree.

A pair of similarity s meets in one tree with probability s and follows a branching of two children with at least 0.94 at 0.8,
so ``trees`` bounds what the trees may miss: 0.2**12 = 4e-9 at 0.8, 0.25**12 = 6e-8 if it has to branch without end in
each of them. The screen is the same in all trees: about 4.5 standard deviations below the limit, 83 of
128 equal ones. Ideal tokens of a pair at 0.8 fail that with probability 2.0e-5, which is the chance of a miss
that counts; such a link is lost unless others join the two. Every link is confirmed on full sets.

No group is collected: nodes are counted by partial aggregation, and a task holds parts or blocks of about
``leaf`` sketches or ``block`` texts (fewer long ones: ``volume`` shingles), whatever the size of the node.

Empty sets are linked with nothing, not even each other. Null ids count as larger than all
others; a component of such rows only has a null id. Rows with the same id are separate
documents. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm import words
from folioloom.llm.components import components, smallest_reachable
from folioloom.llm.frames import Rounds, narrowed
from folioloom.session import write_once


@dataclass(frozen=True)
class Settings:
    shingle: int = 4
    percent: int = 80
    coordinates: int = 128
    trees: int = 12
    branches: int = 2
    leaf: int = 2048
    rest: int = 4
    block: int = 512
    volume: int = 1 << 21
    depth: int = 6
    seed: int = 11

    def least(self, n: int, deviations: float) -> int:
        """Equal ones of ``n`` tokens that a pair at the limit has, less some standard deviations."""
        s = self.percent / 100
        return int(np.ceil(n * s - deviations * (n * s * (1 - s)) ** 0.5))


# --- sets and minwise tokens ---


def sets(p: words.Piece, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document of a piece, one after the other, and where each begins."""
    h = p.word_hashes(words.LOWER)
    n = np.diff(p.word_at)
    gram = words.grams(h, k)
    at = np.flatnonzero(words.inside(p.word_at, len(h), k))
    doc = np.searchsorted(p.word_at, at, side="right") - 1
    value = gram[at]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = [words.grams(h[p.word_at[i] : p.word_at[i + 1]], int(n[i]))[0] for i in short]
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(whole, np.uint64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    return value, np.searchsorted(doc, np.arange(len(p) + 1))


def tokens(value: np.ndarray, edges: np.ndarray, s: Settings) -> np.ndarray:
    """Minwise tokens (documents x coordinates); rows of empty sets are meaningless."""
    factors = np.random.default_rng(s.seed).integers(0, 1 << 63, s.coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(edges) - 1, s.coordinates), np.uint32)
    full = np.flatnonzero(edges[1:] > edges[:-1])
    if len(full):
        for j, f in enumerate(factors):
            out[full, j] = np.minimum.reduceat(((value * f) >> np.uint64(32)).astype(np.uint32), edges[full])
    return out


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, hash, n, s1, s2, mins): size, two sums that identify the set, and minwise tokens.

    Of the tokens all low bytes come first, so that a prefix serves as sketch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in words.pieces(batch.column(2)):
                value, edges = sets(p, s.shingle)
                n = np.diff(edges)
                total = [np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)]) for v in (value, words.mix(value))]
                s1, s2 = ((t[edges[1:]] - t[edges[:-1]]).view(np.int64) for t in total)
                mins = tokens(value, edges, s).view(np.uint8).reshape(len(p), s.coordinates, 4).transpose(0, 2, 1)
                own = batch.slice(p.first, len(p))
                cols = [own.column(0), own.column(1), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2),
                        pa.array([x.tobytes() for x in mins], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "hash", "n", "s1", "s2", "mins"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("raw"))
    return rows.mapInArrow(run, "doc_id bigint, hash bigint, n bigint, s1 bigint, s2 bigint, mins binary")


def matrix(column: pa.Array, s: Settings) -> np.ndarray:
    buf, at = words.column(column)
    planes = buf[at[0] : at[-1]].reshape(-1, 4, s.coordinates)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint32)[:, :, 0]


# --- nodes and groups ---


def nodes(rows: DataFrame, s: Settings, level: int) -> DataFrame:
    """(node, cid) below rows of (node, cid, mins): all trees at the root, chosen branches elsewhere."""
    width = s.trees if level == 0 else s.branches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            above, cid = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            mins = matrix(batch.column(2), s)
            for b in range(width):
                if level == 0:
                    chosen = np.full(len(cid), b, np.int64)
                else:  # by the node, so that all its classes choose alike; levels draw from tokens of their own, no token twice
                    free = s.coordinates - s.trees
                    step = 1 + words.mix(above + np.uint64(7919 + level)) % np.uint64(max(1, (free - 1) // max(1, s.branches - 1)))
                    draw = words.mix(above + np.uint64(level)) + np.uint64(b) * step
                    chosen = s.trees + (draw % np.uint64(free)).astype(np.int64)
                token = mins[np.arange(len(cid)), chosen].astype(np.uint64)
                node = words.mix(token ^ words.mix(above + chosen.astype(np.uint64) * np.uint64(2654435761) + np.uint64(level)))
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(cid)], ["node", "cid"])

    return rows.select("node", "cid", "mins").mapInArrow(run, "node bigint, cid bigint")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole groups of a stream sorted by its first two columns, and where each begins and the last one ends."""
    held: list[pa.RecordBatch] = []  # of one group, which may go on
    for batch in batches:
        if not len(batch):
            continue
        key = np.stack([batch.column(i).to_numpy() for i in (0, 1)])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if held and any(held[0].column(i)[0].as_py() != key[i, 0] for i in (0, 1)):
            cut = np.concatenate([[0], cut])
        if not len(cut):
            held.append(batch)
            continue
        done = pa.concat_batches([*held, batch.slice(0, int(cut[-1]))])
        before = len(done) - int(cut[-1])
        yield done, np.concatenate([[0], cut + before])
        held = [batch.slice(int(cut[-1]))]
    if held:
        done = pa.concat_batches(held)
        yield done, np.array([0, len(done)])


def spanned(rows: DataFrame, side: DataFrame, s: Settings, judge: Callable) -> DataFrame:
    """(a, b): a spanning star forest of the components that ``judge`` joins, within groups of (node, part, cid, comp).

    ``side`` is (cid, load), what classes are judged by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, edges in whole_groups(batches):
            comp = batch.column(2).to_numpy()
            i, j = judge(batch.column(3), edges, comp, s)
            if len(i):
                value, at = np.unique(comp, return_inverse=True)
                root = smallest_reachable(at[i], at[j], len(value))
                b = np.flatnonzero(root != np.arange(len(value)))
                yield pa.RecordBatch.from_arrays([pa.array(value[root[b]]), pa.array(value[b])], ["a", "b"])

    dealt = rows.join(side, "cid").select("node", "part", "comp", "load").repartition("node", "part")
    return dealt.sortWithinPartitions("node", "part").mapInArrow(run, "a bigint, b bigint")


def by_sketch(load: pa.Array, edges: np.ndarray, comp: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components that pass the screen, as positions."""
    buf, at = words.column(load)
    m = buf[at[0] : at[-1]].reshape(-1, s.coordinates)
    size = np.diff(edges)
    two = edges[:-1][size == 2]
    left, right = [two], [two + 1]
    quick = min(32, s.coordinates)
    for x, y in zip(edges[:-1][size > 2], edges[1:][size > 2], strict=True):
        some = np.zeros((y - x, y - x), np.uint8)
        for j in range(quick):
            some += m[x:y, j, None] == m[None, x:y, j]
        i, j = np.nonzero(np.triu(some >= s.least(quick, 7), 1))
        left.append(i + x)
        right.append(j + x)
    i, j = np.concatenate(left), np.concatenate(right)
    apart = comp[i] != comp[j]
    i, j = i[apart], j[apart]
    ok = np.zeros(len(i), bool)
    step = 1 << 15
    for k in range(0, len(i), step):
        ok[k : k + step] = (m[i[k : k + step]] == m[j[k : k + step]]).sum(axis=1) >= s.least(s.coordinates, 4.5)
    return i[ok], j[ok]


def by_set(load: pa.Array, edges: np.ndarray, comp: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components with 100 x intersection >= percent x union of their sets, as positions."""
    sets_of = each_set(load, s)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for x, y in zip(edges[:-1], edges[1:], strict=True):
        each = list(islice(sets_of, int(y - x)))
        if len(each) == 2:
            i, j = (np.array([k] if linked(*each, s) else [], np.int64) for k in (0, 1))
        else:
            i, j = links_of(each, comp[x:y], s)
        apart = comp[x + i] != comp[x + j]
        left.append(x + i[apart])
        right.append(x + j[apart])
    return np.concatenate(left), np.concatenate(right)


def each_set(raw: pa.Array, s: Settings) -> Iterator[np.ndarray]:
    for p in words.pieces(raw):
        value, edges = sets(p, s.shingle)
        yield from (value[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True))


def linked(x: np.ndarray, y: np.ndarray, s: Settings) -> bool:
    if 100 * min(len(x), len(y)) < s.percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= s.percent * (len(x) + len(y) - same)


def links_of(each: list[np.ndarray], comp: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """All links between different components of one group."""
    size = np.array([len(x) for x in each])
    owner = np.repeat(np.arange(len(each)), size)
    _, code = np.unique(np.concatenate(each), return_inverse=True)
    common = np.zeros((len(each), len(each)), np.float32)
    shared = np.bincount(code) > 1
    new = np.cumsum(shared) - 1
    keep = shared[code]
    code, owner = new[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    step = 4096
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, step):
        a, b = np.searchsorted(code, [first, first + step])
        grid = np.zeros((len(each), step), np.float32)
        grid[owner[a:b], code[a:b] - first] = 1
        common += grid @ grid.T
    common = common.astype(np.int64)  # counts are exact as float32, a hundred times them need not be
    ok = (100 * common >= s.percent * (size[:, None] + size[None, :] - common)) & (comp[:, None] != comp[None, :])
    return np.nonzero(np.triu(ok, 1))


# --- parts and blocks of large groups ---


def ceiling(weight: Column, most: int) -> Column:
    return F.ceil(weight / F.lit(most)).cast("int")


def shares(members: DataFrame, s: Settings) -> DataFrame:
    """(node, cid, comp, major, nm, nr) of nodes (node, cid, comp, w) with more than one component.

    The heaviest component of a node is its main one, and its classes are ``major``: nm and nr are the blocks of half a
    volume that they and the rest take.
    """
    per_comp = members.groupBy("node", "comp").agg(F.sum("w").alias("w"))
    main = per_comp.groupBy("node").agg(F.max(F.struct("w", "comp")).alias("main"), F.sum("w").alias("all")).filter("all > main.w")
    half = s.volume // 2
    main = main.select("node", F.col("main.comp").alias("main"), ceiling(F.col("main.w"), half).alias("nm"), ceiling(F.col("all") - F.col("main.w"), half).alias("nr"))
    return members.join(main, "node").select("node", "cid", "comp", (F.col("comp") == F.col("main")).alias("major"), "nm", "nr")


def in_blocks(part: DataFrame) -> DataFrame:
    """(node, part, cid, comp) of ``shares``: every pair of blocks, but not two of the main component.

    Rows go to blocks by hash, each pair of blocks is a group.
    """
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("major"), F.col("nm")).otherwise(F.col("nr"))).cast("int")
    rest = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("nr") - 1), lambda j: F.concat_ws("r", F.least(j, "own"), F.greatest(j, "own"))),
        F.transform(F.sequence(F.lit(0), F.col("nm") - 1), lambda j: F.concat_ws("m", "own", j)),
    )
    majors = F.transform(F.sequence(F.lit(0), F.col("nr") - 1), lambda j: F.concat_ws("m", j, "own"))
    dealt = part.withColumn("own", own).select("node", "cid", "comp", F.explode(F.when(F.col("major"), majors).otherwise(rest)).alias("pair"))
    return dealt.select("node", F.xxhash64("pair").alias("part"), "cid", "comp")


def in_parts(members: DataFrame, salt: int = 0) -> DataFrame:
    """(node, part, cid, comp) of (node, cid, comp, parts): classes dealt to the parts of their node by hash."""
    return members.select("node", F.pmod(F.xxhash64("cid", "node", F.lit(salt)), F.col("parts").cast("bigint")).alias("part"), "cid", "comp")


# --- the join ---


def classes_of(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Stored signatures, and one row per distinct set with a document that stands for it."""
    signed = write_once(signatures(docs, s), "near-signatures")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    grouped = signed.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min(first).alias("first"), F.first("mins").alias("mins"))
    rows = grouped.selectExpr("n", "s1", "s2", "first.doc_id as rep_id", "first.hash as rep_hash", "mins")
    return signed, write_once(rows.withColumn("cid", F.monotonically_increasing_id()), "near-classes")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, load) of classes (cid, rep_id, rep_hash), load being the text."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("load"))
    rows = narrowed(rows, "hash", wanted.select("rep_hash"))
    on = (rows["hash"] == wanted["rep_hash"]) & rows["doc_id"].eqNullSafe(wanted["rep_id"])
    return rows.join(wanted, on).select("cid", "load").dropDuplicates(["cid"])


def with_comp(rows: DataFrame, comps: DataFrame | None, key: str, name: str) -> DataFrame:
    if comps is None:
        return rows.withColumn(name, F.col(key))
    labels = comps.select(F.col("id").alias(key), F.col("comp").alias(name))
    return rows.join(labels, key, "left").withColumn(name, F.coalesce(name, key))


def hops(stars: DataFrame, n: int) -> DataFrame:
    """(id, comp) by following each class of star forests (a, b) to its smallest centre, n times.

    Classes with one comp are joined, but not all that are joined have one: it is for saving comparisons only.
    """
    step = write_once(stars.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("comp")), "near-hops")
    out = step
    for _ in range(n - 1):
        out = with_comp(out.withColumnRenamed("comp", "via"), step, "via", "comp").select("id", "comp")
    return out


def candidates(classes: DataFrame, s: Settings) -> DataFrame | None:
    """(id, comp) of classes joined by chains of pairs that meet in a node and pass the screen; None without any."""
    files = Rounds(classes.sparkSession)
    mins = classes.select("cid", "mins")
    rows = mins.withColumn("node", F.lit(0).cast("bigint"))
    weight = s.volume // s.leaf
    comps = edges = None
    for level in range(s.depth + 1):
        files.turn()
        sketches = mins.select("cid", F.substring("mins", 1, s.coordinates).alias("load"))
        placed = files.store(nodes(rows, s, level), "near-nodes")
        sizes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sizes = sizes.select("node", ceiling(F.col("size") * F.lit(weight), s.volume).alias("parts"))
        met = files.store(with_comp(placed.join(sizes, "node"), comps, "cid", "comp"), "near-met")
        new = write_once(spanned(in_parts(met), sketches, s, by_sketch), "near-edges")
        edges = new if edges is None else edges.union(new)
        large = met.filter("parts > 1").select("node", "cid", "comp", F.lit(weight).cast("bigint").alias("w"))
        if large.isEmpty():
            break
        if comps is None:
            comps = write_once(hops(new, 3), "near-components")
            large = with_comp(large.drop("comp"), comps, "cid", "comp")
            ids = large.select("cid").distinct()  # few, as a rule: later levels read these only
            mins = write_once(narrowed(mins, "cid", ids).join(ids, "cid"), "near-mins")
            sketches = mins.select("cid", F.substring("mins", 1, s.coordinates).alias("load"))
        left = files.store(shares(large, s), "near-open")
        last = F.lit(level == s.depth) | (F.col("nr") <= s.rest)
        now, later = left.filter(last), left.filter(~last)
        if not now.isEmpty():
            edges = edges.union(write_once(spanned(in_blocks(now), sketches, s, by_sketch), "near-edges"))
        if later.isEmpty():
            break
        rows = later.select("node", "cid").join(mins, "cid")
    files.turn()
    files.turn()
    return None if edges.isEmpty() else write_once(components(edges), "near-candidates")


def link(docs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame | None:
    """(id, comp) of linked classes; None without any candidates."""
    found = candidates(classes, s)
    if found is None:
        return None
    weight = F.greatest(F.lit(s.volume // s.block).cast("bigint"), F.col("n"))
    about = classes.select("cid", "rep_id", "rep_hash", weight.alias("w"))
    members = about.join(found.selectExpr("id as cid", "comp as node"), "cid")
    sizes = members.groupBy("node").agg(ceiling(F.sum("w"), s.volume).alias("parts"))
    members = write_once(members.join(sizes, "node").withColumn("comp", F.col("cid")), "near-members")
    texts = write_once(texts_of(docs, members.select("cid", "rep_id", "rep_hash")), "near-texts")
    # each class is in one part, so that the stars of all parts are components already
    first = write_once(spanned(in_parts(members), texts, s, by_set), "near-links")
    comps = first.selectExpr("b as id", "a as comp")
    large = members.filter("parts > 1").select("node", "cid", "w", "parts")
    if large.isEmpty():
        return comps
    # another deal joins what the parts have in common
    large = write_once(with_comp(large, comps, "cid", "comp"), "near-large")
    again = write_once(spanned(in_parts(large, 1), texts, s, by_set), "near-links")
    left = shares(with_comp(large.withColumnRenamed("comp", "first"), hops(again, 1), "first", "comp"), s)
    return write_once(components(first.union(again).union(spanned(in_blocks(left), texts, s, by_set))), "near-components")


def dedup(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, hash, component, n_shingles, component_id, kept), one row per row of ``docs``.

    ``hash`` is xxhash64 of the text; ``component`` tells components apart where ids repeat, null for empty sets.
    """
    signed, classes = classes_of(docs, s)
    comps = link(docs, classes, s)
    labelled = with_comp(classes.select("n", "s1", "s2", "cid", "rep_id"), comps, "cid", "component")
    low = labelled.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    known = labelled.join(low, "component").select("n", "s1", "s2", "component", "component_id")
    filled = signed.filter("n > 0").join(known, ["n", "s1", "s2"])
    filled = filled.select("doc_id", "hash", "component", "n", "component_id")
    none = F.lit(None).cast("bigint").alias("component")
    empty = signed.filter("n = 0").select("doc_id", "hash", none, "n", F.col("doc_id").alias("component_id"))
    return filled.union(empty).select(
        "doc_id", "hash", "component", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` with one row left of each component, the smallest id (nulls last), then text hash.

    Rows without shingles all stay.
    """
    judged = dedup(docs, s)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first")
    picked = judged.filter("component is not null").groupBy("component").agg(first)
    picked = picked.select(F.col("first.doc_id").alias("_id"), F.col("first.hash").alias("_hash"))
    empty = judged.filter("component is null").select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"))
    # rows travel packed, so that their column names meet no others
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.xxhash64("text").alias("_h"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash"))
    full = rows.join(picked, same).dropDuplicates(["_id", "_hash"])
    return full.select("_row.*").union(rows.join(empty.distinct(), same, "left_semi").select("_row.*"))
