"""Document table and batch search over whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioloom.session import write_once

# The usual BM25 constants.
K1, B = 1.2, 0.75
TOP_K = 5

WORD_BREAK = r"[^\p{L}\p{N}]+"


def document_table(files: DataFrame, url_prefix: str = "") -> DataFrame:
    """Search attributes from the path: the ticker is the file stem before the first dot."""
    title = F.regexp_extract("relative_path", "[^/]+$", 0)
    return files.select(
        "relative_path",
        F.upper(F.split_part(title, F.lit("."), F.lit(1))).alias("ticker"),
        title.alias("title"),
        F.concat(F.lit(url_prefix), F.col("relative_path")).alias("file_url"),
        "content",
    )


def corpus_listing(documents: DataFrame) -> DataFrame:
    return documents.select("relative_path", "ticker", "title").orderBy("relative_path")


def corpus_count(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count(F.lit(1)).alias("parsed_doc_count"))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def _runs(sorted_words: str) -> Column:
    """(term, tf) of a sorted word array: where each run starts, and how far it is to the next."""
    return F.expr(
        f"""transform(_starts, (s, j) -> struct(
            {sorted_words}[s] as term,
            cast(coalesce(get(_starts, j + 1), size({sorted_words})) - s as bigint) as tf))"""
    )


def term_index(documents: DataFrame, key: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """(key, doc_len, term, tf): the index the search reads.

    Words are counted inside each row, by sorting them and measuring the runs, so building the
    index moves no text and no words between tasks, and the rows of a document stay together:
    what is later summed per document combines before it is exchanged.

    Every document also has one row with an empty term, which no text can hold, so the number
    and length of documents come from the same pass over the texts. With ``vocabulary`` (column
    ``term``) other terms are left out; they cannot score.
    """
    spelled = documents.select(key, F.sort_array(words(F.coalesce("content", F.lit("")))).alias("_words"))
    starts = "filter(transform(_words, (w, i) -> if(i > 0 and w = _words[i - 1], -1, i)), i -> i >= 0)"
    runs = spelled.withColumn("_starts", F.expr(starts)).select(
        key, F.size("_words").alias("doc_len"), _runs("_words").alias("_runs")
    )
    whole = F.expr("array(struct('' as term, 1L as tf))")
    terms = runs.select(key, "doc_len", F.inline(F.concat("_runs", whole)))
    if vocabulary is None:
        return terms
    # the empty term, one row per document, would be one hot key: it gets a key of its own per document
    spread = F.when(F.col("term") == "", F.concat(F.lit(" "), F.col(key).cast("string"))).otherwise(F.col("term"))
    known = vocabulary.select(F.col("term").alias("_known"))
    met = terms.join(known, spread == F.col("_known"), "left").filter("term = '' or _known is not null")
    return met.select(key, "doc_len", "term", "tf")


def query_terms(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", F.explode(F.array_distinct(words(F.col("query_text")))).alias("term"))


def _top(scored: DataFrame, key: str, k: int) -> DataFrame:
    """Best k per query. Scores are rounded first: a sum of doubles depends on its order in the
    last digits, and a rank must not. The per-query limit is applied before the exchange too."""
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(key))
    return (
        scored.withColumn("score", F.round("score", 6))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
    )


def score_terms(index: DataFrame, asked: DataFrame, key: str, k: int = TOP_K) -> DataFrame:
    """BM25 of indexed documents for (query_id, term) rows; the k best per query.

    Term rows are dealt by document once, so that a document's score for a query is complete inside one task: no
    (query, document) pair is exchanged, and only each task's k best per query travel to the final rank.
    """
    lengths = index.filter("term = ''").agg(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("avg_len"))
    n, avg_len = lengths.select("n").scalar(), lengths.select("avg_len").scalar()
    real = index.filter("term <> ''")
    df = F.col("df")
    weights = (
        real.join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .select("term", F.log(1 + (n - df + 0.5) / (df + 0.5)).alias("idf"))
    )
    tf = F.col("tf")
    norm = tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("doc_len") / avg_len))
    # stored, so that the optimiser knows its size: it is the side to broadcast while small, and
    # never the index, whose terms would then all pass through the few tasks of the queries
    weighted = write_once(asked.join(weights, "term"), "weights")
    partitions = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = real.repartition(partitions, key).join(weighted, "term")
    scored = hits.groupBy("query_id", key).agg(F.sum(F.col("idf") * norm).alias("score"))
    return _top(scored, key, k)


def search(
    documents: DataFrame, queries: DataFrame, key: str = "relative_path", k: int = TOP_K, where: Column | None = None
) -> DataFrame:
    """Top k documents per query (query_id, query_text) by lexical relevance over whole texts.

    ``where`` keeps to documents with given attributes (ticker, title, ...); the corpus is then these documents.
    """
    asked = query_terms(queries)
    vocabulary = asked.select("term").distinct()
    scope = documents if where is None else documents.filter(where)
    # words cost far more time than bytes: one unsplittable file must not be one task
    spread = scope.repartition(int(scope.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    index = write_once(term_index(spread, key, vocabulary), "terms")
    return score_terms(index, asked, key, k)


def vector_search(vectors: DataFrame, queries: DataFrame, k: int = TOP_K, batch_bytes: int = 16 << 20) -> DataFrame:
    """Top k rows of ``vectors`` (vec_id, embedding) per query (query_id, embedding) by cosine.

    Queries are numbered once and sent to the vectors in batches of about ``batch_bytes``, so what is sent is bounded
    whatever their number. A task multiplies its vectors with a batch by matrix and keeps the
    k best per query, ties included; only those rows are exchanged for the final rank.
    Vectors without length have no cosine and are no result.
    """
    asked = write_once(queries.select("query_id", F.col("embedding").cast("array<double>").alias("q")), "queries")
    n, dims = asked.agg(F.count(F.lit(1)), F.max(F.size("q"))).first()
    batches = max(1, -(-n * max(1, dims or 1) * 8 // batch_bytes))
    part = F.pmod(F.xxhash64("query_id"), F.lit(batches))
    kind = dict(asked.dtypes)["query_id"], dict(vectors.dtypes)["vec_id"]
    fields = f"query_id {kind[0]}, vec_id {kind[1]}, score double"
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    scored = None
    for i in range(batches):
        held = asked.filter(part == i).toArrow()
        best = rows.mapInArrow(_nearest(held.column("query_id"), _unit(held.column("q"))[0], k), fields)
        scored = best if scored is None else scored.unionByName(best)
    return _top(scored, "vec_id", k)


def _unit(lists) -> tuple[np.ndarray, np.ndarray]:
    """Rows of unit length, and which of them have one."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if not len(lists):
        return np.zeros((0, 0)), np.zeros(0, bool)
    flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    length = np.sqrt((flat * flat).sum(axis=1))
    return flat / np.where(length > 0, length, 1)[:, None], length > 0


def _nearest(ids: pa.ChunkedArray, unit: np.ndarray, k: int):
    """Task body: the best ``k`` and everything within rounding of the last of them, per query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        for batch in batches:
            found, ok = _unit(batch.column(1))
            if not ok.any() or not len(unit):
                continue
            score = unit @ found.T
            score[:, ~ok] = -np.inf
            least = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(unit), -np.inf)
            query, at = np.nonzero((score >= least[:, None] - 2e-6) & np.isfinite(score))
            kept.append((query, batch.column(0).take(pa.array(at)), score[query, at]))
        for query, vec, score in kept:
            columns = [ids.take(pa.array(query)), vec, pa.array(score)]
            yield pa.RecordBatch.from_arrays([_plain(c) for c in columns], ["query_id", "vec_id", "score"])

    return run


def _plain(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
