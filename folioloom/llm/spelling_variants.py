"""Spelling variants: words one letter apart, by PartEnum signatures of their letter multisets.

A word is a binary vector over (letter, how manieth of it). One inserted, deleted or replaced letter changes at
most two places, so near words have Hamming distance two at most. The places are cut into ``parts`` first-level
partitions, one of which then differs in at most 2 / parts places, and each into ``cells`` second-level ones.
A signature is what a word has in one partition with that many cells left out: near words share one exactly.

Letters alone would put thousands of words of common syllables under one signature. So each is joined with half of
the word: of two words of g and at most g + 1 letters one letter apart, the first floor(g / 2) letters agree or the last
g - floor(g / 2) do. A word takes part with g as its length and as one less. This splits hot signatures
and loses no pair. Pairs with an equal key are verified by edit distance and then made distinct.

Null and empty texts give no words; a null doc_id counts as the empty text in the checksum. Repeated rows count
as often as they occur. Ties between forms go to the smallest word in code-point order. An empty table gives no rows.
Only distinct words are exchanged with their signatures, so a word that makes up a third of all texts is one row.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.session import write_once

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHORTEST, LEAST, DISTANCE = 7, 2, 2
#: A form is so many times as frequent.
RATIO = 10


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) of the corpus, for words of ``SHORTEST`` letters or more that occur ``LEAST`` times or more."""
    # shorter runs can give no such word
    found = F.regexp_extract_all("text", F.lit(r"[A-Za-zÀ-ÿ]{%d,}+" % SHORTEST), F.lit(0))
    runs = docs.select("doc_id", F.explode(found).alias("run"))
    plain = F.octet_length("run") == F.length("run")
    runs = runs.withColumn("run", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, UPPER.lower())))
    runs = runs.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary")))
    gone = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run"))
    return (
        runs.select(word.alias("word")).filter(F.length("word") >= SHORTEST)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def signatures(word: Column, parts: int, cells: int) -> Column:
    """PartEnum signatures of a word's letters, with the partition and the cells left out mixed in.

    What a cell holds is the exclusive or of the hashes of its places, since places are distinct and have no order.
    """
    zero = F.lit(0).cast("bigint")

    def places(letters: Column) -> Column:
        return F.transform(letters, lambda c, i: F.xxhash64(c, F.size(F.filter(F.slice(letters, F.lit(1), i + 1), lambda x: x == c))))

    def sums(of: Column) -> Column:
        def held(p: Column) -> Column:
            return F.aggregate(of, zero, lambda x, d: F.when(F.pmod(d, F.lit(parts * cells)) == p, x.bitwiseXOR(d)).otherwise(x))

        return F.transform(F.sequence(F.lit(0), F.lit(parts * cells - 1)), held)

    def each(sums: Column) -> Column:
        out = []
        for part in range(parts):
            for gone in combinations(range(cells), DISTANCE // parts):
                sig = zero
                for cell in sorted(set(range(cells)) - set(gone)):
                    sig = sig.bitwiseXOR(sums[part * cells + cell])
                out.append(F.xxhash64(sig, F.lit(part), F.lit(str(gone))))
        return F.array(*out)

    return let(F.split(word, "(?!^)"), lambda letters: let(places(letters), lambda of: let(sums(of), each)))


def near_pairs(words: DataFrame, parts: int = 3, cells: int = 1) -> DataFrame:
    """(a, na, b, nb): pairs of words one letter apart, each once."""
    spread = words.sparkSession.conf.get("spark.sql.shuffle.partitions")
    signed = words.repartition(int(spread)).withColumn("sigs", signatures(F.col("word"), parts, cells))
    rows = write_once(signed.withColumn("size", F.length("word")), "variant-signatures")
    number = parts * len(list(combinations(range(cells), DISTANCE // parts)))

    def keyed(shorter: int) -> DataFrame:
        g = F.col("size") - shorter
        half = F.floor(g / 2).cast("int")
        first, last = F.substring("word", F.lit(1), half), F.substring("word", F.col("size") - (g - half) + 1, g - half)
        ends = rows.filter(g >= SHORTEST).withColumns({"e0": F.xxhash64(F.lit(0), g, first), "e1": F.xxhash64(F.lit(1), g, last)})
        keys = F.array(*(F.xxhash64(e, F.col("sigs")[i]) for e in ("e0", "e1") for i in range(number)))
        return ends.select("word", "n", "size", F.explode(keys).alias("key"))

    own = keyed(0)
    # same length: each pair once; otherwise the longer word comes as one of g + 1 letters
    left = own.select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("size").alias("sa"), "key")
    right = own.union(keyed(1)).select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("size").alias("sb"), "key")
    pairs = left.join(right, "key").filter((F.col("sa") < F.col("sb")) | ((F.col("sa") == F.col("sb")) & (F.col("a") < F.col("b"))))
    return pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "na", "b", "nb").distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last one. Each is ``RATIO`` times as frequent as the one before, so with
    64-bit counts a chain has fewer than 32 steps, which five doublings cover; none is made without need."""
    forms = write_once(forms.select("word", F.col("form").alias("root")), "variant-roots")
    for _ in range(5):
        after = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if forms.join(after, "root", "left_semi").isEmpty():
            break
        forms = write_once(forms.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variant-roots")
    return forms


def grouped(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the corpus that is counted."""
    words = write_once(counted(docs), "variant-words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("form"), F.col("nb").alias("form_n")).union(pairs.select("b", "nb", "a", "na"))
    first = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("first"))
    near = write_once(near.select("word", "n_near", F.col("first.form").alias("form"), (-F.col("first.less")).alias("form_n")), "variant-near")
    known = words.join(near, "word", "left")
    has = F.col("form_n") >= RATIO * F.col("n")
    known = known.select(
        "word", F.when(has, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(has, F.col("form_n")).alias("form_n"),
    )
    roots = roots_of(known.filter("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Near words share a place and what is left without it: both (replaced) or one whole (inserted, deleted).
#: The checksum goes byte by byte; its table follows from the polynomial, and letters above A-Z take two bytes.
SQL = r"""
with recursive bits as (
  select i as byte, i as c, 0 as step from range(256) t(i)
  union all
  select byte, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from bits where step < 8
), crc_table as (select list(c order by byte) as tab from bits where step = 8),
found as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run
  from documents
), runs as (select doc_id, run, count(*) as times from found where length(run) >= 7 group by all),
bytes as (
  select *, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
    lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [(192 + (unicode(c) >> 6))::bigint, (128 + (unicode(c) & 63))::bigint] end)) as bs
  from runs
), hashed as (
  select run, times, xor(list_reduce(bs, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) as h
  from bytes, crc_table
), words as (
  select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(times)::bigint as n
  from hashed group by 1 having length(word) >= 7 and sum(times) >= 2
), cut as (select word, n, i, left(word, i::int) || substr(word, i::int + 2) as rest from words, range(length(word)) t(i)),
near as (
  select distinct a.word, a.n, b.word as form, b.n as form_n from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select c.word, c.n, w.word, w.n from cut c join words w on c.rest = w.word
  union select w.word, w.n, c.word, c.n from cut c join words w on c.rest = w.word
), best as (
  select word, count(*) as n_near, first(form order by form_n desc, form) as form, max(form_n) as form_n from near group by word
), known as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 10 * w.n then form end as form, case when form_n >= 10 * w.n then form_n end as form_n
  from words w left join best using (word)
), chain as (
  select word, word as at, form as next from known
  union all
  select c.word, k.word, k.form from chain c join known k on k.word = c.next
)
select k.word, k.form, c.at as root, k.n, k.n_near, k.form_n from known k join chain c on c.word = k.word and c.next is null
"""
