"""Term counts, vocabulary and TF-IDF weights.

Fitting reads the text three times. The first pass counts terms by their 64-bit
hashes: the occurrences and first occurrences of a hash are told apart inside
the row, so the text itself is never shuffled, only one row of numbers per task
and hash. The second finds the terms behind the most frequent hashes; should
two terms share one, terms are counted by their text instead. The third hashes
the text to tasks by document, looks the terms up in the vocabulary (whose size
is an argument, so it is broadcast) and counts, weighs and normalises within
the task. Keeping the term counts of all documents between the passes would cost
more than reading the text again: with two-word terms they are many times
larger than the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.functions.common import let
from lakeloom.functions.text import terms, tokens
from lakeloom.operators.relational import near_top_rows, top_n_pruned
from lakeloom.session import materialise

BROADCAST_TERMS = 1_000_000
# Input up to this size may be one file that cannot be cut; more than that Spark deals out by itself.
SMALL_INPUT = 256_000_000
# Stored input whose terms one task counts, and the size from which an estimate says that nothing is known.
TASK_INPUT, UNKNOWN_INPUT = 8_000_000, 10**15


def _input_size(docs: DataFrame) -> int:
    """Bytes of the tables that are read, summed: the estimate for a join would be the product of its sides."""
    leaves = docs._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def _spread(docs: DataFrame) -> DataFrame:
    """Spread the rows of a small input over all cores. A larger one is never shuffled: its scan has tasks enough."""
    return docs.repartition(docs.sparkSession.sparkContext.defaultParallelism) if _input_size(docs) <= SMALL_INPUT else docs


def _counting_tasks(docs: DataFrame) -> int | None:
    """Tasks that the texts are dealt to, so that a task's counts do not grow with the input; None: as Spark finds."""
    size = _input_size(docs)
    tasks = -(-size // TASK_INPUT)
    return tasks if docs.sparkSession.sparkContext.defaultParallelism < tasks and size < UNKNOWN_INPUT else None


def term_statistics(docs: DataFrame, text: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """(term, df, cf): documents with the term and its occurrences in all of them."""
    def marked(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.struct(
            w.alias("term"), F.when((i == 0) | (F.get(words, i - 1) != w), 1).otherwise(0).alias("first")))

    listed = let(F.sort_array(terms(text, stop_words)), marked)
    return (_spread(docs.select(text)).select(F.explode(listed).alias("t"))
            .groupBy("t.term").agg(F.sum("t.first").alias("df"), F.count("*").alias("cf")))


def _hash(*words: Column) -> Column:
    """The number that stands for a term of one or two words while terms are counted."""
    return F.xxhash64(*words)


def _hash_statistics(docs: DataFrame, text: str, stop_words: Sequence[str]) -> DataFrame:
    """(h, df, cf): the counts of ``term_statistics`` by the hash of the term."""
    def hashes(words: Column) -> Column:
        rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
        return F.concat(F.transform(words, lambda w: _hash(w)),
                        F.transform(rest, lambda w, i: _hash(F.get(words, i), w)))

    # Outside of the lambda numbers are sorted and paired with their neighbours by generated code.
    listed = _spread(docs.select(text)).select(F.sort_array(let(tokens(text, stop_words), hashes)).alias("h"))
    before = F.concat(F.array(F.lit(None).cast("bigint")), "h").alias("before")
    found = listed.select(F.explode(F.arrays_zip("h", before)).alias("e")).select("e.h", "e.before").where("h IS NOT NULL")
    first = F.when(F.col("h").eqNullSafe(F.col("before")), 0).otherwise(1)
    return found.groupBy("h").agg(F.sum(first).alias("df"), F.count("*").alias("cf"))


def _named_hashes(docs: DataFrame, text: str, stop_words: Sequence[str], wanted: DataFrame) -> DataFrame:
    """(h, term): the distinct terms of the documents whose hash is in ``wanted``, which is broadcast."""
    words = _spread(docs.select(text)).select(tokens(text, stop_words).alias("a"))
    following = F.slice("a", F.lit(2), F.greatest(F.size("a") - 1, F.lit(0))).alias("b")
    neighbours = words.select(F.explode(F.arrays_zip("a", following)).alias("e")).select("e.a", "e.b")
    hashed = (neighbours.select("a", "b", F.posexplode(F.array(_hash(F.col("a")), _hash(F.col("a"), F.col("b")))).alias("two", "h"))
              .where("two = 0 OR b IS NOT NULL"))
    term = F.when(F.col("two") == 0, F.col("a")).otherwise(F.concat("a", F.lit(" "), "b"))
    return hashed.join(F.broadcast(wanted.select("h")), "h").select("h", term.alias("term")).distinct()


def _frequent_terms(docs: DataFrame, text: str, stop_words: Sequence[str], min_df: int, max_terms: int) -> DataFrame:
    """(term, df, cf) of terms in ``min_df`` documents or more, among them the ``max_terms`` most frequent.

    What hashes count is never less than what one of their terms does, so no
    term outside the most frequent hashes can be missing. Counts of a hash are
    those of its term if it has one only, which the second pass makes sure of.
    """
    if max_terms <= BROADCAST_TERMS:
        frequent = _hash_statistics(docs, text, stop_words).where(F.col("df") >= min_df)
        kept = materialise(near_top_rows(frequent, "cf", max_terms), "frequent-hashes")
        rows = kept.count()
        # Very many equal counts at the cut are all needed, as ties go by term.
        if rows <= BROADCAST_TERMS:
            named = materialise(_named_hashes(docs, text, stop_words, kept).join(F.broadcast(kept), "h"), "frequent-terms")
            if named.count() == rows:
                return named.select("term", "df", "cf")
    return term_statistics(docs, text, stop_words).where(F.col("df") >= min_df)


def document_count(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery."""
    return docs.agg(F.count("*").alias("n")).scalar()


def smoothed_idf(n: Column, df: Column | str) -> Column:
    df = F.col(df) if isinstance(df, str) else df
    return F.log((1 + n) / (1 + df)) + 1


def vocabulary(docs: DataFrame, text: str, stop_words: Sequence[str] = (), min_df: int = 2,
               max_terms: int = 20_000, n: Column | None = None) -> DataFrame:
    """H1: (term, index, df, cf, idf) of the ``max_terms`` most frequent terms.

    Terms in fewer than ``min_df`` documents are out; the cut goes by cf, then
    by term. ``index`` numbers the kept terms alphabetically from 0. ``n`` is the
    number of documents, by default the rows of ``docs``.
    """
    n = document_count(docs) if n is None else n
    frequent = _frequent_terms(docs, text, stop_words, min_df, max_terms)
    kept = top_n_pruned(frequent, "cf", "term", max_terms)
    # At most ``max_terms`` rows, so one ordered window is fine.
    index = (F.row_number().over(W.orderBy("term")) - 1).cast("int")
    return kept.select("term", index.alias("index"), "df", "cf", smoothed_idf(n, "df").alias("idf"))


def term_counts(docs: DataFrame, key: str, text: str, vocab: DataFrame, max_terms: int,
                stop_words: Sequence[str] = (), keep: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """(key, *keep, *vocab, tf): occurrences of each vocabulary term in each document.

    ``key`` is unique; the result is partitioned by it. ``vocab`` has ``term``
    and the columns wanted per term, one of them unique. The terms outside the vocabulary make one
    row per document without a term, so that no document is lost.
    """
    narrow = docs.select(key, *keep, text)
    partitions = partitions or _counting_tasks(docs)
    spread = narrow.repartition(partitions, key) if partitions else narrow.repartition(key)
    found = (spread.select(key, *keep, F.explode_outer(terms(text, stop_words)).alias("term"))
             .join(F.broadcast(vocab) if max_terms <= BROADCAST_TERMS else vocab, "term", "left"))
    wanted = [c for c in vocab.columns if c != "term"]
    return found.groupBy(key, *keep, *wanted).agg(F.count("*").alias("tf"))


def raw_weight(tf: str = "tf", idf: str = "idf") -> Column:
    """Sublinear term frequency times idf."""
    return (1 + F.log(F.col(tf))) * F.col(idf)


def vectors(docs: DataFrame, key: str, text: str, vocab: DataFrame, max_terms: int,
            stop_words: Sequence[str] = (), keep: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """H2: (key, *keep, entries): L2-normalised weights as a list of (index, weight) by index.

    A document without vocabulary terms has an empty list.
    """
    counts = term_counts(docs, key, text, vocab.select("term", "index", "idf"), max_terms, stop_words, keep, partitions)
    raw = counts.select(key, *keep, "index", raw_weight().alias("w"))
    entry = F.when(F.col("index").isNotNull(), F.struct("index", "w"))
    rows = raw.groupBy(key, *keep).agg(
        F.sort_array(F.collect_list(entry)).alias("raw"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.select(key, *keep, F.transform(
        "raw", lambda e: F.struct(e["index"].alias("index"), (e["w"] / F.col("norm")).alias("weight"))
    ).alias("entries"))


def weights(docs: DataFrame, key: str, text: str, stop_words: Sequence[str] = (),
            min_df: int = 2, max_terms: int = 20_000) -> DataFrame:
    """H1 and H2 from documents, in long form: (key, term, weight)."""
    vocab = vocabulary(docs, text, stop_words, min_df, max_terms).select(F.col("term"), F.col("term").alias("name"), "idf")
    known = term_counts(docs, key, text, vocab, max_terms, stop_words).where(F.col("name").isNotNull())
    raw = known.select(key, F.col("name").alias("term"), raw_weight().alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(key)))
    return raw.select(key, "term", (F.col("w") / norm).alias("weight"))
