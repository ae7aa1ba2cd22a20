"""Name search through a word index (F4, C1): the texts are not read again.

A search word has no blanks, so ``vector.contains(word)`` holds exactly if one
of the vector's words contains it.  The index is two tables: the vocabulary
(each distinct word) and the postings (word, key of a row that has it), both
dealt into ``bucket`` folders by the word's hash and sorted by word within.
A search filters the vocabulary, which grows with the distinct words and not
with the rows, and opens the postings of the buckets that its words are in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.text import search_words


def _vector_words(vector: Column) -> Column:
    return F.array_distinct(F.filter(F.split(vector, r"\s+"), lambda w: w != ""))


def write_word_index(rows: DataFrame, key: str, vector: Column | str, path: str, buckets: int = 256) -> None:
    """The index of ``rows`` under ``path``.  ``key`` is the column that names a
    row.  A null vector, or one of blanks, has no words.  Ranges of (bucket,
    word, key) deal the postings, so a word that a third of all rows have is cut
    into many tasks and files."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    postings = (rows.select(F.col(key).alias("key"), F.explode(_vector_words(vector)).alias("word"))
                .withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int")))
    (postings.repartitionByRange("bucket", "word", "key").sortWithinPartitions("bucket", "word", "key")
     .write.partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/postings"))
    written = rows.sparkSession.read.schema("key " + rows.schema[key].dataType.simpleString() + ", word string, bucket int") \
        .parquet(f"{path}/postings")
    (written.select("bucket", "word").distinct().repartitionByRange("word").sortWithinPartitions("word")
     .write.option("compression", "zstd").parquet(f"{path}/vocabulary"))


def indexed_keys(spark: SparkSession, path: str, person: str | None) -> DataFrame | None:
    """``key`` of every row whose vector contains each word of ``person``, once;
    None for a blank name (no condition).

    One job finds the buckets of the words, no more numbers than the index has
    buckets: they become a partition filter.  A row counts as often as words
    of the search are found in it, summed map-side.
    """
    typed = sorted(set(search_words(person)))
    if not typed:
        return None
    vocabulary = spark.read.parquet(f"{path}/vocabulary")
    hits = (vocabulary.filter(reduce(lambda a, b: a | b, [F.col("word").contains(w) for w in typed]))
            .withColumn("found", F.filter(F.array(*[F.lit(w) for w in typed]), lambda w: F.col("word").contains(w))))
    buckets = [r["bucket"] for r in hits.select("bucket").distinct().collect()]
    if not buckets:  # an empty index has no postings to read
        return hits.select(F.lit(None).alias("key")).limit(0)
    postings = spark.read.parquet(f"{path}/postings").filter(F.col("bucket").isin(buckets))
    flags = [F.max(F.array_contains("found", w)).alias(f"w{k}") for k, w in enumerate(typed)]
    return (postings.join(hits, ["bucket", "word"]).groupBy("key").agg(*flags)
            .filter(reduce(lambda a, b: a & b, [F.col(f"w{k}") for k in range(len(typed))])).select("key"))


def indexed_search(rows: DataFrame, key: str, path: str, person: str | None, *, columns, order,
                   limit: int | None = 500) -> DataFrame:
    """:func:`search.search` by name through the index: the rows' own columns
    are read, their vectors are not.  The limit is taken in ``order``."""
    keys = indexed_keys(rows.sparkSession, path, person)
    found = rows if keys is None else rows.join(keys, rows[key] == keys["key"], "left_semi")
    out = found.select(*columns)
    return out if limit is None else out.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(limit)
