"""Stored indexes for search: terms with their rows, and the best titles for the beginnings of words.

A search reads the files of its terms' first letters, and in them the row groups that can hold the terms; texts aren't read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import query_terms
from shelfmark.sources.store import settings

#: Letters and digits that have a partition of their own; all else shares the last.
HEADS, REST = "abcdefghijklmnopqrstuvwxyz0123456789", "other"
POSTINGS = "term string, id long, head string"


def _head(term: Column) -> Column:
    first = F.substring(term, 1, 1)
    return F.when(first.isin(*HEADS), first).otherwise(REST)


def _head_of(term: str) -> str:
    return term[0] if term[0] in HEADS else REST


def words_of(text: Column) -> Column:
    """The distinct words of a text, as the search cuts them."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def build(rows: DataFrame, key: str, text: str, path: str) -> None:
    """Writes a row for each word of each text, by its head, in the order of words. A frequent word lies in several files.

    Words go through one shuffle, by ranges; only where a key comes again, rows are made distinct before. Words in order are in the
    order of heads too, so a task writes its few heads side by side, without sorting by them.
    """
    spark = rows.sparkSession
    posted = rows.select(F.explode(words_of(F.col(text))).alias("term"), F.col(key).cast("long").alias("id"))
    if not rows.groupBy(F.col(key).cast("long")).count().filter("count > 1").isEmpty():
        posted = posted.distinct()
    spread = posted.repartitionByRange("term", "id").sortWithinPartitions("term", "id").withColumn("head", _head(F.col("term")))
    with settings(spark, spark__sql__maxConcurrentOutputFileWriters=str(len(HEADS) + 1)):
        spread.write.partitionBy("head").parquet(path)


def search(spark: SparkSession, path: str, query: str) -> DataFrame:
    """id of the texts that have every term of the query as a word, the last one as a word's beginning."""
    terms = query_terms(query)
    postings = spark.read.schema(POSTINGS).parquet(path)
    if not terms:
        return postings.filter(F.lit(False)).select("id")
    whole = [postings.filter((F.col("head") == _head_of(t)) & (F.col("term") == t)).select("id") for t in dict.fromkeys(terms[:-1])]
    last = terms[-1]
    begun = postings.filter((F.col("head") == _head_of(last)) & F.col("term").startswith(last)).select("id").distinct()
    return reduce(lambda found, more: found.join(more, "id", "left_semi"), whole, begun)


def build_beginnings(resources: dict[str, tuple[DataFrame, str, str]], path: str, longest: int, most: int, rows_a_task: int = 50_000) -> None:
    """Writes, for each beginning of a word up to ``longest`` characters and each resource, the first ``most`` rows by title and id.

    Rows get a number in that order first (Spark sorts by range, so numbers ascend), with which beginnings are ranked: titles
    go through no shuffle but the sort, and of each beginning every task sends on ``most`` rows at most. Shuffles have a task for each
    ``rows_a_task`` rows of all resources, as a title can be a long text, and titles are read by 8 MB: a task sorts their beginnings.
    """
    spark = next(iter(resources.values()))[0].sparkSession
    parts = [rows.select(F.lit(kind).alias("object_type"), F.col(key).cast("long").alias("id"), F.col(title).alias("title")) for kind, (rows, key, title) in resources.items()]
    ordered = reduce(DataFrame.unionByName, parts).orderBy("title", "id").withColumn("place", F.monotonically_increasing_id())
    tasks = str(1 + sum(part.count() for part in parts) // rows_a_task)
    with settings(spark, spark__sql__shuffle__partitions=tasks, spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__files__maxPartitionBytes="8m"):
        ordered.write.parquet(f"{path}/titles")
        titles = spark.read.schema(ordered.schema).parquet(f"{path}/titles")
        begun = F.array_distinct(F.flatten(F.transform(words_of(F.col("title")), lambda w: F.transform(F.sequence(F.lit(1), F.least(F.length(w), F.lit(longest))), lambda n: F.substr(w, F.lit(1), n)))))
        each = titles.select("object_type", "place", F.explode(begun).alias("begun"))
        best = each.withColumn("rank", F.row_number().over(Window.partitionBy("object_type", "begun").orderBy("place"))).filter(F.col("rank") <= most)
        named = best.join(titles.select("place", "id", "title"), "place").drop("place").withColumn("head", _head(F.col("begun")))
        named.repartitionByRange("head", "begun").sortWithinPartitions("head", "begun").write.partitionBy("head").parquet(f"{path}/beginnings")


def suggested(spark: SparkSession, path: str, query: str, kinds: Sequence[str], each: int, longest: int) -> DataFrame | None:
    """object_type, id, title: the first titles of each resource for a query of one term of up to ``longest`` characters; null for one
    that needs the search. each and longest are no more than what was built."""
    terms = query_terms(query)
    if len(terms) != 1 or len(terms[0]) > longest:
        return None
    rows = spark.read.schema("object_type string, begun string, rank int, id long, title string, head string").parquet(f"{path}/beginnings")
    found = rows.filter((F.col("head") == _head_of(terms[0])) & (F.col("begun") == terms[0]) & (F.col("rank") <= each) & F.col("object_type").isin(*kinds))
    return found.select("object_type", "id", "title")
