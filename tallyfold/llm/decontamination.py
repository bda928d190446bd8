"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A test item is contained in a document when the document holds at least ``SIMILARITY`` of the item's different five-word shingles.
Items are put in partitions by the number of their shingles, (2**k, 2**(k+1)]. An item's sketch is its MinHash: its m smallest shingle
hashes, where m is one more than the largest number of shingles that an item of the partition may miss. So a document that contains
an item holds at least one shingle of its sketch, however long the document is: the search loses nothing, and costs one look-up per
shingle of a document. What it finds is verified by comparing the shingles themselves.

Everything is built from DataFrame functions. Sketches and items are written first, so that the planner knows their size: it broadcasts
them when they are below its threshold and joins by shuffle otherwise.

Words are runs of letters and digits, lower-cased. Null texts are empty. Texts and items with fewer than five words have no shingles:
they contain nothing and are found nowhere. Repeated items are found once per item_id, repeated documents once per doc_id, with the
highest containment; null ids are ids like any other. Empty tables give an empty result. Other columns are ignored or passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import only, saved, text_key, unused

WORDS = 5
SIMILARITY = 0.8
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case words; null and empty texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def bound(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def per_shingle(text: Column, made) -> Column:
    """made(word list, position) for each run of WORDS words."""
    def over(w: Column) -> Column:
        return F.when(F.size(w) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: made(w, i))).otherwise(F.array().cast("array<string>"))

    return bound(words(text), over)


def shingle_hashes(text: Column) -> Column:
    def over(w: Column) -> Column:
        made = F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]))
        return F.when(F.size(w) >= WORDS, made).otherwise(F.array().cast("array<bigint>"))

    return bound(words(text), over)


def shingles(text: Column) -> Column:
    """The different shingles as text."""
    return F.array_distinct(per_shingle(text, lambda w, i: F.array_join(F.slice(w, i + 1, WORDS), " ")))


def sketches(items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """item_id, hash: the sketch of each item, as long as its size partition asks for."""
    hashed = items.select("item_id", F.array_sort(F.array_distinct(shingle_hashes(F.col("text")))).alias("hashes")).where(F.size("hashes") > 0)
    top = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hashes"))))  # the largest size of the partition
    m = (F.floor(F.round(top * (1 - similarity), 6)) + 1).cast("int")
    return hashed.select("item_id", F.explode(F.slice("hashes", F.lit(1), m)).alias("hash"))


def candidates(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, item_id of documents that hold a shingle of an item's sketch, each once."""
    sketch = saved(sketches(only(items, "item_id", "text"), similarity), "sketches")
    own = only(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("text_key"), F.explode(shingle_hashes(F.col("text"))).alias("hash"))
    return own.join(sketch, "hash").select("doc_id", "text_key", "item_id").distinct()


def contained(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, item_id, item_shingles, shared: the verified finds, each once."""
    found = saved(candidates(docs, items, similarity), "candidates").withColumnsRenamed({"doc_id": "c_id", "text_key": "c_key"})
    texts = only(docs, "doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    probes = only(items, "item_id", "text").select(F.col("item_id").alias("i_id"), shingles(F.col("text")).alias("item_shingle_list"))
    pairs = texts.join(found, [texts.doc_id.eqNullSafe(found.c_id), texts.text_key == found.c_key]).select("doc_id", "text_key", "text", "item_id")
    pairs = pairs.join(probes, pairs.item_id.eqNullSafe(probes.i_id))
    shared = F.size(F.array_intersect("item_shingle_list", shingles(F.col("text"))))
    counted = pairs.select("doc_id", "text_key", "item_id", F.size("item_shingle_list").alias("item_shingles"), shared.alias("shared"))
    return counted.where((F.col("item_shingles") > 0) & (F.col("shared") >= similarity * F.col("item_shingles"))).distinct()


def clean(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that contain no item. Columns as in docs."""
    found = saved(contained(docs, items, similarity).select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).distinct(), "contaminated")
    name = unused(docs, "__text_key")
    left = docs.withColumn(name, text_key(F.col("text")))
    return left.join(found, [left.doc_id.eqNullSafe(found.c_id), left[name] == found.c_key], "left_anti").drop(name)


#: The same in DuckDB: doc_id, item_id, item_shingles, shared, containment.
ORACLE = """
WITH item_words AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
item_shingles AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM item_words WHERE len(w) >= 5),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM item_shingles GROUP BY item_id),
doc_words AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM doc_words WHERE len(w) >= 5),
found AS (SELECT doc_id, item_id, count(*) AS shared FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment
FROM found JOIN sizes USING (item_id) WHERE shared >= 0.8 * item_shingles
"""
