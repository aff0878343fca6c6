"""Explicit schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T

NODE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("last", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("elem_id", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("foreign", T.BooleanType()),
    T.StructField("role", T.StringType()),
    T.StructField("rel", T.StringType()),
    T.StructField("hidden", T.BooleanType()),
    T.StructField("kids", T.ArrayType(T.StringType())),
    T.StructField("s", T.IntegerType()),
    T.StructField("e", T.IntegerType()),
    T.StructField("number", T.LongType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("commas", T.IntegerType()),
    T.StructField("links", T.IntegerType()),
    T.StructField("inner", T.IntegerType()),
])
FRAME = T.StructType([
    T.StructField("node_id", T.IntegerType()),
    T.StructField("src", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
])
DOM_FIELDS = [
    T.StructField("nodes", T.ArrayType(NODE)),
    T.StructField("tok_t", T.ArrayType(T.StringType())),
    T.StructField("tok_h", T.ArrayType(T.StringType())),
    T.StructField("tok_m", T.ArrayType(T.StringType())),
    T.StructField("frames", T.ArrayType(FRAME)),
    T.StructField("scan_error", T.StringType()),
]
PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
BLOCK_ROW = T.StructType([
    T.StructField("selector", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("text_length", T.IntegerType()),
    T.StructField("tag_count", T.IntegerType()),
    T.StructField("link_density", T.DoubleType()),
    T.StructField("text_density", T.DoubleType()),
    T.StructField("comma_count", T.IntegerType()),
])
STRUCTURE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("selector", T.StringType()),
    T.StructField("noise_selectors", T.ArrayType(T.StringType())),
    T.StructField("mapper_confidence", T.DoubleType()),
    T.StructField("scorer_confidence", T.DoubleType()),
    T.StructField("validator_confidence", T.DoubleType()),
    T.StructField("validation_pass", T.IntegerType()),
    T.StructField("validation_warning", T.StringType()),
    T.StructField("scored_blocks_count", T.IntegerType()),
    T.StructField("scored_blocks", T.ArrayType(BLOCK_ROW)),
    T.StructField("cached_at", T.TimestampType()),
])
HITS = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("rank_in", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("score", T.DoubleType()),
])
