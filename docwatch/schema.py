"""Fixed schemas of the tables that pass between the stages."""

from __future__ import annotations

from pyspark.sql import types as T

ITEMS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("src", T.StringType(), False),
        T.StructField("chan", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("lang", T.StringType()),
        T.StructField("lang_conf", T.FloatType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("entities", T.MapType(T.StringType(), T.StringType())),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("hash_sim", T.StringType()),
    ]
)

CLUSTERS = T.StructType(
    [
        T.StructField("cluster_id", T.StringType(), False),
        T.StructField("topic", T.StringType()),
        T.StructField("start_ts", T.TimestampType()),
        T.StructField("end_ts", T.TimestampType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("score", T.FloatType()),
        T.StructField("summary", T.StringType()),
        T.StructField("rep_item_ids", T.ArrayType(T.StringType())),
    ]
)

FEED_ENTRIES = T.StructType(
    [
        T.StructField("feed_url", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField(
            "links", T.ArrayType(T.StructType([T.StructField("href", T.StringType())]))
        ),
        T.StructField("title", T.StringType()),
        T.StructField("published", T.StringType()),
        T.StructField("updated", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField(
            "content", T.ArrayType(T.StructType([T.StructField("value", T.StringType())]))
        ),
        T.StructField(
            "summary_detail", T.StructType([T.StructField("value", T.StringType())])
        ),
        T.StructField("summary", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

TERMS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("ord", T.IntegerType()),
        T.StructField("term", T.StringType()),
    ]
)

TERM_KINDS = ("keyword", "anchor", "negative", "exclude")
