"""The article table: the input contract of every statistics job."""

from pyspark.sql import types as T

LINK = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("end", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("start", T.LongType()),
])

PARAGRAPH = T.StructType([
    T.StructField("paraText", T.StringType()),
    T.StructField("links", T.ArrayType(T.StructType([T.StructField("id", T.StringType())]))),
])

ARTICLE = T.StructType([
    T.StructField("wid", T.LongType()),
    T.StructField("wikiTitle", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("redirect", T.StringType()),
    T.StructField("wikiText", T.StringType()),
    T.StructField("links", T.ArrayType(LINK)),
    T.StructField("paragraphsLink", T.ArrayType(PARAGRAPH)),
])

ARTICLE_WITH_CORRUPT = T.StructType(ARTICLE.fields + [T.StructField("_corrupt_record", T.StringType())])

ARTICLE_TYPE = "ARTICLE"
REDIRECT_TYPE = "REDIRECT"
OTHER_TYPE = "OTHER"
