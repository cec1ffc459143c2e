"""Row shapes shared by the jobs."""

from pyspark.sql import types as T

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

LINK = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("seed_date", T.DateType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("badge", T.StringType()),
    ]
)

ARTICLE = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("author", T.StringType()),
        T.StructField("pubdate", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("comments", T.IntegerType()),
        T.StructField("images", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

RUN_STATE = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("category", T.StringType()),
        # Where the run stands, in the order of a grid: day, category, page.
        T.StructField("date", T.DateType()),
        T.StructField("cat_ord", T.IntegerType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)

REPAIR = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("column", T.StringType()),
        T.StructField("new_value", T.StringType()),
    ]
)
