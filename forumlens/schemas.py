"""Fixed schemas of the Q&A data model.

Raw layer: what the XML reader yields, every attribute a nullable string
(an absent attribute reads as ``""`` after ``raw_defaults``).
Typed layer: ids as longs, post kind as int, score as double.
"""

from pyspark.sql import types as T

POST_FIELDS = ["Id", "PostTypeId", "ParentId", "Tags", "Title", "Body",
               "Score", "OwnerUserId"]

RAW_POSTS = T.StructType([T.StructField(f, T.StringType(), True)
                          for f in POST_FIELDS])

POSTS = T.StructType([
    T.StructField("Id", T.LongType(), True),
    T.StructField("PostTypeId", T.IntegerType(), True),
    T.StructField("ParentId", T.LongType(), True),
    T.StructField("Tags", T.StringType(), True),
    T.StructField("Title", T.StringType(), True),
    T.StructField("Body", T.StringType(), True),
    T.StructField("Score", T.DoubleType(), True),
    T.StructField("OwnerUserId", T.LongType(), True),
])

TAG_FIELDS = ["Id", "TagName", "Count"]
RAW_TAGS = T.StructType([T.StructField(f, T.StringType(), True)
                         for f in TAG_FIELDS])
TAGS = T.StructType([
    T.StructField("Id", T.LongType(), True),
    T.StructField("TagName", T.StringType(), True),
    T.StructField("Count", T.LongType(), True),
])

# JSON dump: one object per line, the post nested in a ``row`` struct.
JSON_ROW = T.StructType([T.StructField(f, T.StringType(), True) for f in [
    "Id", "OwnerUserId", "ParentId", "PostTypeId", "Tags", "Score",
    "AcceptedAnswerId", "Body", "AnswerCount", "FavoriteCount"]])
JSON_POSTS = T.StructType([T.StructField("row", JSON_ROW, True)])

# user, tag, score triples as the CSV sink writes them
USER_TAG = T.StructType([
    T.StructField("UserId", T.StringType(), True),
    T.StructField("TagId", T.StringType(), True),
    T.StructField("Score", T.StringType(), True),
])

USER_TAG_SCORE = T.StructType([
    T.StructField("UserId", T.LongType(), True),
    T.StructField("TagId", T.StringType(), True),
    T.StructField("TotalScore", T.DoubleType(), True),
])
