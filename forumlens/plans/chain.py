"""Posts with title and body, from a dump to predicted tags and their experts.

Questions are documents (Title = the first characters of the text, Body =
the text as markup), answers the assistants' turns of the conversation with
the question's number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens.functions.hashing import md5_int
from forumlens.functions.tags import tag_array
from forumlens.operators import posts as P
from forumlens.operators import scores as S
from forumlens.operators import text as X
from forumlens.operators.joint import score_posts
from forumlens.operators.recommend import recommend_users
from forumlens.plans import sql
from forumlens.plans.registry import query
from forumlens.plans.text import _sql_post_text, _sql_words
from forumlens.session import materialize, shared_path
from forumlens.sources import fixtures as fx
from forumlens.sources import formats as fmt
from forumlens.sources import sinks

TITLE_CHARS, ANSWER_IDS = 60, 1_000_000_000
USERS, TOP_K, V = 97, 3, X.NUM_FEATURES

_POSTS = f"""tp AS (
  SELECT doc_id AS Id, 1 AS PostTypeId, CAST(NULL AS BIGINT) AS ParentId, '<' || lang || '><' || source || '>' AS Tags,
         substr(text, 1, {TITLE_CHARS}) AS Title, '<p>' || text || '</p>' AS Body, CAST(NULL AS DOUBLE) AS Score,
         doc_id % {USERS} AS OwnerUserId FROM documents
  UNION ALL
  SELECT {ANSWER_IDS} + conv_id * 1000 + turn, 2, conv_id, NULL, NULL, text, CAST(length(text) % 50 AS DOUBLE),
         (conv_id + turn) % {USERS} FROM conversations WHERE role = 'assistant')"""


def text_posts(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    c = fx.read_table(spark, sf, "conversations").where(F.col("role") == "assistant")
    none = F.lit(None)
    questions = d.select(
        F.col("doc_id").alias("Id"), F.lit(1).alias("PostTypeId"), none.cast("bigint").alias("ParentId"),
        F.concat(F.lit("<"), "lang", F.lit("><"), "source", F.lit(">")).alias("Tags"),
        F.substring("text", 1, TITLE_CHARS).alias("Title"), F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("Body"),
        none.cast("double").alias("Score"), (F.col("doc_id") % USERS).alias("OwnerUserId"))
    answers = c.select(
        (ANSWER_IDS + F.col("conv_id") * 1000 + F.col("turn")).alias("Id"), F.lit(2).alias("PostTypeId"),
        F.col("conv_id").alias("ParentId"), none.cast("string").alias("Tags"), none.cast("string").alias("Title"),
        F.col("text").alias("Body"), (F.length("text") % 50).cast("double").alias("Score"),
        ((F.col("conv_id") + F.col("turn")) % USERS).alias("OwnerUserId"))
    return questions.unionByName(answers)


def read_back(spark, sf):
    """The posts written as an XML dump, read back and typed."""
    path = shared_path(spark, "text-posts-xml")
    sinks.write_posts_xml(text_posts(spark, sf), path)
    return fmt.typed_posts(fmt.read_posts_xml(spark, path))


@query("xml_text_posts_file", f"""WITH {_POSTS}
SELECT Id, PostTypeId, ParentId, coalesce(Tags, '') AS Tags, coalesce(Title, '') AS Title, coalesce(Body, '') AS Body,
       Score, OwnerUserId FROM tp""")
def xml_text_posts_file(spark, sf):
    return read_back(spark, sf)


@query("json_text_questions_file", f"""WITH {_POSTS}
SELECT CAST(Id AS VARCHAR) AS Id, CAST(OwnerUserId AS VARCHAR) AS OwnerUserId, Tags, CAST(NULL AS VARCHAR) AS AcceptedAnswerId,
       Body, CAST(NULL AS VARCHAR) AS AnswerCount FROM tp WHERE PostTypeId = 1 AND Tags IS NOT NULL""")
def json_text_questions_file(spark, sf):
    """S4 with text: JSON lines written in the shared folder, read back."""
    path = shared_path(spark, "text-posts-json")
    posts = text_posts(spark, sf).select(*(F.col(c).cast("string") for c in ("Id", "OwnerUserId", "ParentId", "PostTypeId", "Tags", "Body")))
    posts.select(F.to_json(F.struct(F.struct("*").alias("row"))).alias("value")).write.text(path)
    return fmt.json_questions(fmt.read_posts_json(spark, path))


_TRAIN = f"""{_POSTS},
tr AS (SELECT Id, Tags, {_sql_post_text('Title', 'Body')} AS Text FROM tp WHERE PostTypeId = 1
       UNION ALL
       SELECT a.Id, q.Tags, {_sql_post_text('a.Title', 'a.Body')} FROM tp a JOIN tp q ON a.ParentId = q.Id WHERE a.PostTypeId = 2)"""


@query("training_text", f"WITH {_TRAIN}\nSELECT Id, Tags, Text FROM tr")
def training_text(spark, sf):
    """J2 + U1 + F6 with text: questions and the answers that inherit their
    tags, each with the clean text of its title and body."""
    posts = P.training_set(text_posts(spark, sf), "Title", "Body")
    return X.clean_text(posts, "Title", "Body").select("Id", "Tags", "Text")


def _arrays(posts):
    words = X.remove_stop_words(X.tokenize(X.clean_text(posts, "Title", "Body"), "Text"))
    return materialize(X.hashed_tf_arrays(words.select("Id", "Tags", "words"), "words", V), "arrays")


_TAGS = sql.tag_array("Tags")
_CHAIN = f"""WITH {_TRAIN},
tw AS (SELECT Id, Tags, {sql.md5_bucket('w', V)} AS bucket FROM (SELECT Id, Tags, unnest({_sql_words('Text')}) AS w FROM tr)),
mw AS (SELECT tag, bucket, ({sql.md5_int("tag || ':' || CAST(bucket AS VARCHAR)")} % 2001 - 1000) / 1000.0 AS w
       FROM (SELECT DISTINCT unnest({_TAGS}) AS tag, bucket FROM tw)),
mb AS (SELECT tag, ({sql.md5_int('tag')} % 200 - 150) / 100.0 AS b FROM (SELECT DISTINCT unnest({_TAGS}) AS tag FROM tr)),
qt AS (SELECT Id, bucket, count(*) AS tf FROM tw WHERE Id < {ANSWER_IDS} GROUP BY ALL),
dots AS (SELECT Id, tag, sum(tf * w) AS dot FROM qt JOIN mw USING (bucket) GROUP BY ALL
         UNION ALL SELECT doc_id, tag, 0.0 FROM documents, mb WHERE b > 0),
pr AS (SELECT Id, tag FROM dots JOIN mb USING (tag) GROUP BY Id, tag HAVING round(sum(dot) + any_value(b), 6) > 0),
uts AS (SELECT a.OwnerUserId AS UserId, t.TagId, sum(a.Score) AS TotalScore
        FROM tp a JOIN (SELECT Id, unnest({sql.tag_list('Tags')}) AS TagId FROM tp WHERE PostTypeId = 1) t ON a.ParentId = t.Id
        GROUP BY ALL),
ex AS (SELECT *, row_number() OVER (PARTITION BY TagId ORDER BY TotalScore DESC, UserId) AS rank FROM uts QUALIFY rank <= {TOP_K})"""


@query("predict_and_recommend", f"""{_CHAIN}
SELECT Id, TagId, UserId, TotalScore, CAST(rank AS INTEGER) AS rank FROM pr JOIN ex ON pr.tag = ex.TagId""")
def predict_and_recommend(spark, sf):
    """An XML dump read back; models of a fixed formula over the words
    of the training set (questions and answers, title and body); every model
    over every question; the predicted tags' best users."""
    posts = materialize(read_back(spark, sf), "text-posts")
    train = _arrays(P.training_set(posts, "Title", "Body"))
    labels = train.select(F.explode(tag_array("Tags")).alias("tag"), "buckets")
    seen = labels.select("tag", F.explode("buckets").alias("bucket")).distinct()
    weight = (md5_int(F.concat("tag", F.lit(":"), F.col("bucket").cast("string"))) % 2001 - 1000) / F.lit(1000.0)
    b = labels.select("tag").distinct().select("tag", ((md5_int("tag") % 200 - 150) / F.lit(100.0)).alias("b"))
    scored = score_posts(train.where(F.col("Id") < ANSWER_IDS), seen.withColumn("w", weight), b)
    predicted = scored.where(F.round("margin", 6) > 0).select("Id", F.col("tag").alias("TagId"))
    return recommend_users(predicted, S.user_tag_score(posts), TOP_K)
