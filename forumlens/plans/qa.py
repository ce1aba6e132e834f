"""Q&A queries: posts, joins, tag handling, scores, sources and sinks."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from forumlens.functions.tags import clean_tags, tag_array
from forumlens.functions.text import java_trim
from forumlens.operators import posts as P
from forumlens.operators import scores as S
from forumlens.operators import tags as TG
from forumlens.operators.recommend import recommend_users
from forumlens.plans import sql
from forumlens.plans.registry import query
from forumlens.sources import fixtures as fx
from forumlens.sources import formats as fmt
from forumlens.sources import sinks
from forumlens.session import materialize, shared_path

# Parameters of the registered queries (fixed values of this fixture set).
TOP_N = 10
TOP_K = 3
EXPERT_TAG = "1-urgent"
DOC_TAG = "src1"


@query("user_tag_score", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT UserId, TagId, TotalScore FROM uts""")
def user_tag_score(spark: SparkSession, sf: str):
    return S.user_tag_score(fx.qa_posts(spark, sf), sort=True)


@query("top_user_tags", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT UserId, TagId, TotalScore FROM uts
ORDER BY TotalScore DESC, UserId, TagId LIMIT {TOP_N}""")
def top_user_tags(spark, sf):
    return S.top_user_tags(S.user_tag_score(fx.qa_posts(spark, sf)), TOP_N)


@query("top_experts", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT UserId, TagId, TotalScore, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY TagId ORDER BY TotalScore DESC, UserId) AS rank
  FROM uts) WHERE rank <= {TOP_K}""")
def top_experts(spark, sf):
    return S.top_experts(S.user_tag_score(fx.qa_posts(spark, sf)), TOP_K)


@query("experts_for_tag", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT TagId, UserId, max(TotalScore) AS score FROM uts
WHERE TagId = '{EXPERT_TAG}' GROUP BY TagId, UserId HAVING max(TotalScore) > 0""")
def experts_for_tag(spark, sf):
    return S.experts_for_tag(S.user_tag_score(fx.qa_posts(spark, sf)), EXPERT_TAG)


@query("recommend_users", f"""WITH {sql.USER_TAG_SCORE_CTE},
top AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY TagId ORDER BY TotalScore DESC, UserId) AS rank
  FROM uts) WHERE rank <= {TOP_K}),
pred AS (SELECT DISTINCT Id, unnest({sql.tag_array('Tags')}) AS TagId
         FROM posts WHERE PostTypeId = 1)
SELECT p.Id, p.TagId, t.UserId, t.TotalScore, CAST(t.rank AS INTEGER) AS rank
FROM pred p JOIN top t ON p.TagId = t.TagId""")
def recommend_users_q(spark, sf):
    posts = fx.qa_posts(spark, sf)
    predicted = P.questions(posts).select(
        "Id", F.explode(F.array_distinct(tag_array("Tags"))).alias("TagId"))
    return recommend_users(predicted, S.user_tag_score(posts), TOP_K)


@query("qa_join", f"""WITH {sql.POSTS_CTE}
SELECT a.ParentId, a.Id, a.OwnerUserId, a.Score, q.Tags
FROM posts a JOIN posts q ON a.ParentId = q.Id ORDER BY a.ParentId""")
def qa_join(spark, sf):
    return P.qa_join(fx.qa_posts(spark, sf), sort=True)


@query("answers_inherit_tags", f"""SELECT CAST(NULL AS BIGINT) AS Id, 2 AS PostTypeId, l_orderkey AS ParentId,
       {sql.ORDER_TAGS} AS Tags, l_suppkey AS OwnerUserId, CAST(l_quantity AS DOUBLE) AS Score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def answers_inherit_tags(spark, sf):
    return P.answers_inherit_tags(fx.qa_posts(spark, sf))


@query("questions", f"""WITH {sql.POSTS_CTE}
SELECT * FROM posts WHERE PostTypeId = 1""")
def questions(spark, sf):
    return P.questions(fx.qa_posts(spark, sf))


@query("answers", f"""WITH {sql.POSTS_CTE}
SELECT * FROM posts WHERE PostTypeId = 2""")
def answers(spark, sf):
    return P.answers(fx.qa_posts(spark, sf))


@query("training_set", f"""WITH {sql.POSTS_CTE}
SELECT Id, PostTypeId, ParentId, Tags, OwnerUserId, Score FROM posts WHERE PostTypeId = 1
UNION ALL
SELECT a.Id, a.PostTypeId, a.ParentId, q.Tags, a.OwnerUserId, a.Score
FROM posts a JOIN posts q ON a.ParentId = q.Id WHERE a.PostTypeId = 2""")
def training_set(spark, sf):
    return P.training_set(fx.qa_posts(spark, sf))


@query("tag_clean", f"""WITH {sql.POSTS_CTE}
SELECT Id, Tags, {sql.clean_tags('Tags')} AS clean,
       CAST(len({sql.tag_list('Tags')}) AS INTEGER) AS n_tags
FROM posts WHERE PostTypeId = 1""")
def tag_clean(spark, sf):
    q = P.questions(fx.qa_posts(spark, sf))
    return q.select("Id", "Tags", clean_tags("Tags").alias("clean"),
                    F.size(F.split(clean_tags("Tags"), " ")).alias("n_tags"))


@query("tag_explode", f"""WITH {sql.POSTS_CTE}
SELECT Id, CAST(pos AS INTEGER) AS pos, TagId FROM (
  SELECT Id, unnest(generate_series(0, len(t) - 1)) AS pos, unnest(t) AS TagId
  FROM (SELECT Id, {sql.tag_list('Tags')} AS t FROM posts WHERE PostTypeId = 1))""")
def tag_explode(spark, sf):
    q = P.questions(fx.qa_posts(spark, sf)).select("Id", "Tags")
    return TG.explode_tags(q, out="TagId", with_pos=True)


_VOCAB_SQL = f"""vocab AS (SELECT DISTINCT unnest({sql.tag_array('Tags')}) AS TagName
                   FROM posts WHERE PostTypeId = 1)"""


@query("post_tag_labels", f"""WITH {sql.POSTS_CTE}, {_VOCAB_SQL}
SELECT DISTINCT p.Id, v.TagName FROM
  (SELECT Id, unnest({sql.tag_array('Tags')}) AS TagName FROM posts) p
  JOIN vocab v ON p.TagName = v.TagName""")
def post_tag_labels(spark, sf):
    posts = fx.qa_posts(spark, sf)
    vocab = TG.explode_tags(P.questions(posts).select("Tags"), out="TagName",
                            exact=True).distinct()
    return TG.post_tag_labels(posts.where(F.col("Id").isNotNull()), vocab,
                              match="exact")


@query("post_tag_labels_substring", f"""WITH {sql.POSTS_CTE}, {_VOCAB_SQL}
SELECT p.Id, v.TagName FROM posts p JOIN vocab v ON contains(p.Tags, v.TagName)
WHERE p.Id IS NOT NULL""")
def post_tag_labels_substring(spark, sf):
    posts = fx.qa_posts(spark, sf)
    vocab = TG.explode_tags(P.questions(posts).select("Tags"), out="TagName",
                            exact=True).distinct()
    return TG.post_tag_labels(posts.where(F.col("Id").isNotNull()), vocab,
                              match="substring")


@query("label_substring", f"""WITH {sql.DOC_POSTS_CTE}
SELECT Id, CASE WHEN contains(Tags, '{DOC_TAG}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM dposts""")
def label_substring(spark, sf):
    d = fx.document_posts(spark, sf).select("Id", "Tags")
    return TG.label_column(d, DOC_TAG, match="substring").select("Id", "label")


@query("label_exact", f"""WITH {sql.DOC_POSTS_CTE}
SELECT Id, CASE WHEN list_contains({sql.tag_array('Tags')}, '{DOC_TAG}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
       AS label FROM dposts""")
def label_exact(spark, sf):
    d = fx.document_posts(spark, sf).select("Id", "Tags")
    return TG.label_column(d, DOC_TAG, match="exact").select("Id", "label")


@query("any_col_contains", f"""WITH {sql.DOC_POSTS_CTE}
SELECT count(*) AS n FROM dposts
WHERE contains('[' || CAST(Id AS VARCHAR) || ',' || CAST(PostTypeId AS VARCHAR) || ','
               || coalesce(Tags, 'null') || ',' || coalesce(Text, 'null') || ']', '{DOC_TAG}')""")
def any_col_contains(spark, sf):
    d = fx.document_posts(spark, sf)
    return P.any_column_contains(d, DOC_TAG).agg(F.count(F.lit(1)).alias("n"))


@query("avg_by_key", """SELECT event_type, count(value) AS n, round(sum(value), 6) AS total,
       round(avg(value), 6) AS mean FROM events GROUP BY event_type""")
def avg_by_key(spark, sf):
    e = fx.read_table(spark, sf, "events")
    out = S.avg_by_key(e, "event_type", "value")
    return out.select("event_type", "n", F.round("total", 6).alias("total"),
                      F.round("mean", 6).alias("mean"))


@query("key_map", """SELECT l_orderkey, l_linenumber, value FROM lineitem LEFT JOIN (
  SELECT o_custkey, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY o_custkey) ON l_suppkey = o_custkey""")
def key_map(spark, sf):
    """All order prices of each customer as hash-bucketed maps, looked up by
    another table's keys (suppliers read as customers; some have no order)."""
    o = fx.read_table(spark, sf, "orders")
    maps = materialize(S.as_key_map(S.avg_by_key(o, "o_custkey", "o_totalprice"), "o_custkey", "total"), "key-map")
    li = fx.read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return S.look_up(li, maps, "l_suppkey").select("l_orderkey", "l_linenumber", F.round("value", 2).alias("value"))


@query("literal_tag_scores", """SELECT TagId, CAST(n AS BIGINT) AS n FROM (VALUES ('1-urgent'), ('o'), ('no-such-tag')) v(TagId)
LEFT JOIN (SELECT replace(lower(o_orderpriority), ' ', '-') AS TagId, count(*) AS n FROM orders GROUP BY ALL
           UNION ALL SELECT lower(o_orderstatus), count(*) FROM orders GROUP BY ALL) USING (TagId)""")
def literal_tag_scores(spark, sf):
    """A literal list of tags as a source, joined to the questions' tag
    counts."""
    tags = spark.createDataFrame([("1-urgent",), ("o",), ("no-such-tag",)], "TagId string")
    counts = TG.explode_tags(P.questions(fx.qa_posts(spark, sf)).select("Tags")).groupBy("TagId").agg(F.count(F.lit(1)).alias("n"))
    return tags.join(counts, "TagId", "left")


_TRIM_SQL = ("regexp_replace(regexp_replace(line, '^[\\x00-\\x20]+', ''), "
             "'[\\x00-\\x20]+$', '')")


@query("line_filter", f"""SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, line FROM (
  SELECT conv_id, turn, pos, {_TRIM_SQL} AS line FROM (
    SELECT conv_id, turn, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS line
    FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations)))
WHERE NOT starts_with(line, '<?xml version=') AND line <> '<posts>' AND line <> '</posts>'""")
def line_filter(spark, sf):
    c = fx.read_table(spark, sf, "conversations")
    lines = c.select("conv_id", "turn", F.posexplode(F.split("text", "\n"))
                     .alias("pos", "line"))
    return fmt.filter_wrapper_lines(lines.withColumn("line", java_trim("line")),
                                    "line", wrapper="posts")


# ---- sources ---------------------------------------------------------------

@query("xml_posts", f"""WITH {sql.POSTS_CTE}
SELECT coalesce(CAST(Id AS VARCHAR), '') AS Id, CAST(PostTypeId AS VARCHAR) AS PostTypeId,
       coalesce(CAST(ParentId AS VARCHAR), '') AS ParentId, coalesce(Tags, '') AS Tags,
       coalesce(Title, '') AS Title, coalesce(Body, '') AS Body,
       coalesce(CAST(CAST(Score AS BIGINT) AS VARCHAR), '') AS Score,
       CAST(OwnerUserId AS VARCHAR) AS OwnerUserId
FROM posts""")
def xml_posts(spark, sf):
    posts = _spread(spark, fx.qa_posts(spark, sf)).withColumn(
        "Score", F.col("Score").cast("bigint").cast("string"))
    lines = posts.select(fmt.xml_row_line(posts.columns).alias("value"))
    return fmt.parse_posts_xml_lines(lines, "value")


@query("xml_posts_file", f"""WITH {sql.POSTS_CTE}
SELECT coalesce(CAST(Id AS VARCHAR), '') AS Id, CAST(PostTypeId AS VARCHAR) AS PostTypeId,
       coalesce(CAST(ParentId AS VARCHAR), '') AS ParentId, coalesce(Tags, '') AS Tags,
       coalesce(Title, '') AS Title, coalesce(Body, '') AS Body,
       coalesce(CAST(CAST(Score AS BIGINT) AS VARCHAR), '') AS Score,
       CAST(OwnerUserId AS VARCHAR) AS OwnerUserId
FROM posts""")
def xml_posts_file(spark, sf):
    """The posts written as an XML dump (``<posts>`` of ``<row/>``) in
    the shared folder, then read back with the XML data source."""
    posts = _spread(spark, fx.qa_posts(spark, sf)).withColumn(
        "Score", F.col("Score").cast("bigint").cast("string"))
    path = shared_path(spark, "posts-xml")
    sinks.write_posts_xml(posts, path)
    return fmt.read_posts_xml(spark, path)


@query("xml_tags", """SELECT CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS Id,
       event_type AS TagName, count(*) AS Count FROM events GROUP BY event_type""")
def xml_tags(spark, sf):
    tags = fx.event_tags(spark, sf)
    lines = tags.select(fmt.xml_row_line(["Id", "TagName", "Count"]).alias("value"))
    return fmt.typed_tags(fmt.parse_tags_xml_lines(lines, "value"))


@query("xml_tags_file", """SELECT CAST(row_number() OVER (ORDER BY event_type) AS BIGINT) AS Id,
       event_type AS TagName, count(*) AS Count FROM events GROUP BY event_type""")
def xml_tags_file(spark, sf):
    """The tags written as an XML dump in the shared folder, read back
    with the XML data source."""
    path = shared_path(spark, "tags-xml")
    sinks.write_tags_xml(fx.event_tags(spark, sf), path)
    return fmt.typed_tags(fmt.read_tags_xml(spark, path))


_JSON_Q = """SELECT CAST(o_orderkey AS VARCHAR) AS Id, CAST(o_custkey AS VARCHAR) AS OwnerUserId,
         {tags} AS Tags, CAST(NULL AS VARCHAR) AS AcceptedAnswerId,
         CAST(NULL AS VARCHAR) AS Body, CAST(NULL AS VARCHAR) AS AnswerCount
  FROM orders""".format(tags=sql.ORDER_TAGS)


@query("json_questions", _JSON_Q)
def json_questions(spark, sf):
    return fmt.json_questions(fmt.parse_posts_json_lines(_json_lines(spark, sf), "value"))


@query("json_qa_join", f"""SELECT CAST(l_orderkey AS VARCHAR) AS ParentId,
       CAST(l_suppkey AS VARCHAR) AS OwnerUserId,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS Score, q.Tags
FROM lineitem JOIN ({_JSON_Q}) q ON q.Id = CAST(l_orderkey AS VARCHAR)
ORDER BY ParentId""")
def json_qa_join(spark, sf):
    # both join sides read the same JSON source: parse it once into a staged
    # Parquet table in the shared folder instead of parsing it twice
    rows = materialize(fmt.parse_posts_json_lines(_json_lines(spark, sf), "value"),
                       "json-posts")
    return fmt.json_qa_join(fmt.json_questions(rows), fmt.json_answers(rows))


@query("json_questions_file", _JSON_Q)
def json_questions_file(spark, sf):
    """The posts written as JSON lines in the shared folder, read back
    with the JSON data source and an explicit schema."""
    path = shared_path(spark, "posts-json")
    _json_lines(spark, sf).write.text(path)
    return fmt.json_questions(fmt.read_posts_json(spark, path))


def _spread(spark, df):
    """Text lines of a dump are split across tasks by the reader; the
    single-row-group fixture files are not, so spread them (when the scan
    has few files) before the per-row serialise/parse work."""
    return fx.spread_if_few_files(df)


def _json_lines(spark, sf):
    posts = _spread(spark, fx.qa_posts(spark, sf))
    as_str = [F.col(c).cast("string").alias(c) for c in
              ["Id", "OwnerUserId", "ParentId", "PostTypeId", "Tags"]]
    as_str.append(F.col("Score").cast("bigint").cast("string").alias("Score"))
    return posts.select(F.to_json(F.struct(F.struct(*as_str).alias("row")))
                        .alias("value"))


@query("user_tag_csv", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT UserId, TagId, TotalScore FROM uts""")
def user_tag_csv(spark, sf):
    scores = S.user_tag_score(fx.qa_posts(spark, sf))
    path = shared_path(spark, "user-tag-csv")
    sinks.write_user_tag_csv(scores, path)
    return fmt.typed_user_tag(fmt.read_user_tag_csv(spark, path))


@query("user_tag_score_stream", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT UserId, TagId, TotalScore FROM uts""")
def user_tag_score_stream(spark, sf):
    """A1 as a Structured Streaming job: lineitem read as a file stream of
    answers, joined to the static questions, state-store aggregation in
    update mode, changelog compacted on read."""
    from forumlens.streaming import scores as ST
    li = fx.read_table(spark, sf, "lineitem")
    stream = (spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 1)
              .option("pathGlobFilter", "lineitem.parquet").parquet(sf))
    answers = fx.answer_posts(stream)
    questions = fx.question_posts(fx.read_table(spark, sf, "orders"))
    base = shared_path(spark, "uts-stream")
    q = ST.start_changelog(ST.running_scores(answers, questions),
                           f"{base}/changelog", f"{base}/checkpoint")
    q.awaitTermination()
    return ST.current(spark, f"{base}/changelog")


@query("user_tag_score_xml", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT UserId, TagId, TotalScore FROM uts""")
def user_tag_score_xml(spark, sf):
    """The whole user-tag score program: posts written as an XML dump in the
    shared folder, read back with the XML source (raw strings), typed with
    try_cast, joined, exploded and summed."""
    posts = _spread(spark, fx.qa_posts(spark, sf)).withColumn(
        "Score", F.col("Score").cast("bigint").cast("string"))
    path = shared_path(spark, "posts-xml")
    sinks.write_posts_xml(posts, path)
    typed = fmt.typed_posts(fmt.read_posts_xml(spark, path))
    return S.user_tag_score(typed, sort=True)


@query("json_user_tag_score", f"""WITH {sql.USER_TAG_SCORE_CTE}
SELECT UserId, TagId, TotalScore FROM uts""")
def json_user_tag_score(spark, sf):
    """The JSON program's intended (commented-out) end: posts as JSON lines
    in the shared folder, tagged questions joined to answers, tags exploded,
    scores summed per (user, tag)."""
    path = shared_path(spark, "posts-json")
    _json_lines(spark, sf).write.text(path)
    rows = materialize(fmt.read_posts_json(spark, path), "json-posts")
    j = fmt.json_qa_join(fmt.json_questions(rows), fmt.json_answers(rows), sort=False)
    typed = j.select(F.expr("try_cast(OwnerUserId AS BIGINT)").alias("UserId"),
                     F.expr("try_cast(Score AS DOUBLE)").alias("Score"), "Tags")
    ex = TG.explode_tags(typed, out="TagId")
    return ex.groupBy("UserId", "TagId").agg(F.sum("Score").alias("TotalScore"))
