"""README recipes, end to end on a small XML dump: scores -> CSV -> PIC
input; per-tag models -> store -> one-pass scoring -> expert list."""

from pyspark.sql import functions as F

from forumlens.functions.tags import tag_array
from forumlens.operators import classify as C
from forumlens.operators import graph as G
from forumlens.operators import scores as S
from forumlens.operators import text as X
from forumlens.operators.joint import score_posts
from forumlens.operators.posts import questions, training_set
from forumlens.operators.recommend import recommend_users
from forumlens.sources import formats as fmt
from forumlens.sources import sinks


def _dump(tmp_path):
    rows = ['<?xml version="1.0" encoding="utf-8"?>', "<posts>"]
    for q in range(1, 41):
        tags = "&lt;spark&gt;&lt;python&gt;" if q % 2 else "&lt;python&gt;"
        body = "spark cluster shuffle" if q % 2 else "pandas dataframe numpy"
        rows.append(f'  <row Id="{q}" PostTypeId="1" Tags="{tags}" Title="q{q}" '
                    f'Body="&lt;p&gt;{body}&lt;/p&gt;" OwnerUserId="{100 + q % 3}" />')
        for a in range(3):
            rows.append(f'  <row Id="{1000 + q * 10 + a}" PostTypeId="2" ParentId="{q}" '
                        f'Score="{a + 1}" Body="answer text" OwnerUserId="{a + 1}" />')
    rows.append("</posts>")
    p = tmp_path / "Posts.xml"
    p.write_text("\n".join(rows), encoding="utf-8")
    return str(p)


def test_recipes_end_to_end(spark, tmp_path):
    posts = fmt.typed_posts(fmt.read_posts_xml(spark, _dump(tmp_path)))

    # user-tag scores -> CSV -> triples -> PIC input
    scores = S.user_tag_score(posts)
    sinks.write_user_tag_csv(scores, str(tmp_path / "uts"))
    triples = fmt.read_user_tag_csv(spark, str(tmp_path / "uts"))
    tags = spark.createDataFrame([(1, "spark"), (2, "python")], "Id long, TagName string")
    edges = G.pic_edges(triples.select(F.col("UserId").cast("long").alias("UserId"), "TagId",
                                       F.col("Score").cast("double").alias("Score")), tags)
    assert edges.count() == 6  # 3 answerers x 2 tags
    assert G.power_iteration_vector(edges, 3).count() == 5

    # per-tag models on questions + answers, then all of them over the questions
    def arrays(df):
        words = X.remove_stop_words(X.tokenize(X.clean_text(df, "Title", "Body"), "Text"))
        return X.hashed_tf_arrays(words.select("Id", "Tags", "words"), "words", 1 << 10)

    store = sinks.ModelStore(str(tmp_path / "models"))
    C.train_all_tags(arrays(training_set(posts, "Title", "Body")), tags, store=store, num_features=1 << 10)
    pred = score_posts(arrays(questions(posts)), *store.weights(spark))
    got = {(r["Id"], r["tag"]) for r in pred.collect()}
    truth = {(r["Id"], t) for r in questions(posts).select("Id", tag_array("Tags").alias("t"))
             .collect() for t in r["t"]}
    assert got == truth
    rec = recommend_users(pred.withColumnRenamed("tag", "TagId"), scores, k=2)
    assert rec.count() == 2 * len(got)
