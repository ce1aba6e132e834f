"""DuckDB snippets shared by the oracle queries (same adapters as
``sources.fixtures``, written in SQL)."""

ORDER_TAGS = ("'<' || replace(lower(o_orderpriority), ' ', '-') || '><' || "
              "lower(o_orderstatus) || '>'")

POSTS_CTE = f"""posts AS (
  SELECT o_orderkey AS Id, 1 AS PostTypeId, CAST(NULL AS BIGINT) AS ParentId,
         {ORDER_TAGS} AS Tags, CAST(NULL AS VARCHAR) AS Title,
         CAST(NULL AS VARCHAR) AS Body, CAST(NULL AS DOUBLE) AS Score,
         o_custkey AS OwnerUserId
  FROM orders
  UNION ALL
  SELECT CAST(NULL AS BIGINT), 2, l_orderkey, CAST(NULL AS VARCHAR),
         CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         CAST(l_quantity AS DOUBLE), l_suppkey
  FROM lineitem)"""

DOC_POSTS_CTE = """dposts AS (
  SELECT doc_id AS Id, 1 AS PostTypeId,
         '<' || lang || '><' || source || '>' AS Tags, text AS Text
  FROM documents)"""


def clean_tags(col: str) -> str:
    return f"regexp_replace(regexp_replace({col}, '><', ' ', 'g'), '<|>', '', 'g')"


def tag_list(col: str) -> str:
    return f"string_split({clean_tags(col)}, ' ')"


def tag_array(col: str) -> str:
    return f"regexp_extract_all({col}, '<([^<>]+)>', 1)"


def md5_int(expr: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT)"


def md5_bucket(expr: str, n: int) -> str:
    return f"CAST({md5_int(expr)} % {n} AS INTEGER)"


def md5_unit(expr: str) -> str:
    return f"({md5_int(expr)} / 4294967296.0)"


USER_TAG_SCORE_CTE = f"""{POSTS_CTE},
qa AS (SELECT a.OwnerUserId, a.Score, q.Tags
       FROM posts a JOIN posts q ON a.ParentId = q.Id),
uts AS (SELECT OwnerUserId AS UserId, TagId, sum(Score) AS TotalScore
        FROM (SELECT OwnerUserId, Score, unnest({tag_list('Tags')}) AS TagId FROM qa)
        GROUP BY OwnerUserId, TagId)"""
