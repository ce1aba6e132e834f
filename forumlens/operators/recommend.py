"""Expert recommendation for predicted tags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from forumlens.operators.scores import top_experts


def recommend_users(predicted: DataFrame, scores: DataFrame, k: int = 3,
                    post: str = "Id", tag: str = "TagId") -> DataFrame:
    """For each predicted (post, tag): the tag's k best users.

    The k-per-tag table is computed once (bounded by k x tags) and joined to
    the predictions on the tag, so no post ever meets every user of a tag.
    Output ``(Id, TagId, UserId, TotalScore, rank)``.
    """
    top = top_experts(scores, k, tag=tag)
    return (predicted.select(post, tag).join(top, tag)
            .select(post, tag, "UserId", "TotalScore", "rank"))
