"""Expressions on model scores and inference responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ledgerlens.contract import SCORE_EDGES, SCORE_LABELS, UNSCORED


def score_from_response(response: Column) -> Column:
    """First prediction of a JSON response: a plain number or ``fraud_probability``."""
    plain = F.get_json_object(response, "$.predictions[0]").try_cast("double")
    named = F.get_json_object(response, "$.predictions[0].fraud_probability").try_cast("double")
    return F.coalesce(plain, named)


def over_threshold(score: Column, threshold: float = 0.5, inclusive: bool = False) -> Column:
    """Flagging is strict (``>``); evaluation passes ``inclusive=True``."""
    return score >= threshold if inclusive else score > threshold


def bucketize(
    value: Column,
    edges: Sequence[float] = SCORE_EDGES,
    labels: Sequence[str] = SCORE_LABELS,
    missing: str = UNSCORED,
) -> Column:
    """Label of the interval holding ``value``; an edge belongs to the upper interval."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    chain = F.when(value.isNull(), missing)
    for edge, label in zip(edges, labels):
        chain = chain.when(value < edge, label)
    return chain.otherwise(labels[-1])


def traffic_arm(
    record_id: Column,
    champion_share: int = 90,
    champion: str = "champion",
    challenger: str | None = "challenger",
) -> Column:
    """Model a record is routed to: fixed per id, independent of order and run.

    Without a challenger the champion takes all traffic.
    """
    if challenger is None:
        return F.lit(champion)
    digest = F.md5(record_id.cast("string").cast("binary"))
    slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return F.when(slot < champion_share, champion).otherwise(challenger)
