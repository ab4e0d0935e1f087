"""Distinct counts of nested identities without the multi-distinct Expand.

Sessions are nested inside users (a session is a user × hour), so "distinct sessions" and
"distinct users" per group come from two stacked aggregations:

1. group by (keys, user): countDistinct(session) + per-user sums. One distinct column only,
   so Spark plans it without Expand: partial aggregate on (keys, user, session) → exchange on
   (keys, user, session) → exchange on (keys, user); a hot user is collapsed map-side before
   any shuffle.
2. group by keys: sum of per-user session counts, count of users, sums.

This replaces Spark's Expand rewrite for two COUNT(DISTINCT ..) (which triples the rows
before the first partial aggregate) and stays exact: a session key never spans two users.

When the session is identified inside its user by a small slot number (0..63, e.g. the hour
of day), step 1 needs no distinct at all: the slots a user touched are OR-ed into one 64-bit
mask (``bit_or(1 << slot)``, an ordinary mergeable aggregate) and counted with
``bit_count``. That removes the first exchange of the single-distinct plan (one exchange on
(keys, user) instead of two); the partial aggregate carries 8 bytes per (keys, user).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions_and_users(df: DataFrame, keys: Sequence[str], user: str = "user_id",
                       session: str = "session_key", sums: Mapping[str, Column] | None = None,
                       sessions_name: str = "sessions", users_name: str = "users",
                       session_slot: str | None = None) -> DataFrame:
    """Per group of ``keys``: COUNT(DISTINCT session), COUNT(DISTINCT user) and SUM(expr)s.

    ``session_slot`` (optional) names an integer column in [0, 63] that identifies the
    session within its user (session ↔ (user, slot) one to one); a NULL slot marks a NULL
    session. NULL users and NULL sessions are not counted, as in SQL COUNT(DISTINCT).
    """
    sums = dict(sums or {})
    if session_slot is not None:
        mask = F.bit_or(F.expr(f"shiftleft(CAST(1 AS BIGINT), `{session_slot}`)"))
        n_sessions = F.coalesce(F.bit_count(mask), F.lit(0)).cast("bigint")
    else:
        n_sessions = F.countDistinct(session)
    per_user = (df.groupBy(*keys, user)
                  .agg(n_sessions.alias("_n_sessions"),
                       *[F.sum(expr).alias(name) for name, expr in sums.items()]))
    return (per_user.groupBy(*keys)
                    .agg(F.sum(F.when(F.col(user).isNotNull(), F.col("_n_sessions"))
                                .otherwise(F.lit(0))).cast("bigint").alias(sessions_name),
                         F.count(user).alias(users_name),
                         *[F.sum(name).cast("bigint").alias(name) for name in sums]))
