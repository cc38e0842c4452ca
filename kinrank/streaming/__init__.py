"""Streaming entry points.

The reference has no streaming operators. What a stream adds here is a
growing ratings source: ``ratings_stream`` reads new ratings files as they
arrive; ``running_user_stats`` keeps per-user count/sum/mean current, and
``running_rater_quality`` keeps the constant-rater flag (C1) current, both as
stateful streaming aggregates whose state per user is a few numbers.
"""

from kinrank.streaming.ratings import (  # noqa: F401
    ratings_stream,
    running_rater_quality,
    running_user_stats,
)
