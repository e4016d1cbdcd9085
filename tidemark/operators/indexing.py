"""Dense indexes over ids, as training tables need them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import Ranges, dense_index
from tidemark.session import materialise

def index_interactions(
    rows: DataFrame, user: str, creator: str, cap: int | None = None, ranges: Ranges = Ranges()
) -> DataFrame:
    """``rows`` with ``user_index`` and ``creator_index``, both from 0 in id order.

    With a ``cap``, users numbered beyond it go first, and creators are numbered over the remaining rows.
    """
    numbered = dense_index(rows, user, "user_index", ranges)
    users = materialise(numbered if cap is None else numbered.where(F.col("user_index") <= cap), "users")
    kept = rows.join(users, user)
    return kept.join(dense_index(kept, creator, "creator_index", ranges), creator)
