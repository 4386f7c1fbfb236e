"""Taking documents out of a table by their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frontier.session import cut_lineage

#: Ids that are broadcast; more are joined by a shuffle.
MAX_BROADCAST_IDS = 1 << 20


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``ids``; rows with a null id
    stay. The list is written and counted first: within the bound it is broadcast, and the
    texts aren't shuffled."""
    gone = cut_lineage(ids.toDF("__llm_id").where("__llm_id IS NOT NULL").distinct())
    side = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone
    return docs.join(side, docs[id_col] == side["__llm_id"], "left_anti")
