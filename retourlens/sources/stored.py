"""Tables stored by row id, so that joins by id need no shuffle of what is stored."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from retourlens.session import scratch_path



def store_by_id(df: DataFrame, name: str, buckets: int, id: str = "order_item_id") -> DataFrame:
    """``df`` as a table of ``buckets`` files, dealt by the hash of ``id`` and sorted by it.

    Rows move once, when they are stored. Two tables with the same number of
    buckets are joined by ``id`` where they lie, and an aggregation by ``id`` is
    finished in each bucket; a table joined to one with fewer rows has only the
    other side moved to it. Null ids are stored too. The files lie in the shared
    folder; the session's catalogue knows the table by a name of its own.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, id)
    dealt.write.bucketBy(buckets, id).sortBy(id).option("path", scratch_path(df.sparkSession, name)).saveAsTable(table)
    return df.sparkSession.table(table)
