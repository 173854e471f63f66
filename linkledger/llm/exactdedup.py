"""Exact de-duplication with a heavy-hitter split, in DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. A frequent-items sketch (Misra-Gries
counters, merged over tasks) proposes digests; an exact count verifies them. A digest that
holds more than one row in ``SHARE`` is a winner: at most ``SHARE`` rows, broadcast, and its
rows are settled map-side without moving. Every other group has at most one row in ``SHARE``
and takes the ordinary shuffle, so no task gets a group that grows into a hot spot.

Defined cases: null text counts as empty; a null doc_id loses against any other and is kept
only in a group without ids; of repeated rows (same id and text) exactly one is kept; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from linkledger.llm.common import ascii_lower, landed

#: A digest with more than one row in SHARE is settled map-side.
SHARE = 1024
#: Counters of the sketch. It overestimates by less than rows / (0.75 * COUNTERS), so every digest above one in SHARE is among its first SHARE * 2.
COUNTERS = 8192


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digest = F.sha2(ascii_lower(F.col(text_col)), 256)
    rows = landed(
        docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"), F.monotonically_increasing_id().alias("rid")),
        "digests",
    )
    proposed = rows.agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(digest, {SHARE * 2}, {COUNTERS})").alias("top")
    ).select("n", F.explode("top").alias("t")).select("n", F.col("t.item").alias("digest"))
    best = F.max(F.struct("doc_id", "rid")).alias("best")
    winners = landed(
        rows.join(F.broadcast(proposed), "digest").groupBy("digest", "n").agg(F.count("*").alias("group_size"), best)
        .where(F.col("group_size") * SHARE > F.col("n")).select("digest", "group_size", "best"),
        "winners",
    )
    heavy = rows.join(F.broadcast(winners), "digest")
    group = W.partitionBy("digest")
    light = rows.join(F.broadcast(winners), "digest", "left_anti").select(
        "digest", "doc_id", "rid", F.count("*").over(group).alias("group_size"),
        F.max(F.struct("doc_id", "rid")).over(group).alias("best"),
    )
    return heavy.select(light.columns).unionByName(light).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"), F.col("digest").alias("text_sha256"),
    )

