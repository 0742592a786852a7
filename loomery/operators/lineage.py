"""Families of records: named subject, root ancestor, or the id without its version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomery.functions.scalars import strip_version, truthy
from loomery.sources.shared import checkpointed


def own_family(record_id: Column, subject: Column, parent: Column) -> Column:
    return F.coalesce(truthy(subject), truthy(parent), strip_version(record_id))


def _doubled(state: DataFrame) -> DataFrame:
    """(id, at, done): pointers followed until they are done, or for more steps than there are nodes."""
    state, length = checkpointed(state), 1
    size = state.count()
    # after a round every open node has jumped twice as far; beyond the number of nodes it can only be in a circle
    while length <= size and state.where("not done").limit(1).count():
        jump = state.select(F.col("id").alias("_id"), F.col("at").alias("_at"), F.col("done").alias("_done"))
        moved = state.where("not done").join(jump, F.col("at") == F.col("_id")).select("id", F.col("_at").alias("at"), F.col("_done").alias("done"))
        state, length = checkpointed(state.where("done").unionByName(moved)), 2 * length
    return state


def roots(edges: DataFrame) -> DataFrame:
    """(id, root) for every row of ``edges`` (id, parent; ids unique).

    The root is the first ancestor without a parent in the data, or where the
    chain runs in a circle the first node met twice: a circle's node is its own
    root, and a node before a circle has the one where it enters. Pointer doubling
    settles chains, however long, in the logarithm of their length. What is open
    after more steps than there are nodes points into a circle, and at all of its
    nodes; these end the chains of a second doubling.
    """
    start = edges.where(truthy(F.col("parent")).isNotNull()).select("id", "parent")
    known = start.select(F.col("id").alias("_k"))
    state = _doubled(start.join(known, F.col("parent") == F.col("_k"), "left").select("id", F.col("parent").alias("at"), F.col("_k").isNull().alias("done")))
    ended, stuck = state.where("done").select("id", F.col("at").alias("root")), state.where("not done")
    if stuck.isEmpty():
        return ended
    circle = checkpointed(stuck.select(F.col("at").alias("id")).distinct())
    before = start.join(stuck.select("id"), "id", "left_semi").join(circle, "id", "left_anti")
    entry = circle.select(F.col("id").alias("_c"))
    walked = _doubled(before.join(entry, F.col("parent") == F.col("_c"), "left").select("id", F.col("parent").alias("at"), F.col("_c").isNotNull().alias("done")))
    return ended.unionByName(circle.select("id", F.col("id").alias("root"))).unionByName(walked.select("id", F.col("at").alias("root")))


def families(records: DataFrame) -> DataFrame:
    """(id, family). A derived record takes its root's family, or the root's stripped id where that isn't in the data."""
    flat = records.select("id", F.col("identity.subject_name").alias("subject"), F.col("lineage.derived_from_record_id").alias("parent"))
    of = roots(flat.select("id", "parent"))
    ancestor = flat.select(F.col("id").alias("root"), own_family(F.col("id"), F.col("subject"), F.col("parent")).alias("root_family"))
    derived = of.join(ancestor, "root", "left").select(F.col("id").alias("_id"), F.coalesce("root_family", strip_version(F.col("root"))).alias("derived"))
    return flat.join(derived, F.col("id") == F.col("_id"), "left").select("id", F.coalesce("derived", own_family(F.col("id"), F.col("subject"), F.col("parent"))).alias("family"))
