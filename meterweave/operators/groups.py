"""Group tree: checks, resolution to meters, portfolio.

Tables: meters(meter_id), groups(name), group_members(group_name, meter_id),
group_children(parent, child). Only the tree of groups is walked; its size is
that of the configuration. Meters are joined to it once, at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterweave import schema


#: Depth that a tree of groups may have.
LEVELS = 1000


def descendants(group_children: DataFrame) -> DataFrame:
    """All pairs (parent, child) connected by one or more steps.

    A recursive query that walks on from a group until it meets one that is
    already on its path. A cycle so shows as a pair (a, a) and does not prevent
    the end. Nothing runs before the result is read.
    """
    edges = group_children.select("parent", "child").where("parent is not null and child is not null").distinct()
    walked = edges.sparkSession.sql(
        """
        WITH RECURSIVE reach(parent, child, path, again) MAX RECURSION LEVEL {levels} AS (
            SELECT parent, child, array(parent, child), parent = child FROM {edges}
            UNION ALL
            SELECT r.parent, e.child, array_append(r.path, e.child), array_contains(r.path, e.child)
            FROM reach r JOIN {edges} e ON r.child = e.parent WHERE NOT r.again
        )
        SELECT DISTINCT parent, child FROM reach
        """,
        edges=edges, levels=LEVELS,
    )
    return walked


def shared_ids(meters: DataFrame, names: DataFrame) -> DataFrame:
    """(id, n): ids that n > 1 kinds of entity have, of meters, groups and the portfolio."""
    name = F.col(names.columns[0])
    reserved = names.sparkSession.createDataFrame([(schema.PORTFOLIO_ID,)], "id string")
    return (
        meters.select(F.col("meter_id").alias("id")).where("id is not null").distinct()
        .unionByName(names.select(name.alias("id")).where("id is not null").distinct())
        .unionByName(reserved)
        .groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )


def group_tree_check(
    meters: DataFrame, groups: DataFrame, group_members: DataFrame, group_children: DataFrame
) -> DataFrame:
    """Findings (severity, message, section, n) on the group tables.

    A cycle is a path that returns to its start; a group that is reached on two
    paths is none. Meters, groups and the portfolio share one space of ids.
    """
    known = meters.select("meter_id").where("meter_id is not null").distinct()
    named = groups.select("name").where("name is not null").distinct()

    def finding(rows: DataFrame, message, section: str) -> DataFrame:
        return rows.select(
            F.lit(schema.ERROR).alias("severity"), message.alias("message"), F.lit(section).alias("section"),
            F.col("n").cast("long").alias("n"),
        )

    def text(pattern: str, *cols: str):
        return F.format_string(pattern, *cols)

    missing_id = meters.where("meter_id is null").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    doubled = (
        meters.where("meter_id is not null").groupBy("meter_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    unnamed = groups.where("name is null").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    strangers = (
        group_members.where("group_name is not null").join(known, "meter_id", "left_anti")
        .groupBy("group_name", "meter_id").agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = (
        group_children.where("parent is not null")
        .join(named.withColumnRenamed("name", "child"), "child", "left_anti")
        .groupBy("parent", "child").agg(F.count(F.lit(1)).alias("n"))
    )
    selves = group_children.where("parent = child").groupBy("parent").agg(F.count(F.lit(1)).alias("n"))
    names = named.unionByName(group_members.select(F.col("group_name").alias("name"))).unionByName(
        group_children.select(F.col("parent").alias("name"))
    )
    cycles = descendants(group_children.where("parent <> child")).where("parent = child").withColumn("n", F.lit(1))
    return (
        finding(missing_id, F.lit("A meter entry is missing meter_id"), "meters")
        .unionByName(finding(doubled, text("Duplicate meter_id: %s", "meter_id"), "meters"))
        .unionByName(finding(unnamed, F.lit("A group entry is missing name"), "meter_groups"))
        .unionByName(
            finding(strangers, text("Group '%s' references unknown meter_id '%s'", "group_name", "meter_id"), "meter_groups")
        )
        .unionByName(
            finding(orphans, text("Group '%s' references unknown child group '%s'", "parent", "child"), "meter_groups")
        )
        .unionByName(finding(selves, text("Group '%s' lists itself as a child group", "parent"), "meter_groups"))
        .unionByName(finding(cycles, text("Cyclic group hierarchy involving '%s'", "parent"), "meter_groups"))
        .unionByName(finding(shared_ids(known, names), text("Several kinds of entity have the id '%s'", "id"), "meter_groups"))
    )


def resolve_groups(group_members: DataFrame, group_children: DataFrame) -> DataFrame:
    """(group_name, meter_id): own members and those of all descendants, each meter once per group.

    Reading the result fails if a group is its own descendant.
    """
    reach = descendants(group_children)
    cycle = F.raise_error(F.concat(F.lit("cyclic group hierarchy at "), "parent")).cast("string")
    parent = F.when(F.col("parent") == F.col("group_name"), cycle).otherwise(F.col("parent"))
    # Cycles meet no members when they have none: they are checked on the pairs themselves.
    sound = reach.withColumnRenamed("child", "group_name").withColumn("parent", parent)
    looped = sound.where("parent is null").select(F.col("parent").alias("group_name"), F.lit(None).cast("string").alias("meter_id"))
    inherited = group_members.join(sound, "group_name").select(F.col("parent").alias("group_name"), "meter_id")
    return group_members.select("group_name", "meter_id").unionByName(inherited).unionByName(looped).distinct()


def portfolio_members(meters: DataFrame, excluded: DataFrame) -> DataFrame:
    """All meters without the excluded ones."""
    return (
        meters.select("meter_id").where("meter_id is not null").distinct()
        .join(excluded.select("meter_id"), "meter_id", "left_anti")
    )


def entity_members(
    meters: DataFrame, resolved: DataFrame, portfolio: DataFrame
) -> DataFrame:
    """(entity_id, entity_type, meter_id) for meters, groups and the portfolio.

    An id that two kinds of entity share would merge their series; reading the
    result then fails. group_tree_check reports such ids.
    """

    def entity(rows: DataFrame, name, kind: str) -> DataFrame:
        return rows.select(name.alias("entity_id"), F.lit(kind).alias("entity_type"), "meter_id")

    listed = meters.where("meter_id is not null").select("meter_id").distinct()
    clash = F.raise_error(F.concat(F.lit("several kinds of entity have the id "), "id")).cast("string")
    return (
        entity(listed, F.col("meter_id"), schema.METER)
        .unionByName(entity(resolved, F.col("group_name"), schema.GROUP))
        .unionByName(entity(portfolio, F.lit(schema.PORTFOLIO_ID), schema.PORTFOLIO))
        .unionByName(entity(shared_ids(listed, resolved.select("group_name")).withColumn("meter_id", F.col("id")), clash, schema.METER))
    )
