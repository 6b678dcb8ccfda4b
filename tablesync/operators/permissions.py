"""Page permissions: local group ids to names for a snapshot, and names back to ids on apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The built-in roles and the codes of the permission levels.
ROLES = ("Anonymous", "AuthenticatedBackend", "AuthenticatedFrontend", "Administrator")
LEVELS = {"none": 1, "read": 4, "edit": 20, "create": 84, "delete": 340, "all": 1364}


def _is_role(owner: Column) -> Column:
    return F.lower(owner).isin(*[r.lower() for r in ROLES])


def export_permissions(perms: DataFrame, groups: DataFrame, levels: dict[str, int] = LEVELS) -> DataFrame:
    """``perms(page_id, owner_id, level_value)`` → owner name and type, level name.

    The owner is a role, or a group given by id; an unknown group keeps its raw id as its name.
    """
    named = groups.where(F.col("name") != "").groupBy(F.col("group_id").alias("_gid")).agg(F.min("name").alias("_name"))
    level = F.col("level_value").cast("string")
    for name, code in levels.items():
        level = F.when(F.col("level_value") == code, name).otherwise(level)
    rules = perms.withColumn("_id", F.when(~_is_role(F.col("owner_id")), F.col("owner_id").try_cast("int")))
    # Roles and owners that are no number skip the lookup; they would all meet in one partition.
    found = rules.where("_id is not null").join(named, F.col("_id") == F.col("_gid"), "left").drop("_gid")
    others = rules.where("_id is null").withColumn("_name", F.lit(None).cast("string"))
    is_role = F.coalesce(_is_role(F.col("owner_id")), F.lit(False))
    return found.unionByName(others).select(
        "page_id",
        F.when(is_role, F.col("owner_id")).otherwise(F.coalesce("_name", "owner_id")).alias("owner"),
        F.when(is_role, "role").otherwise("group").alias("owner_type"),
        F.when(~is_role, F.col("owner_id")).alias("owner_id"),
        level.alias("level"),
        "level_value",
    )


def import_permissions(perms: DataFrame, groups: DataFrame, order: str, levels: dict[str, int] = LEVELS):
    """Rules to set per page, from ``perms(page_id, owner, owner_type, level, level_value, <order>)``.

    Roles keep their name, groups are found by name without case (of equal names the lowest id).
    A rule for an unknown group is dropped and its page denies Anonymous instead. A level name that
    is not known falls back to the number. Of several rules for one owner the last one counts.
    Returns (rules, warnings).
    """
    ids = groups.where(F.col("name") != "").groupBy(F.lower("name").alias("_n")).agg(F.min("group_id").alias("_gid"))
    value = F.col("level_value")
    for name, code in levels.items():
        value = F.when(F.lower("level") == name, code).otherwise(value)
    rules = perms.where(F.lower("owner_type").isin("role", "group")).withColumn("_value", value)
    role = F.lower("owner_type") == "role"
    # Roles skip the lookup.
    as_group = rules.where(~role).join(ids, F.lower("owner") == F.col("_n"), "left")
    known = as_group.where("_gid is not null").select("page_id", F.col("_gid").cast("string").alias("owner"), "_value", order)
    roles = rules.where(role).select("page_id", "owner", "_value", order)
    unknown = as_group.where("_gid is null")
    denied = (
        unknown.select("page_id")
        .distinct()
        .select("page_id", F.lit("Anonymous").alias("owner"), F.lit(levels["none"]).alias("_value"))
    )
    stated = roles.unionByName(known).withColumn("_deny", F.lit(0))
    fallback = denied.withColumn(order, F.lit(None).cast(perms.schema[order].dataType)).withColumn("_deny", F.lit(1))
    final = (
        stated.unionByName(fallback)
        .groupBy("page_id", F.lower("owner").alias("_o"))
        .agg(F.max_by(F.struct("owner", "_value"), F.struct("_deny", order)).alias("_r"))
        .select("page_id", F.col("_r.owner").alias("owner"), F.col("_r._value").cast("int").alias("level_value"))
    )
    warnings = unknown.groupBy(F.col("owner").alias("group_name")).agg(F.count("*").alias("n")).withColumn(
        "warning", F.concat(F.lit("group '"), F.col("group_name"), F.lit("' not found on target"))
    )
    return final, warnings
