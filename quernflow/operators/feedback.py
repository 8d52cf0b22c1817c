"""Coverage feedback: first-seen novelty of edges, running unions, rewards of features, promoted glue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernflow.operators.windows import running_sum


def edge_sets(edges: DataFrame, seq: str = "seq", edge: str = "edge_id") -> DataFrame:
    """Distinct (seq, edge): a map is a set of edge ids, whatever its counts."""
    return edges.select(seq, edge).distinct()


def edge_novelty(edges: DataFrame, seq: str = "seq", edge: str = "edge_id") -> DataFrame:
    """(seq, edge_entries, new_edges, new_edge_ratio, union_edges_after): what each map adds to those before it.

    An edge is new where it is first seen, so one minimum by edge replaces the walk over all maps; the running union is
    summed by ranges of maps (``windows.running_sum``).
    """
    sets = edge_sets(edges, seq, edge)
    new = sets.groupBy(edge).agg(F.min(seq).alias(seq)).groupBy(seq).agg(F.count("*").alias("new_edges"))
    out = sets.groupBy(seq).agg(F.count("*").alias("edge_entries")).join(new, seq, "left")
    out = out.withColumn("new_edges", F.coalesce("new_edges", F.lit(0)))
    ratio = F.when(F.col("edge_entries") == 0, F.lit(0.0)).otherwise(F.round(F.col("new_edges") / F.col("edge_entries"), 6))
    out = running_sum(out.withColumn("new_edge_ratio", ratio), seq, "new_edges", "union_edges_after")
    return out.select(seq, "edge_entries", "new_edges", "new_edge_ratio", "union_edges_after")


def resolve_groups(evaluations: DataFrame, groups: DataFrame) -> DataFrame:
    """Evaluations with their group's columns, found by group_uid or, failing that, by candidate_id; others are left out.

    A key that stands for several groups takes the last one by ``pos``, as in a table that later rows overwrite.
    """
    keys = groups.select(F.explode(F.array("group_uid", "candidate_id")).alias("key"), "pos", F.struct(*[c for c in groups.columns if c != "pos"]).alias("group"))
    keys = keys.where("key is not null and key <> ''").groupBy("key").agg(F.max_by("group", "pos").alias("group"))
    first = keys.select(F.col("key").alias("k1"), F.col("group").alias("g1"))
    second = keys.select(F.col("key").alias("k2"), F.col("group").alias("g2"))
    out = evaluations.join(first, evaluations["group_uid"] == F.col("k1"), "left").join(second, evaluations["candidate_id"] == F.col("k2"), "left")
    return out.select(*[evaluations[c] for c in evaluations.columns], F.coalesce("g1", "g2").alias("group")).where("group is not null")


def feature_rewards(rows: DataFrame) -> DataFrame:
    """Rewards by feature from rows (source_feature_uids, edge_entries, new_edges, candidate_ids, group_uids).

    New edges are shared equally among a row's features, repeats counted; the sum is rounded before it is scored.
    """
    n = F.size("source_feature_uids")
    share = F.when(n == 0, F.lit(0.0)).otherwise(F.col("new_edges") / n)
    long = rows.withColumn("share", share).select(F.explode("source_feature_uids").alias("feature_uid"), "edge_entries", "new_edges", "share", "candidate_ids", "group_uids")
    total = F.round(F.sum("share"), 3)
    out = long.groupBy("feature_uid").agg(
        F.count("*").alias("covered_group_count"),
        F.count_if(F.col("new_edges") > 0).alias("novel_group_count"),
        F.sum("edge_entries").alias("edge_entries_sum"),
        total.alias("new_edges_sum"),
        F.max("new_edges").alias("max_group_new_edges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("candidate_ids")))).alias("candidate_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("group_uids")))).alias("group_uids"),
    )
    return out.withColumn("reward_score", reward_score())


def reward_score() -> Column:
    return F.round(F.col("new_edges_sum") + 25.0 * F.col("novel_group_count") + 0.001 * F.col("edge_entries_sum"), 3)


def novel_glue(rows: DataFrame) -> DataFrame:
    """Glue features of groups that added edges, from rows (group struct with glue_features, new_edges, edge_entries)."""
    hit = rows.where("new_edges > 0").select("group.group_uid", "group.candidate_id", "new_edges", "edge_entries", F.explode("group.glue_features").alias("g"))
    reason = F.lit("parent group produced AFL union-edge gain").alias("promotion_reason")
    return hit.select("group_uid", "candidate_id", "g.*", "new_edges", "edge_entries", reason)


def native_sources(runs: DataFrame, groups: DataFrame) -> DataFrame:
    """(native_run_id, source_feature_uids): a run's own list, else what its groups and candidates stand for, sorted."""
    own = F.array_sort(F.array_distinct(F.filter("source_feature_uids", lambda x: x != "")))
    keys = runs.select("native_run_id", F.explode(F.concat("group_uids", "candidate_ids")).alias("key"))
    index = groups.select(F.explode(F.array("group_uid", "candidate_id")).alias("key"), "pos", "source_feature_uids").groupBy("key").agg(F.max_by("source_feature_uids", "pos").alias("uids"))
    found = keys.join(index, "key").groupBy("native_run_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("uids")))).alias("found"))
    out = runs.select("native_run_id", own.alias("own")).join(found, "native_run_id", "left")
    return out.select("native_run_id", F.when(F.size("own") > 0, F.col("own")).otherwise(F.coalesce("found", F.array().cast("array<string>"))).alias("source_feature_uids"))


def coverage_feedback(evaluations: DataFrame, groups: DataFrame, maps: DataFrame, native_runs: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole feedback: ``group_feedback``, ``feature_rewards``, ``novel_glue`` and one row of ``counts``.

    ``evaluations`` (evaluation_index, evaluation_status, group_uid, candidate_id, instantiation_id, map_id), ``maps``
    (map_id, edge_id), ``groups`` (pos, group_uid, candidate_id, source_feature_uids, glue_features), ``native_runs``
    (native_index, native_run_id, map_id, source_feature_uids, group_uids, candidate_ids); native runs come after all
    evaluations. Covered evaluations without a group count as covered and add no edges.
    """
    covered = evaluations.where("evaluation_status = 'covered'")
    known = resolve_groups(covered, groups)
    rows = known.select(
        F.concat(F.lit("0"), F.lpad(F.col("evaluation_index").cast("string"), 18, "0")).alias("seq"), F.col("evaluation_index").cast("string").alias("evaluation_index"), "map_id", "group",
        F.filter("group.source_feature_uids", lambda x: x != "").alias("source_feature_uids"),
        F.array(F.coalesce("group.candidate_id", F.lit(""))).alias("candidate_ids"), F.array(F.coalesce("group.group_uid", F.lit(""))).alias("group_uids"), F.lit("showmap").alias("feedback_source"),
    )
    if native_runs is not None:
        sources = native_sources(native_runs, groups).select("native_run_id", F.col("source_feature_uids").alias("uids"))
        some = native_runs.join(maps.select("map_id").distinct(), "map_id", "left_semi").join(sources, "native_run_id")
        rows = rows.unionByName(
            some.select(
                F.concat(F.lit("1"), F.lpad(F.col("native_index").cast("string"), 18, "0")).alias("seq"), F.concat(F.lit("native-"), "native_index").alias("evaluation_index"), "map_id",
                F.lit(None).cast(known.schema["group"].dataType).alias("group"), F.col("uids").alias("source_feature_uids"),
                F.array_sort(F.array_distinct("candidate_ids")).alias("candidate_ids"), F.array_sort(F.array_distinct("group_uids")).alias("group_uids"), F.lit("native_afl").alias("feedback_source"),
            )
        )
    edges = rows.select("seq", "map_id").join(maps, "map_id").select("seq", "edge_id")
    zero = F.lit(0)
    scored = rows.join(edge_novelty(edges).drop("union_edges_after"), "seq", "left")
    scored = scored.withColumns({"edge_entries": F.coalesce("edge_entries", zero), "new_edges": F.coalesce("new_edges", zero), "new_edge_ratio": F.coalesce("new_edge_ratio", F.lit(0.0))})
    scored = running_sum(scored, "seq", "new_edges", "union_edges_after")
    rewards = feature_rewards(scored)
    glue = novel_glue(scored.where("feedback_source = 'showmap'"))
    native = F.col("feedback_source") == "native_afl"
    counts = scored.agg(
        F.count("*").alias("groups_with_feedback"), F.count_if(F.col("new_edges") > 0).alias("novel_groups"), F.count_if(native).alias("native_runs"),
        F.count_if(native & (F.col("new_edges") > 0)).alias("native_runs_with_new_edges"), F.coalesce(F.max("union_edges_after"), zero).alias("union_edges"),
    ).crossJoin(covered.agg(F.count("*").alias("covered_evaluations"))).crossJoin(rewards.agg(F.count("*").alias("rewarded_source_features")))
    return {"group_feedback": scored, "feature_rewards": rewards.orderBy(F.desc("reward_score"), "feature_uid"), "novel_glue": glue, "counts": counts}


def map_diff(old: DataFrame, new: DataFrame, edge: str = "edge_id") -> DataFrame:
    """One row (added, lost, common) of two edge maps."""
    both = old.select(edge).distinct().withColumn("o", F.lit(True)).join(new.select(edge).distinct().withColumn("n", F.lit(True)), edge, "full")
    return both.agg(F.count_if(F.col("o").isNull()).alias("added"), F.count_if(F.col("n").isNull()).alias("lost"), F.count_if(F.col("o") & F.col("n")).alias("common"))
