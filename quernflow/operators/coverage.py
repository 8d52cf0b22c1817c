"""Coverage roll-ups: features in groups, the funnel of a report, source lines, summaries of maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.functions.text import percent


def feature_coverage(pool: DataFrame, candidates: DataFrame, ready: DataFrame) -> DataFrame:
    """``pool`` with (status, candidate_group_count, ready_group_count) from groups with ``source_feature_uids``."""
    counted = lambda g, name: g.select(F.explode("source_feature_uids").alias("feature_uid")).groupBy("feature_uid").agg(F.count("*").alias(name))
    out = pool.join(counted(candidates, "candidate_group_count"), "feature_uid", "left").join(counted(ready, "ready_group_count"), "feature_uid", "left")
    out = out.fillna(0, ["candidate_group_count", "ready_group_count"])
    status = F.when(F.col("ready_group_count") > 0, "ready_covered").when(F.col("candidate_group_count") > 0, "candidate_only").otherwise("never_sampled")
    return out.withColumn("status", status)


def coverage_counts(coverage: DataFrame, candidates: DataFrame, ready: DataFrame, eligible: DataFrame) -> DataFrame:
    """One row of counts and ratios of a feature coverage; ``eligible`` has the feature_uid of eligible features."""
    uids = lambda g: g.select(F.explode("source_feature_uids").alias("feature_uid")).distinct()
    marks = eligible.select("feature_uid").distinct().withColumn("e", F.lit(True))
    for name, g in (("c", candidates), ("r", ready)):
        marks = marks.join(uids(g).withColumn(name, F.lit(True)), "feature_uid", "full")
    has = lambda *names: F.count_if(F.coalesce(*[F.col(names[0])], F.lit(False)) if len(names) == 1 else F.coalesce(F.col(names[0]) & F.col(names[1]), F.lit(False)))
    sets = marks.agg(has("e").alias("eligible_feature_pool_records"), has("c").alias("candidate_covered_features"), has("e", "c").alias("eligible_candidate_covered_features"), has("r").alias("ready_covered_features"), has("e", "r").alias("eligible_ready_covered_features"))
    by = coverage.agg(F.count("*").alias("feature_pool_records"), *[F.count_if(F.col("status") == s).alias(n) for s, n in (("candidate_only", "candidate_only_features"), ("never_sampled", "never_sampled_features"))], F.count_if(F.col("status") != "ready_covered").alias("uncovered_features"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 4)).otherwise(F.lit(0.0))
    return by.crossJoin(sets).withColumns(
        {
            "ready_coverage_of_full_pool": ratio("ready_covered_features", "feature_pool_records"),
            "ready_coverage_of_eligible_pool": ratio("eligible_ready_covered_features", "eligible_feature_pool_records"),
            "candidate_coverage_of_full_pool": ratio("candidate_covered_features", "feature_pool_records"),
            "candidate_coverage_of_eligible_pool": ratio("eligible_candidate_covered_features", "eligible_feature_pool_records"),
        }
    )


def source_coverage(lines: DataFrame, functions: DataFrame, branches: DataFrame) -> DataFrame:
    """(file, lines/functions/branches total and covered) from counts of many runs: (file, line, count), (file, name, count),
    (file, line, idx, count). A unit is covered where any run counted it; two aggregations and no sets."""
    parts = []
    for name, table, key in (("lines", lines, ["line"]), ("functions", functions, ["name"]), ("branches", branches, ["line", "idx"])):
        one = table.groupBy("file", *key).agg(F.max("count").alias("top"))
        parts.append(one.groupBy("file").agg(F.count("*").alias(f"{name}_total"), F.count_if(F.col("top") > 0).alias(f"{name}_covered")))
    out = parts[0].join(parts[1], "file", "full").join(parts[2], "file", "full")
    return out.fillna(0)


def coverage_totals(files: DataFrame) -> DataFrame:
    names = [f"{a}_{b}" for a in ("lines", "functions", "branches") for b in ("total", "covered")]
    out = files.agg(F.count("*").alias("files_total"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return out.withColumns({f"{one}_coverage_percent": percent(F.col(f"{many}_covered"), F.col(f"{many}_total")) for one, many in (("line", "lines"), ("function", "functions"), ("branch", "branches"))})


def edge_summary(entries: DataFrame, value: str = "edge_map_entries") -> DataFrame:
    """min, max, avg and median (one decimal) of map sizes; zeros for none."""
    zero = F.lit(0)
    return entries.agg(
        F.coalesce(F.min(value), zero).alias("min"), F.coalesce(F.max(value), zero).alias("max"),
        F.coalesce(F.round(F.avg(value), 1), F.lit(0.0)).alias("avg"), F.coalesce(F.round(F.median(value), 1), F.lit(0.0)).alias("median"),
    )


def funnel(groups: DataFrame, instantiations: DataFrame, evaluations: DataFrame) -> DataFrame:
    """One row from ready groups to covered programs, with the rates of each step in percent.

    ``groups`` (group_uid, language), ``instantiations`` (group_uid, status), ``evaluations`` (status)."""
    g = groups.join(instantiations.select("group_uid").distinct().withColumn("sel", F.lit(True)), "group_uid", "left")
    a = g.agg(F.count("*").alias("ready_groups"), F.count_if(F.col("language").isin("c", "c++")).alias("c_cpp_ready_groups"), F.count_if(F.coalesce("sel", F.lit(False))).alias("selected_groups"))
    b = instantiations.agg(F.count_if(F.col("status") == "ready").alias("instantiated_ready"))
    c = evaluations.agg(F.count_if(F.col("status") == "covered").alias("covered"))
    out = a.crossJoin(b).crossJoin(c)
    steps = {"selection_rate": ("selected_groups", "c_cpp_ready_groups"), "generation_rate": ("instantiated_ready", "selected_groups"), "covered_rate": ("covered", "instantiated_ready"), "end_to_end_rate": ("covered", "selected_groups"), "overall_rate": ("covered", "ready_groups")}
    return out.withColumns({name: percent(F.col(x), F.col(y)) for name, (x, y) in steps.items()})


def histograms(df: DataFrame, *keys: str) -> DataFrame:
    """(dimension, value, n): counts by each key on its own, in one pass over the rows by grouping sets."""
    view = df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("unknown")).alias(k) for k in keys])
    out = view.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(F.count("*").alias("n"), *[F.grouping(k).alias(f"g_{k}") for k in keys])
    which, value = None, None
    for k in keys:
        hit = F.col(f"g_{k}") == 0
        which = F.when(hit, k) if which is None else which.when(hit, k)
        value = F.when(hit, F.col(k)) if value is None else value.when(hit, F.col(k))
    return out.select(which.alias("dimension"), value.alias("value"), "n")


def ice_candidates(evaluations: DataFrame, groups: DataFrame) -> DataFrame:
    """Evaluations that ended in a compiler error, with the bugs behind their group and a signature of their messages."""
    from quernflow.functions.text import last_lines, stderr_signature

    hit = evaluations.where("evaluation_status = 'ice'")
    bugs = groups.groupBy("candidate_id").agg(F.max_by("source_bug_ids", "pos").alias("source_bug_ids"))
    out = hit.join(bugs, "candidate_id", "left")
    return out.select("candidate_id", "instantiation_id", F.coalesce("source_bug_ids", F.array().cast("array<bigint>")).alias("source_bug_ids"), stderr_signature(F.col("stderr")).alias("stderr_signature_sha256"), F.right(last_lines(F.col("stderr")), F.lit(2000)).alias("stderr_tail"))
