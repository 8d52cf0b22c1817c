"""Groups and instantiations: structural rules, connectivity, glue ids, normalised model output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernflow.functions.text import blank, canonical_glue_id, canonical_language, string_list
from quernflow.operators.components import components

# Accepted states, modes and languages; forbidden framing of programs.
STATES = ("ready", "rejected")
MODES = ("compile_only", "execute_differential", "diagnostic", "assembly_scan", "link_test")
LANGUAGES = ("c", "c++", "fortran", "asm", "ada", "d", "cobol", "c-header", "shell", "rtl", "other", "unknown")
PROGRAM_LANGUAGES = ("c", "c++", "cpp", "cxx", "asm", "fortran", "ada", "d", "cobol", "shell", "rtl")
BAD_PURPOSE = r"(?i)\b(exploit|payload|shellcode|reverse shell|rce|network scan)\b"
MOST_SOURCE = 512 * 1024

GROUP = (
    "candidate_id string, synthesis_status string, language string, test_mode string, group_title string, group_summary string, confidence double, "
    "source_feature_uids array<string>, source_features_sha256 string, conflicts array<string>, instantiation_constraints array<string>, "
    "recommended_oracles array<string>, shared_execution_context struct<description: string>, "
    "preservation_plan array<struct<feature_uid: string, preserved_invariant: string>>, "
    "glue_features array<struct<glue_id: string, description: string, code_witness: string, semantic_role: string, connects: array<string>>>, "
    "dependencies array<struct<`from`: string, `to`: string>>"
)


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def adjacency(glue: Column, dependencies: Column) -> Column:
    """Undirected edges (src, dst) of a group as an array of structs, each way once."""
    edge = lambda a, b: F.struct(a.alias("src"), b.alias("dst"))
    from_glue = F.flatten(F.transform(glue, lambda g: F.transform(string_list(g["connects"]), lambda n: edge(g["glue_id"], n))))
    from_deps = F.transform(dependencies, lambda d: edge(d["from"], d["to"]))
    one = F.concat(from_glue, from_deps)
    return F.array_distinct(F.concat(one, F.transform(one, lambda e: edge(e["dst"], e["src"]))))


def reached(start: Column, edges: Column, steps: int = 9) -> Column:
    """Nodes within ``steps`` edges of the first: a group has at most nine nodes, so that is all it can reach."""
    grow = lambda seen, _: F.array_union(seen, F.transform(F.filter(edges, lambda e: F.array_contains(seen, e["src"])), lambda e: e["dst"]))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.array(start), grow)


def group_violations() -> Column:
    """Array of the rules that a row breaks, in the order in which they are checked; empty for a sound group.

    The row has the columns of ``GROUP`` and ``want``, the candidate as a struct (candidate_id, source_feature_uids,
    source_features_sha256). A rejected group need only carry conflicts; ready ones must satisfy everything.
    """
    c = F.col
    uids, want = F.coalesce(c("want.source_feature_uids"), _empty("array<string>")), c("want")
    glue = F.coalesce(c("glue_features"), _empty("array<struct<glue_id:string,description:string,code_witness:string,semantic_role:string,connects:array<string>>>"))
    plan = F.coalesce(c("preservation_plan"), _empty("array<struct<feature_uid:string,preserved_invariant:string>>"))
    deps = F.coalesce(c("dependencies"), _empty("array<struct<`from`:string,`to`:string>>"))
    ids = F.transform(glue, lambda g: F.coalesce(g["glue_id"], F.lit("")))
    nodes = F.array_union(uids, ids)
    planned = F.filter(F.transform(plan, lambda p: p["feature_uid"]), lambda u: F.coalesce(u, F.lit("")) != "")
    ready = c("synthesis_status") == "ready"
    seen = reached(F.try_element_at(uids, F.lit(1)), adjacency(glue, deps))
    rules = [
        (~c("candidate_id").eqNullSafe(want["candidate_id"]), "wrong_candidate_id"),
        (~F.coalesce(c("synthesis_status").isin(*STATES), F.lit(False)), "invalid_status"),
        ((F.size(F.array_distinct(uids)) != F.size(uids)) | (F.size(uids) < 2), "invalid_source_uids"),
        (~c("source_feature_uids").eqNullSafe(want["source_feature_uids"]), "source_uids_differ"),
        (~c("source_features_sha256").eqNullSafe(want["source_features_sha256"]), "source_hash_differs"),
        ((c("synthesis_status") == "rejected") & (F.size(string_list(c("conflicts"))) == 0), "rejected_without_conflict"),
        (ready & ~canonical_language(c("language")).isin(*LANGUAGES), "invalid_language"),
        (ready & ~F.coalesce(c("test_mode").isin(*MODES), F.lit(False)), "invalid_test_mode"),
        (ready & (blank(c("group_title")) | blank(c("group_summary"))), "no_title_or_summary"),
        (ready & ~F.coalesce((c("confidence") > 0) & (c("confidence") <= 1), F.lit(False)), "invalid_confidence"),
        (ready & (F.size(string_list(c("instantiation_constraints"))) == 0), "no_constraints"),
        (ready & (F.size(string_list(c("recommended_oracles"))) == 0), "no_oracles"),
        (ready & blank(c("shared_execution_context.description")), "no_shared_context"),
        (ready & ((F.size(planned) != F.size(uids)) | (F.size(F.array_union(planned, uids)) != F.size(F.array_intersect(planned, uids)))), "preservation_incomplete"),
        (ready & F.exists(plan, lambda p: blank(p["preserved_invariant"])), "preservation_without_invariant"),
        (ready & (F.size(glue) == 0), "no_glue"),
        (ready & (F.size(glue) > 4), "too_many_glue"),
        (ready & F.exists(ids, lambda i: ~i.rlike("^G[1-9][0-9]*$")), "invalid_glue_id"),
        (ready & (F.size(F.array_distinct(ids)) != F.size(ids)), "duplicate_glue_id"),
        (ready & F.exists(glue, lambda g: F.length(F.coalesce(g["code_witness"], F.lit(""))) > 4000), "glue_witness_too_large"),
        (ready & F.exists(glue, lambda g: blank(g["description"])), "glue_without_description"),
        (ready & F.exists(glue, lambda g: F.size(F.array_distinct(string_list(g["connects"]))) < 2), "glue_connects_too_few"),
        (ready & F.exists(glue, lambda g: F.exists(string_list(g["connects"]), lambda n: ~F.array_contains(nodes, n) | (n == g["glue_id"]))), "glue_unknown_node"),
        (ready & (F.size(deps) == 0), "no_dependencies"),
        (ready & F.exists(deps, lambda d: ~F.coalesce(F.array_contains(nodes, d["from"]) & F.array_contains(nodes, d["to"]) & (d["from"] != d["to"]), F.lit(False))), "invalid_dependency"),
        (ready & (F.size(F.array_except(uids, seen)) > 0), "disconnected_source"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in rules]))


def instantiation_violations() -> Column:
    """The same for an instantiation with ``want``, its group (group_uid, candidate_id, source_feature_uids)."""
    c, want = F.col, F.col("want")
    ready = c("instantiation_status") == "ready"
    uids = string_list(want["source_feature_uids"])
    ticks = F.coalesce(c("preservation_checklist"), _empty("array<struct<feature_uid:string,implemented_by:string>>"))
    ticked = F.filter(F.transform(ticks, lambda t: t["feature_uid"]), lambda u: F.coalesce(u, F.lit("")) != "")
    rules = [
        (~c("group_uid").eqNullSafe(want["group_uid"]), "wrong_group_uid"),
        (~c("candidate_id").eqNullSafe(want["candidate_id"]), "wrong_candidate_id"),
        (~F.coalesce(c("instantiation_status").isin(*STATES), F.lit(False)), "invalid_status"),
        (~F.coalesce(c("source_feature_uids") == uids, F.lit(False)), "source_uids_differ"),
        ((c("instantiation_status") == "rejected") & (F.size(string_list(c("rejection_reasons"))) == 0), "rejected_without_reason"),
        (ready & ~canonical_language(c("language")).isin(*PROGRAM_LANGUAGES), "unsupported_language"),
        (ready & blank(c("source_code")), "empty_source"),
        (ready & (F.coalesce(c("source_code"), F.lit("")).rlike(BAD_PURPOSE) | F.coalesce(c("notes"), F.lit("")).rlike(BAD_PURPOSE)), "bad_purpose"),
        (ready & (F.octet_length(F.coalesce(c("source_code"), F.lit(""))) > MOST_SOURCE), "source_too_large"),
        (ready & (F.size(string_list(c("compiler_options"))) == 0), "no_options"),
        (ready & blank(c("oracle_kind")), "no_oracle_kind"),
        (ready & ((F.size(ticked) != F.size(uids)) | (F.size(F.array_union(ticked, uids)) != F.size(F.array_intersect(ticked, uids)))), "checklist_incomplete"),
        (ready & F.exists(ticks, lambda t: blank(t["implemented_by"])), "checklist_without_implementation"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in rules]))


def rewrite_glue(glue: Column, dependencies: Column) -> tuple[Column, Column]:
    """Glue ids in canonical form and all references to them along; of several ids with one form the first keeps it."""
    pair = lambda g: F.struct(F.coalesce(g["glue_id"], F.lit("")).alias("old"), canonical_glue_id(g["glue_id"]).alias("new"))
    start = F.struct(_empty("array<string>").alias("used"), _empty("array<struct<old:string,new:string>>").alias("map"))

    def step(state, g):
        p = pair(g)
        take = p["new"].isNotNull() & ~F.array_contains(state["used"], p["new"])
        return F.struct(F.when(take, F.array_append(state["used"], p["new"])).otherwise(state["used"]).alias("used"), F.when(take, F.array_append(state["map"], p)).otherwise(state["map"]).alias("map"))

    table = F.aggregate(glue, start, step, lambda s: s["map"])
    name = lambda n: F.coalesce(F.try_element_at(F.transform(F.filter(table, lambda m: m["old"] == n), lambda m: m["new"]), F.lit(1)), n)
    # an id is renamed once only: its second bearer keeps its own spelling
    first = lambda g, i: F.array_position(F.transform(glue, lambda x: x["glue_id"]), g["glue_id"]) == i + 1
    fixed = F.transform(glue, lambda g, i: g.withField("glue_id", F.when(first(g, i), name(g["glue_id"])).otherwise(g["glue_id"])).withField("connects", F.transform(g["connects"], name)))
    deps = F.transform(dependencies, lambda d: d.withField("from", name(d["from"])).withField("to", name(d["to"])))
    return fixed, deps


def connected_groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) for graphs of any size: the least node of each connected component of ``edges`` (src, dst)."""
    found = components(edges)
    rows = nodes.select("node").join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    return rows.join(rows.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component")


def normalize_group(raw: Column, candidate_id: Column) -> Column:
    """A group from a model's JSON with defaults for what is missing."""
    g = F.from_json(raw, GROUP)
    return (
        g.withField("candidate_id", F.when(F.coalesce(g["candidate_id"], F.lit("")) == "", candidate_id).otherwise(g["candidate_id"]))
        .withField("synthesis_status", F.lower(F.when(F.coalesce(g["synthesis_status"], F.lit("")) == "", F.lit("ready")).otherwise(g["synthesis_status"])))
        .withField("language", canonical_language(g["language"]))
        .withField("test_mode", F.coalesce(g["test_mode"], F.lit("compile_only")))
        .withField("confidence", F.coalesce(g["confidence"], F.lit(0.0)))
    )
