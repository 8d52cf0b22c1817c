"""The jobs one after the other on a small store, and the streaming extension."""

import json

from pyspark.sql import functions as F

from quernflow.plans import jobs
from quernflow.streaming import feedback as streaming

FEATURE = "array<struct<feature_id: string, feature_type: string, description: string, code_witness: string, witness_kind: string, evidence_strength: string, language: string, compiler_area: string, failure_mode: string, target_options: array<string>, mutation_knobs: array<string>, composition_tags: array<string>, root_cause_link: string, confidence: double>>"


def store_with_pool(spark, root):
    kinds = ["semantic_invariant", "code_shape", "pass_interaction", "target_condition"]
    rows = [(i, "u", "cause", [("F1", kinds[i % 4], f"vector loop {i}", "int x;", None, "strong", "c", "vectorizer", "ice", ["-mlsx"], ["k"], ["loop", "lsx"], None, 0.9)]) for i in range(1, 25)]
    store = jobs.Store(spark, str(root))
    store.write("feature_outputs", spark.createDataFrame(rows, f"bug_id long, source_url string, root_cause_summary string, features {FEATURE}"))
    return store


def answer(uids):
    body = {
        "synthesis_status": "ready", "language": "C", "test_mode": "compile_only", "group_title": "t", "group_summary": "s", "confidence": 0.9, "instantiation_constraints": ["x"], "recommended_oracles": ["y"],
        "shared_execution_context": {"description": "d"}, "preservation_plan": [{"feature_uid": u, "preserved_invariant": "i"} for u in uids],
        "glue_features": [{"glue_id": "G1-acc", "description": "d", "code_witness": "w", "semantic_role": "r", "connects": uids}], "dependencies": [{"from": uids[0], "to": "G1-acc"}],
    }
    return json.dumps({"choices": [{"message": {"content": json.dumps(body)}}]})


def test_from_outputs_to_rewards(spark, tmp_path):
    store = store_with_pool(spark, tmp_path)
    assert jobs.build_pool(store) == {"features": 24}
    assert jobs.prepare(store, 4) == {"candidates": 4, "new": 4}
    first = [r["candidate_id"] for r in store.read("candidates").orderBy("pos").collect()]
    assert jobs.prepare(store, 4) and [r["candidate_id"] for r in store.read("candidates").orderBy("pos").collect()] == first
    candidates = store.read("candidates").orderBy("pos").collect()
    store.write("recorded", spark.createDataFrame([(r["candidate_id"], answer(r["source_feature_uids"])) for r in candidates[:3]], "id string, response string"))
    prompts = store.read("candidates").select(F.col("candidate_id").alias("id"), F.lit("p").alias("prompt"))
    assert jobs.run_model(store, prompts) == {"ok": 3, "api_error": 1}
    assert jobs.build_groups(store) == {"outputs": 3, "ready": 3, "rejected": 0, "errors": 0}
    assert jobs.verify(store, 0.5) == {"candidates": 4, "ready": 3, "missing": 1}
    groups = store.read("groups").orderBy("pos").collect()
    runs = [(i, "covered", g["group_uid"], g["candidate_id"], f"i{i}", f"m{i}") for i, g in enumerate(groups, 1)]
    store.write("evaluations", spark.createDataFrame(runs, "evaluation_index long, evaluation_status string, group_uid string, candidate_id string, instantiation_id string, map_id string"))
    store.write("edge_maps", spark.createDataFrame([("m1", "1"), ("m1", "2"), ("m2", "2"), ("m3", "3")], "map_id string, edge_id string"))
    store.write("instantiations", spark.createDataFrame([(g["group_uid"], "ready") for g in groups], "group_uid string, status string"))
    counts = jobs.run_feedback(store)
    assert (counts["union_edges"], counts["novel_groups"], counts["groups_with_feedback"]) == (3, 2, 3)
    assert store.read("novel_glue").count() == 2
    assert jobs.report(store, f"{tmp_path}/report.md")["covered"] == 3 and "## Funnel" in (tmp_path / "report.md").read_text()
    assert jobs.prepare(store, 2, append=True) == {"candidates": 6, "new": 2}


def test_classify_job(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    schema = "bug_id long, summary string, target string, resolution string, component string, keywords array<string>, description string"
    store.write("reports", spark.createDataFrame([(1, "LoongArch: ICE", "", "FIXED", "target", ["regression"], "loongarch64 fails, reduced"), (2, "x", "", "INVALID", "c", None, None)], schema))
    code = "```c\nint main(void) { return 1; }\n```"
    store.write("comments", spark.createDataFrame([(1, 0, code), (2, 0, "This ICE is reproducible on loongarch64-linux-gnu.")], "bug_id long, count long, text string"))
    assert jobs.classify(store) == {"reports": 2, "strict_ready": 1, "expanded_ready": 1, "general_ready": 1}
    assert {r["bug_id"]: r["tier"] for r in store.read("classified").collect()} == {1: "architecture_specific", 2: "loongarch_observed"}


def test_stream_of_maps(spark, tmp_path):
    source = tmp_path / "in"
    schema = "seq long, edge_id string"
    for i, rows in enumerate([[(1, "a"), (2, "b"), (2, "a")], [(3, "b"), (4, "c")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        streaming.start(spark.readStream.schema(schema).parquet(str(source)), f"{tmp_path}/seen", f"{tmp_path}/cp").awaitTermination()
    seen = streaming.first_seen(spark, f"{tmp_path}/seen")
    assert sorted((r["edge_id"], r["seq"]) for r in seen.collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_answers_become_instantiations(spark, tmp_path):
    store = jobs.Store(spark, str(tmp_path))
    kinds = "group_uid string, candidate_id string, language string, target_options array<string>, source_feature_uids array<string>, test_mode string"
    store.write("groups", spark.createDataFrame([(f"g{i}", f"c{i}", "C", ["-O2"], ["f1", "f2"], "compile_only") for i in range(1, 6)], kinds))
    ticks = [{"feature_uid": u, "implemented_by": "a loop"} for u in ("f1", "f2")]
    whole = {"source_code": "int x;", "oracle": {"kind": "runtime", "how": {"exit": [0, 1]}}, "coverage_intent": {"passes": ["vect"]}, "preservation_checklist": ticks}
    bodies = {"g1": whole, "g2": {**whole, "oracle": "none"}, "g3": {"instantiation_status": "REJECTED", "rejection_reasons": ["no way"]}, "g4": [1], "other": whole}
    rows = [(g, json.dumps({"id": f"r-{g}", "usage": {"total_tokens": 7}, "choices": [{"message": {"content": json.dumps(b)}}]}), None) for g, b in bodies.items()] + [("g5", None, "timeout")]
    store.write("instantiation_responses", spark.createDataFrame(rows, "id string, response string, error string"))
    assert jobs.build_instantiations(store, "m", "http://h/v1/") == {"outputs": 3, "ready": 1, "rejected": 1, "errors": 1}
    assert {r["group_uid"]: r["violations"] for r in store.read("instantiation_results").collect()} == {"g1": [], "g2": ["no_oracle_kind"], "g3": []}
    one, two = store.read("instantiations").orderBy("group_uid").collect()
    assert json.loads(one["oracle"]) == whole["oracle"] and json.loads(one["coverage_intent"]) == {"passes": ["vect"]} and one["oracle_kind"] == "runtime"
    assert (one["group_test_mode"], one["source_features_sha256"], one["group_target_options"]) == ("compile_only", None, ["-O2"])
    by = one["generated_by"]
    assert (by["model"], by["base_url"], by["response_id"], json.loads(by["usage"]), by["api_key_persisted"]) == ("m", "http://h/v1", "r-g1", {"total_tokens": 7}, False)
    assert (two["group_uid"], two["oracle"], two["coverage_intent"], two["status"]) == ("g3", "{}", "{}", "rejected")
    assert jobs.write_programs(store, f"{tmp_path}/out")["files"] == 1
