"""Feedback, groups, corpora, the sampler and connectors on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from quernflow.operators import connectors, corpus, coverage, feedback, groups, pairs
from quernflow.operators.windows import running_sum


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


GROUPS = "pos long, group_uid string, candidate_id string, source_feature_uids array<string>, glue_features array<struct<glue_id: string>>"


def test_feedback_of_one_covered_group_and_a_native_run(spark):
    g = frame(spark, [(1, "u1", "c1", ["f1", "f2", "f3"], [("G1",)])], GROUPS)
    e = frame(spark, [(1, "covered", "u1", "c1", "i1", "m1"), (2, "ice", "u1", "c1", "i2", "m2"), (3, "covered", "zz", "zz", "i3", "m3")], "evaluation_index long, evaluation_status string, group_uid string, candidate_id string, instantiation_id string, map_id string")
    maps = frame(spark, [("m1", "1"), ("m1", "2"), ("m1", "3"), ("m3", "9"), ("n1", "1"), ("n1", "4")], "map_id string, edge_id string")
    runs = frame(spark, [(1, "native-1", "n1", [], ["u1"], [])], "native_index long, native_run_id string, map_id string, source_feature_uids array<string>, group_uids array<string>, candidate_ids array<string>")
    out = feedback.coverage_feedback(e, g, maps)
    rewards = {r["feature_uid"]: r for r in out["feature_rewards"].collect()}
    assert {k: r["reward_score"] for k, r in rewards.items()} == {"f1": 26.003, "f2": 26.003, "f3": 26.003}
    assert rewards["f1"]["candidate_ids"] == ["c1"]
    counts = out["counts"].first()
    assert (counts["covered_evaluations"], counts["union_edges"], counts["groups_with_feedback"]) == (2, 3, 1)
    assert [r["glue_id"] for r in out["novel_glue"].collect()] == ["G1"]
    out = feedback.coverage_feedback(e, g, maps, runs)
    counts = out["counts"].first()
    assert (counts["union_edges"], counts["native_runs"], counts["native_runs_with_new_edges"]) == (4, 1, 1)


def test_novelty_of_ties_and_empty_tables(spark):
    schema = "seq long, edge_id string"
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "b"), (3, "a")]
    got = {r["seq"]: (r["edge_entries"], r["new_edges"], r["union_edges_after"]) for r in feedback.edge_novelty(frame(spark, rows, schema)).collect()}
    assert got == {1: (1, 1, 1), 2: (1, 0, 1), 3: (2, 1, 2)}
    assert feedback.edge_novelty(frame(spark, [], schema)).count() == 0


def test_running_sum_over_ranges(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    got = [r["s"] for r in running_sum(df, "id", "v", "s", 5).orderBy("id").collect()]
    total, want = 0, []
    for i in range(1000):
        total += i % 7
        want.append(total)
    assert got == want


def sound_group():
    return {
        "candidate_id": "c1", "synthesis_status": "ready", "language": "c", "test_mode": "compile_only", "group_title": "t", "group_summary": "s", "confidence": 0.8,
        "source_feature_uids": ["f1", "f2"], "source_features_sha256": "h", "conflicts": [], "instantiation_constraints": ["x"], "recommended_oracles": ["y"],
        "shared_execution_context": {"description": "d"}, "preservation_plan": [{"feature_uid": "f1", "preserved_invariant": "i"}, {"feature_uid": "f2", "preserved_invariant": "i"}],
        "glue_features": [{"glue_id": "G1", "description": "d", "code_witness": "", "semantic_role": "r", "connects": ["f1", "f2"]}], "dependencies": [{"from": "f1", "to": "G1"}],
    }


def violations(spark, group):
    want = "want struct<candidate_id: string, source_feature_uids: array<string>, source_features_sha256: string>"
    df = spark.createDataFrame([(json.dumps(group), ("c1", ["f1", "f2"], "h"))], f"j string, {want}")
    return df.select(F.from_json("j", groups.GROUP).alias("g"), "want").select("g.*", "want").select(groups.group_violations().alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({}, None), ({"candidate_id": "c2"}, "wrong_candidate_id"), ({"synthesis_status": "odd"}, "invalid_status"), ({"source_features_sha256": "x"}, "source_hash_differs"),
        ({"confidence": 0.0}, "invalid_confidence"), ({"language": "klingon"}, "invalid_language"), ({"test_mode": "no"}, "invalid_test_mode"), ({"dependencies": []}, "no_dependencies"),
        ({"glue_features": []}, "no_glue"), ({"group_title": " "}, "no_title_or_summary"), ({"preservation_plan": []}, "preservation_incomplete"),
        ({"dependencies": [{"from": "f1", "to": "f9"}]}, "invalid_dependency"), ({"synthesis_status": "rejected"}, "rejected_without_conflict"),
    ],
)
def test_group_rules(spark, change, rule):
    found = violations(spark, sound_group() | change)
    assert (rule in found) if rule else found == []


def test_disconnected_source_and_many_glue(spark):
    g = sound_group()
    g["glue_features"] = [{"glue_id": f"G{i}", "description": "d", "code_witness": "", "semantic_role": "", "connects": ["f1", f"G{i % 5 + 1}"]} for i in range(1, 6)]
    found = violations(spark, g)
    assert "too_many_glue" in found and "disconnected_source" in found


def test_instantiation_rules(spark):
    schema = (
        "group_uid string, candidate_id string, instantiation_status string, source_feature_uids array<string>, rejection_reasons array<string>, language string, source_code string, notes string, "
        "compiler_options array<string>, oracle_kind string, preservation_checklist array<struct<feature_uid: string, implemented_by: string>>, want struct<group_uid: string, candidate_id: string, source_feature_uids: array<string>>"
    )
    want = ("u", "c", ["f"])
    rows = [("u", "c", "ready", ["f"], [], "c", "int x;", "", ["-O2"], "compile", [("f", "x")], want), ("u", "c", "ready", ["f"], [], "cobol", "use shellcode", None, [], "", [], want), ("u", "c", "rejected", ["f"], [], None, None, None, None, None, None, want)]
    got = [r["v"] for r in spark.createDataFrame(rows, schema).select(groups.instantiation_violations().alias("v")).collect()]
    assert got[0] == [] and got[2] == ["rejected_without_reason"]
    assert got[1] == ["bad_purpose", "no_options", "no_oracle_kind", "checklist_incomplete"]


def test_glue_rewrite_keeps_references(spark):
    schema = "glue array<struct<glue_id: string, connects: array<string>>>, deps array<struct<`from`: string, `to`: string>>"
    df = spark.createDataFrame([([("G1-acc", ["f1", "g2_x"]), ("g2_x", ["G1-acc"]), ("G2", [])], [("G1-acc", "f1")])], schema)
    glue, deps = groups.rewrite_glue(F.col("glue"), F.col("deps"))
    row = df.select(glue.alias("g"), deps.alias("d")).first()
    assert [g["glue_id"] for g in row["g"]] == ["G1", "G2", "G2"] and row["g"][0]["connects"] == ["f1", "G2"] and row["d"][0]["from"] == "G1"


def test_components_of_a_long_path(spark):
    edges = frame(spark, [(i, i + 1) for i in range(40)] + [(100, 101)], "src long, dst long")
    nodes = frame(spark, [(i,) for i in range(41)] + [(100,), (101,), (200,)], "node long")
    got = {r["node"]: r["component"] for r in groups.connected_groups(nodes, edges).collect()}
    assert {got[i] for i in range(41)} == {0} and got[101] == 100 and got[200] == 200


def test_comment_testcases(spark):
    text = "see\n```cpp\nstd::string s = \"abc\";\n```\n```\nshort\n```"
    rows = [(1, 0, text), (1, 1, "reduced testcase: int x; int y; compile it with gcc -O2 please"), (1, 2, None), (1, 3, "nothing; at; all")]
    got = [(r["comment_number"], r["kind"], r["language"]) for r in corpus.comment_testcases(frame(spark, rows, "bug_id long, count long, text string")).collect()]
    assert sorted(got) == [(0, "comment_code_block", "c++"), (1, "comment_reproducer", "c")]


def test_fix_history_with_attachments(spark):
    c = frame(spark, [(1, 2, "commit 0123456789ab"), (1, 1, "Fixed in ffffffffffff and 0123456789AB"), (2, 0, "hello")], "bug_id long, count long, text string")
    a = frame(spark, [(1, "the patch", "x", 0), (2, "log", "y", 1)], "bug_id long, summary string, file_name string, is_patch int")
    got = {r["bug_id"]: (r["evidence_count"], r["commit_hashes"]) for r in corpus.fix_history(c, a).collect()}
    assert got == {1: (3, ["ffffffffffff", "0123456789ab"]), 2: (1, [])}


def test_prompt_ladder_gets_tighter(spark):
    schema = "bug_id long, description string, comments array<struct<count: long, text: string, attachment_id: long>>, fix_counts array<long>, programs array<string>"
    comments = [(i, "c" * 5000, None) for i in range(10)]
    rows = [(1, "d", [], [], ["int x;"]), (2, "d", comments, [4], ["p" * 10000] * 2), (3, "d" * 30000, comments, [], [])]
    got = {r["bug_id"]: (r["step"], len(r["prompt"])) for r in corpus.prompt_ladder(frame(spark, rows, schema), 15000).collect()}
    assert got[1][0] == 0 and 1 <= got[2][0] <= 5 and got[2][1] <= 15000 and got[3][0] == 6


def test_pool_checks(spark):
    schema = "feature_uid string, language string, description string, confidence double"
    good = frame(spark, [("a", "C", "d", None), ("b", "go", "d", 1.0), ("c", "cpp", " ", 1.0), ("d", "cxx", "d", 0.1)], schema)
    assert [r["feature_uid"] for r in corpus.load_pool(good, ["c", "c++"], 0.4).collect()] == ["a"]
    with pytest.raises(ValueError, match="twice"):
        corpus.load_pool(frame(spark, [("a", "c", "d", 1.0)] * 2, schema), ["c"])
    with pytest.raises(ValueError, match="no eligible"):
        corpus.load_pool(good, ["ada"])


def test_sampler_repeats_itself():
    kinds = ["semantic_invariant", "code_shape", "failure_oracle", "pass_interaction"]
    pool = [{"feature_uid": f"f{i:02d}", "bug_id": i, "feature_type": kinds[i % 4], "profile_match": True} for i in range(24)]
    scores = {(a["feature_uid"], b["feature_uid"]): 4.0 for a in pool for b in pool if a["feature_uid"] < b["feature_uid"]}
    one, two = (pairs.Sampler(pool, scores, 7).groups(6) for _ in range(2))
    assert one == two and len({tuple(sorted(g)) for g in one}) == 6
    assert all(3 <= len(g) <= 5 for g in one)
    assert pairs.Sampler(pool, scores, 8).groups(6) != one
    assert pairs.selection_score([3.0], 0, 0, 0, True, 0.0) == -1000.0


def test_model_calls_and_replay(spark):
    prompts = frame(spark, [("a", "say a"), ("b", "fail")], "id string, prompt string")

    def caller(prompt):
        if prompt == "fail":
            raise RuntimeError("down")
        return json.dumps({"choices": [{"message": {"content": '{"ok": 1}'}}], "usage": {"total_tokens": 3}})

    answers = connectors.call_model(prompts, caller, retries=1)
    got = {r["id"]: r["status"] for r in connectors.parsed(answers).collect()}
    assert got == {"a": "ok", "b": "api_error"}
    recorded = frame(spark, [("a", '{"choices":[{"message":{"content":"not json"}}]}')], "id string, response string")
    got = {r["id"]: r["status"] for r in connectors.parsed(connectors.replay(prompts, recorded)).collect()}
    assert got == {"a": "parse_error", "b": "api_error"}
    with pytest.raises(ValueError, match="bad"):
        connectors.gate(prompts, "bad")


def test_incremental_helpers(spark):
    found = frame(spark, [(1, "s1", 7, "2024"), (2, "s2", 7, "2025"), (3, "s1", 8, "2023")], "pos long, source string, bug_id long, last_change_time string")
    rows = corpus.discover(found).collect()
    assert [(r["bug_id"], r["last_change_time"], r["discovery_sources"]) for r in rows] == [(7, "2025", ["s1", "s2"]), (8, "2023", ["s1"])]
    cache = frame(spark, [(7, "2025", 3), (8, "2023", 2)], "bug_id long, last_change_time string, schema_version int")
    assert [r["bug_id"] for r in corpus.stale(frame(spark, [(7, "2025"), (8, "2023")], "bug_id long, last_change_time string"), cache).collect()] == [8]
    assert coverage.histograms(frame(spark, [(None, "a"), ("x", "a")], "l string, t string"), "l", "t").where("dimension = 'l'").count() == 2


def test_instantiations_get_defaults_names_and_ids(spark):
    import hashlib
    import json

    from quernflow.operators import instantiation as I

    groups = spark.createDataFrame([(1, "g1", "k1", "C++", ["-O2"], [" f1 ", ""]), (2, "g2", "k2", "c", None, None)], "pos int, group_uid string, candidate_id string, language string, target_options array<string>, source_feature_uids array<string>")
    assert [r["group_uid"] for r in I.select_groups(groups, ["k2", "nothing"]).collect()] == ["g2"]
    assert [r["group_uid"] for r in I.select_groups(groups, languages=["cxx", "c"], limit=1).collect()] == ["g1"]
    with pytest.raises(ValueError, match="no groups matched"):
        I.select_groups(groups, ["none"])
    raw = groups.select("group_uid", I.normalize_instantiation(F.when(F.col("pos") == 1, '{"source_code": "int x;", "instantiation_status": "READY"}').otherwise("no json"), F.struct("*")).alias("i"))
    one, two = (r["i"] for r in raw.orderBy("group_uid").collect())
    digest = hashlib.sha256(json.dumps({"source": "int x;", "options": ["-O2"]}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]
    assert two is None or two["source_code"] == ""
    assert (one["group_uid"], one["language"], one["instantiation_status"], one["source_feature_uids"], one["instantiation_id"]) == ("g1", "c++", "ready", ["f1"], f"k1-{digest}")
    assert I.chat_endpoint(" http://h/v1/ ") == "http://h/v1/chat/completions" and I.csv_values("a, ,b") == ["a", "b"]
    with pytest.raises(ValueError):
        I.csv_values(" , ")


def _vectors(spark, n, seed, hot=0.0):
    """Vectors as ``features.vector`` makes them, with few values each, so that many pairs lie about the gate."""
    import random

    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        alike = rng.random() < hot
        tokens = sorted({"all"} | set(rng.choices(words, weights=[1 / (j + 1) for j in range(60)], k=rng.choice([0, 1, 2, 5, 9, 14])))) if rng.random() < 0.95 else []
        rows.append((
            f"u{i:05d}", rng.randrange(max(2, n // 2)), rng.choice(["code_shape", "failure_oracle"]), "c" if alike else rng.choice(["c", "c++", "unknown"]),
            "hot" if alike else rng.choice(["", "x", "y", None]), rng.choice(["", "ice", None]), ["loongarch"] if alike else rng.sample(["loongarch", "lsx", "lasx"], rng.choice([0, 0, 1, 2])),
            tokens, rng.choice([0.0, 0.3, 0.6, 1.0]), rng.choice(["compile", "execute", "execute_or_compile"]), [],
        ))
    kinds = "feature_uid string, bug_id long, feature_type string, language string, compiler_area string, failure_mode string, archs array<string>, tokens array<string>, quality double, mode string, required array<string>"
    from quernflow.functions import features as X

    return spark.createDataFrame(rows, kinds).withColumn("options", X.option_constraints(F.array().cast("array<string>")))


def test_candidate_pairs_miss_none(spark):
    for seed, least in ((1, 3.2), (2, 3.2), (3, 4.5), (4, 2.4)):
        v = _vectors(spark, 160, seed)
        every = v.alias("a").join(v.alias("b"), (F.col("a.feature_uid") < F.col("b.feature_uid")) & (F.col("a.bug_id") != F.col("b.bug_id")))
        every = every.select(F.col("a.feature_uid").alias("left"), F.col("b.feature_uid").alias("right"))
        scored = {(r["left"], r["right"]): r["score"] for r in pairs.pair_affinity(v, every).collect()}
        want = {k: s for k, s in scored.items() if s is not None and s >= least}
        got = {(r["left"], r["right"]): r["score"] for r in pairs.pair_affinity(v, least=least).collect()}
        assert got == want and want
        held = pairs.candidate_pairs(v, least, block=7)
        tried = {(r["left"], r["right"]) for r in held.collect()}
        assert set(want) <= tried and len(tried) == held.count()
        assert len(tried) < 2 * len(want) + 50  # the bound leaves few that fail


def test_candidate_pairs_of_odd_rows(spark):
    v = _vectors(spark, 6, 5)
    assert pairs.pair_affinity(v.limit(0)).collect() == []
    bare = v.withColumn("tokens", F.lit(None).cast("array<string>")).withColumn("archs", F.lit(None).cast("array<string>")).withColumn("quality", F.lit(None).cast("double"))
    assert pairs.candidate_pairs(bare).collect() == []
    with pytest.raises(ValueError):
        pairs.candidate_pairs(v, 1.5)


def test_a_hot_key_is_cut_into_cells(spark):
    v = _vectors(spark, 300, 6, hot=0.5)
    rows = v.select(F.col("feature_uid").alias("uid"), F.when(F.col("compiler_area") == "hot", 1).otherwise(F.xxhash64("feature_uid")).alias("key"))
    n = rows.where("key = 1").count()
    cells = pairs._in_cells(rows, 20)
    sizes = {(r["low"], r["high"]): r["n"] for r in cells.where("key = 1").groupBy("low", "high").agg(F.count("*").alias("n")).collect()}
    sides = -(-n // 20)
    assert n > 100 and len(sizes) == sides * (sides + 1) // 2 and max(sizes.values()) < 80
    a, b = cells.alias("a"), cells.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "low", "high")] + [F.col("a.uid") < F.col("b.uid"), (F.col("a.side") != F.col("b.side")) | (F.col("a.low") == F.col("a.high"))]
    met = a.join(b, on).where("a.key = 1").select("a.uid", "b.uid").collect()
    assert len(met) == len(set(map(tuple, met))) == n * (n - 1) // 2
    assert {tuple(r) for r in pairs.candidate_pairs(v, block=20).collect()} == {tuple(r) for r in pairs.candidate_pairs(v).collect()}


def test_features_judged_alike_are_scored_once(spark, monkeypatch):
    v = _vectors(spark, 40, 7)
    copies = v.crossJoin(spark.range(5).withColumnRenamed("id", "copy")).withColumn("feature_uid", F.concat(F.lit("c"), (7 * F.col("copy") % 5).cast("string"), "feature_uid"))
    copies = copies.withColumn("bug_id", F.col("bug_id") * 3 + F.col("copy") % 3).drop("copy")
    every = copies.alias("a").join(copies.alias("b"), (F.col("a.feature_uid") < F.col("b.feature_uid")) & (F.col("a.bug_id") != F.col("b.bug_id")))
    every = every.select(F.col("a.feature_uid").alias("left"), F.col("b.feature_uid").alias("right"))
    want = sorted(map(str, pairs.pair_affinity(copies, every).where("score >= 3.2").collect()))
    tried = []
    monkeypatch.setattr(pairs, "candidate_pairs", lambda classes, *a, own=pairs.candidate_pairs: tried.append(classes.count()) or own(classes, *a))
    assert sorted(map(str, pairs.pair_affinity(copies).collect())) == want and want
    assert tried == [40]


def test_the_sampler_asks_for_blocks_of_scores(spark, monkeypatch):
    one, two = sorted(pairs.X.CORE_TYPES)[:2]
    v = _vectors(spark, 60, 8).withColumn("feature_type", F.when(F.col("bug_id") % 2 == 0, one).otherwise(two))
    v = v.withColumn("profile_match", F.lit(True)).localCheckpoint()
    pool = [r.asDict() for r in v.select("feature_uid", "bug_id", "feature_type", "profile_match").orderBy("feature_uid").collect()]
    of, asked = pairs.partners(v), []
    scores = {(r["feature_uid"], r["other"]): r["score"] for r in of([f["feature_uid"] for f in pool]).collect()}
    monkeypatch.setattr(pairs, "_SCORES", 60 * 13)
    drawn = pairs.Sampler(pool, lambda uids: asked.append(uids) or of(uids), most_features=5).groups(2)
    assert drawn == pairs.Sampler(pool, scores).groups(2)
    assert max(map(len, asked)) == 13 and len(asked) <= 5
