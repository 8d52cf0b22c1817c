"""Pipeline jobs over a folder of tables: each reads its inputs, writes its outputs and gives a dict of counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernflow.functions import classify as K
from quernflow.functions import features as X
from quernflow.functions import text as T
from quernflow.operators import connectors, corpus, coverage, evaluate, feedback, groups, inputs, instantiation, pairs
from quernflow.operators.digests import row_json
from quernflow.operators.rebuild import Kept
from quernflow.operators.windows import running_sum
from quernflow.plans import archive
from quernflow.scratch import materialize
from quernflow.sources import files, named_files, sinks, tracker


@dataclass
class Store:
    """Named Parquet tables below one folder."""

    spark: SparkSession
    root: str

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """A table; one that is missing is empty if its schema is given."""
        path = f"{self.root.rstrip('/')}/{name}"
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        if schema and not target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(path)

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        """Write a table that may depend on itself: it goes to scratch first."""
        (materialize(df, name) if mode == "overwrite" else df).write.mode(mode).parquet(f"{self.root.rstrip('/')}/{name}")


def counts_of(df: DataFrame) -> dict:
    row = df.first()
    return row.asDict(recursive=True) if row else {}


def sync(store: Store, queries: dict[str, str], options: dict[str, str], limit: int = 0) -> dict:
    """Ask the tracker each search (source -> query), merge what it finds, and list what is new or changed."""
    import json

    store.spark.dataSource.register(tracker.TrackerSource)
    reader = store.spark.read.format("tracker").option("queries", json.dumps(list(queries.values())))
    for k, v in options.items():
        reader = reader.option(k, v)
    names = T.lookup(F.col("query"), {v: k for k, v in queries.items()})
    bug = "struct<id: long, summary: string, cf_gcctarget: string, resolution: string, component: string, keywords: array<string>, last_change_time: string>"
    found = reader.load().select(names.alias("source"), F.posexplode(F.from_json("body", f"bugs array<{bug}>")["bugs"]).alias("pos", "b"))
    found = materialize(found.select("pos", "source", F.col("b.id").alias("bug_id"), "b.*").drop("id"), "found")
    merged = corpus.discover(found, limit)
    cache = store.read("cache", "bug_id long, last_change_time string, schema_version int")
    todo = corpus.stale(merged, cache)
    store.write("metadata", merged)
    store.write("stale", todo)
    return {"discovered": store.read("metadata").count(), "stale": store.read("stale").count()}


def _classified(reports: DataFrame, comments: DataFrame) -> DataFrame:
    evidence = comments.groupBy("bug_id").agg(F.collect_list(F.struct("count", "text")).alias("c"), F.collect_list(K.comment_evidence(F.col("text"))).alias("evidence"))
    cases = corpus.comment_testcases(comments).select("bug_id").distinct().withColumn("has_testcase", F.lit(True))
    rows = reports.join(evidence, "bug_id", "left").join(cases, "bug_id", "left")
    text = F.concat_ws("\n", "summary", "target", "component", "description", F.transform("c", lambda x: x["text"]))
    rows = rows.withColumns({"all_text": text, "has_testcase": F.coalesce("has_testcase", F.lit(False))})
    none = F.array().cast("array<string>")
    tier = K.full_tier(K.relevance(F.col("summary"), F.col("target"))["tier"], F.lit(False), F.coalesce("evidence", none))
    rows = rows.withColumns({"tier": tier, "scope": K.architecture_scope(F.col("all_text"))})
    rows = rows.withColumn("quality", K.general_quality(*[F.col(c) for c in ("all_text", "description", "has_testcase", "component", "keywords", "resolution")]))
    rows = rows.withColumn("gates", K.readiness(*[F.col(c) for c in ("tier", "scope", "description", "has_testcase", "resolution", "quality.score")]))
    return rows.drop("c", "all_text")


_COMMENTS = "bug_id long, count long, text string"


def _ready_counts(done: DataFrame) -> dict:
    return counts_of(done.agg(F.count("*").alias("reports"), *[F.count_if(F.size(f"gates.{g}") == 0).alias(f"{g}_ready") for g in ("strict", "expanded", "general")]))


def classify(store: Store) -> dict:
    """Reports (bug_id, summary, target, resolution, component, keywords, description) with comments to classified reports."""
    store.write("classified", _classified(store.read("reports"), store.read("comments", _COMMENTS)))
    return _ready_counts(store.read("classified"))


def policy() -> str:
    """A digest of the patterns and weights that classify reports: results made under another one are made anew."""
    import hashlib
    import inspect

    return hashlib.sha256(inspect.getsource(K).encode()).hexdigest()[:16]


def rebuild(store: Store, under: str | None = None) -> dict:
    """Classified reports brought up to date: only those whose report, comments or policy changed are classified again. The
    results are kept in buckets below ``classified_kept`` and read with ``kept_reports``."""
    reports, comments = store.read("reports"), store.read("comments", _COMMENTS)
    kept = kept_reports(store)
    row = lambda df, kind: df.select("bug_id", F.lit(kind).alias("kind"), row_json(*sorted(df.columns)).alias("row"))
    own = comments.join(reports.select("bug_id").distinct(), "bug_id", "left_semi")
    some = lambda df, keys: df.join(keys, "bug_id", "left_semi")
    counts = kept.rebuild(row(reports, "report").unionByName(row(own, "comment")), lambda keys: _classified(some(reports, keys), some(comments, keys)), under or policy())
    done = kept.read()
    return counts | (_ready_counts(done) if done is not None else {})


def kept_reports(store: Store) -> Kept:
    return Kept(store.spark, f"{store.root.rstrip('/')}/classified_kept", ["bug_id"])


def build_pool(store: Store) -> dict:
    """Model outputs to the pool of features and its histograms."""
    store.write("feature_pool", corpus.feature_pool(store.read("feature_outputs")))
    pool = store.read("feature_pool")
    store.write("feature_pool_histograms", coverage.histograms(pool, "compiler_area", "feature_type", "witness_kind", "evidence_strength", "language", "failure_mode"))
    return {"features": pool.count()}


_CANDIDATES = "pos long, candidate_id string, source_feature_uids array<string>, source_bug_ids array<bigint>"


def prepare(store: Store, count: int = 64, least: int = 3, most: int = 5, seed: int = 20260730, profile: str = "loongarch", languages=groups.LANGUAGES, append: bool = False) -> dict:
    """Draw candidate groups from the pool; ``append`` adds to those there are, steered by rewards where there are any."""
    spark = store.spark
    pool = corpus.load_pool(store.read("feature_pool"), languages)
    vectors = materialize(pool.select(F.struct("*").alias("f")).select(*X.vector(F.col("f"), profile), X.feedback_compatible(F.col("f"), profile).alias("compatible")), "vectors")
    rewards = {r["feature_uid"]: r["reward_score"] for r in store.read("feature_rewards", "feature_uid string, reward_score double").collect()} if append else {}
    rows = vectors.where("compatible") if rewards else vectors
    names = [r.asDict() for r in rows.select("feature_uid", "bug_id", "feature_type", "profile_match").orderBy("feature_uid").collect()]
    sampler = pairs.Sampler(names, pairs.partners(vectors), seed)
    old = store.read("candidates", _CANDIDATES) if append else spark.createDataFrame([], _CANDIDATES)
    known = old.orderBy("pos").collect()
    for row in known:
        sampler.remember(row["source_feature_uids"])
    bugs = {f["feature_uid"]: f["bug_id"] for f in names}
    drawn = []
    for i, uids in enumerate(sampler.groups(count, least, most, rewards), len(known) + 1):
        drawn.append((i, f"group-{i:04d}-{_digest(seed, uids)}", uids, [bugs[u] for u in uids]))
    store.write("candidates", old.unionByName(spark.createDataFrame(drawn, _CANDIDATES)))
    return {"candidates": len(known) + len(drawn), "new": len(drawn)}


def _digest(seed: int, uids: list[str]) -> str:
    import hashlib
    import json

    return hashlib.sha256(json.dumps({"seed": seed, "uids": uids}, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:12]


def run_model(store: Store, prompts: DataFrame, caller: Callable[[str], str] | None = None) -> dict:
    """Ask the model for what has no answer yet; without a caller, recorded responses (table ``recorded``) answer."""
    done = store.read("responses", "id string, response string, error string")
    todo = prompts.join(done.where("error is null").select("id"), "id", "left_anti")
    answers = connectors.call_model(todo, caller) if caller else connectors.replay(todo, store.read("recorded"))
    store.write("responses", sinks.upsert(done, materialize(answers, "answers"), "id"))
    parsed = connectors.parsed(store.read("responses"))
    return {r["status"]: r["count"] for r in parsed.groupBy("status").count().collect()}


def build_groups(store: Store) -> dict:
    """Parsed responses to groups with their violations; sound ready ones are the group pool."""
    candidates = store.read("candidates")
    parsed = connectors.parsed(store.read("responses")).where("status = 'ok'")
    rows = parsed.join(candidates, parsed["id"] == candidates["candidate_id"])
    g = rows.select("pos", groups.normalize_group(F.col("json"), F.col("candidate_id")).alias("g"), F.struct("candidate_id", "source_feature_uids", F.lit(None).cast("string").alias("source_features_sha256")).alias("want"), "source_bug_ids")
    glue, deps = groups.rewrite_glue(F.coalesce("g.glue_features", F.array().cast("array<struct<glue_id:string,description:string,code_witness:string,semantic_role:string,connects:array<string>>>")), F.coalesce("g.dependencies", F.array().cast("array<struct<`from`:string,`to`:string>>")))
    g = g.withColumn("g", F.col("g").withField("glue_features", glue).withField("dependencies", deps).withField("source_feature_uids", F.col("want.source_feature_uids")))
    g = g.select("pos", "g.*", "want", "source_bug_ids").withColumn("violations", groups.group_violations())
    mark = T.py_json_hash(16)(F.to_json(F.struct(F.col("source_feature_uids").alias("sources"), F.col("glue_features").alias("glue"), "dependencies")))
    store.write("group_results", g.withColumn("group_uid", F.concat("candidate_id", F.lit("-"), mark)).drop("want"))
    done = store.read("group_results")
    store.write("groups", done.where("synthesis_status = 'ready' and size(violations) = 0"))
    store.write("feature_coverage", coverage.feature_coverage(store.read("feature_pool"), candidates, store.read("groups")))
    good = F.size("violations") == 0
    return counts_of(done.agg(F.count("*").alias("outputs"), F.count_if(good & (F.col("synthesis_status") == "ready")).alias("ready"), F.count_if(good & (F.col("synthesis_status") == "rejected")).alias("rejected"), F.count_if(~good).alias("errors")))


def build_instantiations(store: Store, model: str = "recorded", base_url: str = "") -> dict:
    """Answers for groups (table ``instantiation_responses``: id, response, error) to instantiations with their violations.

    All that parse go to ``instantiation_results``; the sound ones, rejected ones included, are ``instantiations``.
    """
    parsed = connectors.parsed(store.read("instantiation_responses"), also=["response"]).where("status = 'ok'")
    known = store.read("groups")
    theirs = [c if c in known.columns else F.lit(None).cast(kind).alias(c) for c, kind in _GROUP_FIELDS.items()]
    rows = parsed.join(known.select(F.struct(*theirs).alias("want")), parsed["id"] == F.col("want.group_uid"))
    by = instantiation.provenance(F.col("response"), model, base_url, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    made = rows.select(instantiation.normalize_instantiation(F.col("json"), F.col("want"), instantiation.FROM_GROUP, by).alias("i"), "want").where("i is not null")
    store.write("instantiation_results", made.select("i.*", "want").withColumn("violations", groups.instantiation_violations()).drop("want"))
    done = store.read("instantiation_results")
    store.write("instantiations", done.where("size(violations) = 0").drop("violations").withColumn("status", F.col("instantiation_status")))
    good = F.size("violations") == 0
    return counts_of(done.agg(F.count("*").alias("outputs"), F.count_if(good & (F.col("instantiation_status") == "ready")).alias("ready"), F.count_if(good & (F.col("instantiation_status") == "rejected")).alias("rejected"), F.count_if(~good).alias("errors")))


_GROUP_FIELDS = {"group_uid": "string", "candidate_id": "string", "language": "string", "target_options": "array<string>", "source_feature_uids": "array<string>", "source_features_sha256": "string", "test_mode": "string"}


def run_feedback(store: Store, native: bool = False) -> dict:
    """Evaluations and edge maps to feedback, rewards and promoted glue."""
    out = feedback.coverage_feedback(store.read("evaluations"), store.read("groups"), store.read("edge_maps"), store.read("native_runs") if native else None)
    for name in ("feature_rewards", "novel_glue"):
        store.write(name, out[name])
    store.write("group_feedback", out["group_feedback"].drop("group"))
    return counts_of(out["counts"])


def report(store: Store, path: str) -> dict:
    """The funnel and the sizes of maps, as a Markdown file and counts."""
    evaluations = store.read("evaluations")
    row = coverage.funnel(store.read("groups").select("group_uid", "language"), store.read("instantiations"), evaluations.select(F.col("evaluation_status").alias("status")))
    sizes = coverage.edge_summary(store.read("edge_maps").groupBy("map_id").agg(F.count("*").alias("edge_map_entries")))
    sinks.write_text(store.spark, path, sinks.report("Coverage", {"Funnel": row, "Edge maps": sizes}))
    return counts_of(row) | {f"edges_{k}": v for k, v in counts_of(sizes).items()}


def verify(store: Store, least_ready_ratio: float = 0.0) -> dict:
    """Stop on any group that breaks a rule, any result without candidate, or too few ready groups."""
    done, candidates = store.read("group_results"), store.read("candidates")
    connectors.gate(done.where("size(violations) > 0").select("candidate_id", "violations"), "a group breaks rules")
    connectors.gate(done.join(candidates, "candidate_id", "left_anti").select("candidate_id"), "a result has no candidate")
    missing = candidates.join(done, "candidate_id", "left_anti").count()
    total, ready = candidates.count(), done.where("synthesis_status = 'ready'").count()
    if total and ready / total < least_ready_ratio:
        raise ValueError(f"only {ready} of {total} groups are ready")
    return {"candidates": total, "ready": ready, "missing": missing}


def write_programs(store: Store, root: str) -> dict:
    """The programs of instantiations as files below ``root``/programs, with their paths and digests in table ``programs``."""
    programs = instantiation.program_files(store.read("instantiations").where("coalesce(source_code, '') <> ''"))
    written = named_files.write_files(programs, root)
    store.write("programs", programs.drop("content"))
    rows = written.join(store.read("programs").select("path").distinct(), "path", "left_semi")
    return counts_of(rows.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")))


def evaluate_programs(store: Store, state: str, command: list[str], timeout_ms: int = 5000, least_edges: int = 1, optimization: str = "-O2") -> dict:
    """Run the programs of instantiations, each once, to tables ``evaluations`` and ``edge_maps``; counts by status. ``state`` is
    the folder that keeps the results of runs."""
    done = evaluate.evaluate(store.read("instantiations"), state, command, timeout_ms, least_edges, optimization)
    done = materialize(done, "evaluations")
    place = running_sum(done.select("instantiation_id", F.lit(1).alias("one")).distinct(), "instantiation_id", "one", "evaluation_index").drop("one")
    store.write("evaluations", done.drop("map").withColumn("map_id", F.when(F.col("edge_map_entries") > 0, F.col("digest"))).join(place, "instantiation_id"))
    store.write("edge_maps", evaluate.edge_maps(done))
    return {r["evaluation_status"]: r["count"] for r in store.read("evaluations").groupBy("evaluation_status").count().collect()}


def collect_coverage(store: Store, pattern: str, source_root: str) -> dict:
    """Coverage files of many runs, damaged ones counted, to tables ``source_coverage`` (a row a source) and its totals."""
    read = files.read_gcov(store.spark, pattern, source_root)
    store.write("source_coverage", coverage.source_coverage(read["lines"], read["functions"], read["branches"]))
    status = {r["status"]: r["count"] for r in read["read"].groupBy("status").count().collect()}
    return {"read": status.get("ok", 0), "damaged": status.get("damaged", 0)} | counts_of(coverage.coverage_totals(store.read("source_coverage")))


def _sources(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, content) of the committed files below a folder, read by the tasks; paths are relative to it."""
    return named_files.folder_files(spark, root).join(named_files.manifest(spark, root).select("path", "sha256"), "path")


def _copy(store: Store, files: DataFrame, sources: DataFrame, root: str) -> DataFrame:
    """Files (source, target) with the contents of ``sources`` (path, content); what was written."""
    rows = files.select("source", "target").distinct().join(sources.select(F.col("path").alias("source"), "content"), "source")
    return named_files.write_files(rows.select(F.col("target").alias("path"), "content"), root)


def build_corpus(store: Store, programs: str, root: str) -> dict:
    """Copy the programs of covered evaluations to a folder of their own; ``corpus_files`` and the folder's manifest list them."""
    evaluations, sources = store.read("evaluations"), _sources(store.spark, programs)
    files = instantiation.covered_corpus(evaluations, sources)
    _copy(store, files, sources, root)
    store.write("corpus_files", files)
    return {"covered_evaluations": evaluations.where("evaluation_status = 'covered'").count(), "copied": store.read("corpus_files").count()}


def build_seeds(store: Store, programs: str, root: str, language: str) -> dict:
    """Copy the programs that seed a fuzzer of one language, and keep what they stand for in ``seeded``."""
    sources = _sources(store.spark, programs)
    files, stood = instantiation.seed_corpus(store.read("evaluations"), store.read("candidates"), store.read("groups"), sources, language)
    files = materialize(files, "seeds")
    _copy(store, files, sources, root)
    store.write("seeded", stood)
    kinds = {r["kind"]: r["count"] for r in store.read("seeded").groupBy("kind").count().collect()}
    return {"files": files.count()} | {k: kinds.get(k, 0) for k in ("candidate", "group", "feature")}


_PARTS = {
    "comments": "bug_id long, count long, time string, attachment_id long, text string",
    "programs": "bug_id long, index int, kind string, language string, path string, sha256 string, bytes long, content string",
    "attachments": "bug_id long, index int, id long, summary string, file_name string, is_patch boolean, downloaded boolean",
}


def prepare_inputs(store: Store, root: str | None = None, comment_chars: int = 30_000, program_chars: int = 120_000) -> dict:
    """Reports with comments, programs and attachments to table ``inputs``; with a folder, a JSON file a report as well."""
    store.write("inputs", inputs.prepared_inputs(store.read("reports"), *[store.read(n, schema) for n, schema in _PARTS.items()], comment_chars, program_chars))
    done = store.read("inputs")
    counts = counts_of(inputs.input_counts(done))
    if root is not None:
        path = F.concat(F.lit("inputs/bug-"), "bug_id", F.lit(".input.json"))
        counts["files"] = named_files.write_files(done.select(path.alias("path"), row_json(*sorted(done.columns)).alias("content")), root).count()
    return counts


def write_prompts(store: Store, system: str, task: str, contract: object, most_chars: int = 120_000) -> dict:
    """Inputs to table ``prompts`` (id, prompt), within a budget."""
    records = materialize(inputs.prompt_records(store.read("inputs"), most_chars), "records")
    store.write("prompts", inputs.chat(records, system, task, contract))
    return counts_of(records.agg(F.count("*").alias("prompts"), F.count_if(F.col("step") > 0).alias("compacted"), F.count_if(F.col("over")).alias("over")))


def verify_archive(spark: SparkSession, root: str, scope: str | None = None) -> dict:
    """Judge an archive folder by its rules, or those of another scope; any violation is an error that shows the first ones."""
    tables = archive.archive_tables(spark, root)
    row = tables["manifest"].select("corpus_scope").first()
    found = archive.archive_violations(tables, scope or (row and row["corpus_scope"]) or "loongarch")
    connectors.gate(found, "the archive breaks a rule")
    lists = [n for n in archive.LISTS if f"{n}_list" in tables]
    return {"reports": tables["index"].count(), "testcases": tables["testcases"].count()} | {n: tables[f"{n}_list"].count() for n in lists}


def iterate(store: Store, rounds: int, batch: int, step: Callable[[Store, int], None], seed: int = 20260730) -> list[dict]:
    """Rounds of drawing, running and learning: ``step`` answers and evaluates what a round has drawn. One summary a round."""
    out, before = [], 0
    for i in range(rounds):
        drawn = prepare(store, batch, seed=seed + i, append=True)
        step(store, i)
        after = run_feedback(store)
        out.append({"iteration": i + 1, "new_candidates": drawn["new"], "union_edges_before": before, "union_edges_after": after["union_edges"], "delta": after["union_edges"] - before})
        before = after["union_edges"]
    return out
