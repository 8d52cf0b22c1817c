"""Instantiations of groups: which groups to take, defaults for what a model left out, names of programs, covered corpora."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernflow.functions.text import canonical_language, flat_hash, string_list

# File endings by language, and how texts mention vector extensions.
LANGUAGE_EXTENSIONS = {"c": ".c", "c++": ".cc", "cpp": ".cc", "cxx": ".cc", "asm": ".s", "fortran": ".f90", "ada": ".adb", "d": ".d", "cobol": ".cob", "shell": ".sh", "rtl": ".rtl"}
VECTOR_WORDS = r"(?im)\b(?:vectoriz(?:e|ed|es|ing|ation)?|vector|simd)\b|(?:^|[/_.-])vect(?:[/_.-]|$)|\bvec_"
UNSAFE = r"[^A-Za-z0-9_.-]+"

INSTANTIATION = (
    "group_uid string, candidate_id string, instantiation_status string, language string, program_title string, file_name string, compiler_options array<string>, source_code string, "
    "oracle string, coverage_intent string, preservation_checklist array<struct<feature_uid: string, implemented_by: string>>, build_notes array<string>, rejection_reasons array<string>, confidence double, notes string"
)


def select_groups(groups: DataFrame, ids: Sequence[str] = (), languages: Sequence[str] = (), limit: int = 0, order: str = "pos") -> DataFrame:
    """Rows of ``groups`` (group_uid, candidate_id, language, ``order``) that one of ``ids`` names as group or candidate and
    whose language is one of ``languages``, the first ``limit`` in order if it is not 0. Ids that match nothing are an error."""
    out = groups
    if ids:
        wanted = [str(i) for i in ids]
        out = out.where(F.coalesce("group_uid", F.lit("")).isin(wanted) | F.coalesce("candidate_id", F.lit("")).isin(wanted))
    if languages:
        spark = groups.sparkSession
        allowed = [r[0] for r in spark.createDataFrame([(x,) for x in languages], "x string").select(canonical_language(F.col("x"))).collect()]
        out = out.where(canonical_language(F.col("language")).isin(allowed))
    if limit:
        out = out.orderBy(order).limit(limit)
    if ids and out.isEmpty():
        raise ValueError(f"no groups matched requested ids: {sorted(set(map(str, ids)))}")
    return out


def _or(c: Column, default: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", default).otherwise(c)


#: What comes along from a group under another name, where the group has it.
FROM_GROUP = {"source_features_sha256": "source_features_sha256", "group_test_mode": "test_mode"}


def provenance(response: Column, model: str, base_url: str, at: Column) -> Column:
    """Who made a result: the model, its address, and id and usage of its answer (JSON, ``{}`` where it has none)."""
    usage = F.get_json_object(response, "$.usage")
    return F.struct(
        F.lit(model).alias("model"), F.lit(base_url.rstrip("/")).alias("base_url"), F.get_json_object(response, "$.id").alias("response_id"), at.alias("created_at"),
        F.when(usage.startswith("{"), usage).otherwise("{}").alias("usage"), F.lit(False).alias("api_key_persisted"),
    )


def normalize_instantiation(raw: Column, group: Column, carried: Mapping[str, str] | None = None, by: Column | None = None) -> Column:
    """An instantiation from a model's JSON, with the group's values for what is missing (group_uid, candidate_id, language,
    target_options, source_feature_uids) and its id: the candidate's with a hash of source and options.

    ``oracle`` and ``coverage_intent`` stay as the model's JSON, ``{}`` where there is none, and ``oracle_kind`` is the oracle's.
    ``carried`` names fields of the result by the group's fields that they take, as ``FROM_GROUP``; ``by`` becomes ``generated_by``.
    """
    p = F.from_json(raw, INSTANTIATION)
    none = F.array().cast("array<string>")
    options = F.coalesce(p["compiler_options"], group["target_options"], none)
    source = F.coalesce(p["source_code"], F.lit(""))
    fields = {
        "group_uid": _or(p["group_uid"], group["group_uid"]),
        "candidate_id": _or(p["candidate_id"], group["candidate_id"]),
        "instantiation_status": F.lower(_or(p["instantiation_status"], F.lit("ready"))),
        "language": canonical_language(_or(p["language"], group["language"])),
        "program_title": F.coalesce(p["program_title"], F.lit("")),
        "file_name": F.coalesce(p["file_name"], F.lit("")),
        "compiler_options": options,
        "source_code": source,
        "preservation_checklist": F.coalesce(p["preservation_checklist"], F.array().cast("array<struct<feature_uid: string, implemented_by: string>>")),
        "build_notes": F.coalesce(p["build_notes"], none),
        "rejection_reasons": F.coalesce(p["rejection_reasons"], none),
        "confidence": F.coalesce(p["confidence"], F.lit(0.0)),
        "notes": F.coalesce(p["notes"], F.lit("")),
        "source_feature_uids": string_list(group["source_feature_uids"]),
        "instantiation_id": F.concat_ws("-", group["candidate_id"], flat_hash(16, source=source, options=options)),
        "oracle": F.coalesce(p["oracle"], F.lit("{}")),
        "oracle_kind": F.get_json_object(p["oracle"], "$.kind"),
        "coverage_intent": F.coalesce(p["coverage_intent"], F.lit("{}")),
        "group_target_options": F.coalesce(group["target_options"], none),
        **{name: group[theirs] for name, theirs in (carried or {}).items()},
    }
    if by is not None:
        fields["generated_by"] = by
    return F.when(p.isNotNull(), F.struct(*[v.alias(k) for k, v in fields.items()]))


def safe_name(c: Column) -> Column:
    """A name with runs of characters that file names should not have as one underscore."""
    return F.regexp_replace(c, UNSAFE, "_")


def fallback_id(instantiation_id: Column, candidate_id: Column, group_uid: Column, status: Column) -> Column:
    """The instantiation's own id made safe, or the first of candidate and group with a hash of what is known."""
    own = F.trim(F.coalesce(instantiation_id, F.lit("")))
    stem = _or(candidate_id, _or(group_uid, F.lit("instantiation")))
    stem = _or(safe_name(F.trim(stem)), F.lit("instantiation"))
    return F.when(own != "", safe_name(own)).otherwise(F.concat_ws("-", stem, flat_hash(16, group_uid=group_uid, candidate_id=candidate_id, status=status)))


def program_files(done: DataFrame) -> DataFrame:
    """(instantiation_id, path, content, bytes, sha256) of programs (instantiation_id, candidate_id, group_uid,
    instantiation_status, language, file_name, source_code): a safe name, and a source that ends with a line break."""
    c = F.col
    name = fallback_id(c("instantiation_id"), c("candidate_id"), c("group_uid"), c("instantiation_status"))
    base = F.regexp_extract(F.trim(F.coalesce("file_name", F.lit(""))), r"([^/]*)/*$", 1)
    stem = F.when(base.rlike(r"^.+\.[^.]+$"), F.regexp_replace(base, r"\.[^.]+$", "")).otherwise(base)
    endings = F.create_map(*[F.lit(x) for pair in LANGUAGE_EXTENSIONS.items() for x in pair])
    ending = F.coalesce(endings[canonical_language(c("language"))], F.lit(".txt"))
    source = F.coalesce("source_code", F.lit(""))
    content = F.when(source.endswith("\n"), source).otherwise(F.concat(source, F.lit("\n")))
    rows = done.select(name.alias("instantiation_id"), stem.alias("stem"), ending.alias("ending"), content.alias("content"))
    path = F.concat(F.lit("programs/"), "instantiation_id", F.lit("."), safe_name(_or(c("stem"), c("instantiation_id"))), "ending")
    return rows.select("instantiation_id", path.alias("path"), "content", F.octet_length("content").alias("bytes"), F.sha2(F.col("content").cast("binary"), 256).alias("sha256"))


def _suffix(path: str) -> Column:
    return F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]+)$", 1)


def covered_corpus(evaluations: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, target, sha256) of covered evaluations (evaluation_status, instantiation_id, source_path) whose source is in
    ``sources`` (path, sha256); without one a row counts for nothing."""
    covered = evaluations.where("evaluation_status = 'covered'")
    rows = covered.join(sources, covered["source_path"] == sources["path"])
    return rows.select(F.col("source_path").alias("source"), F.concat("instantiation_id", _suffix("source_path")).alias("target"), "sha256")


def seed_corpus(evaluations: DataFrame, ready: DataFrame, groups: DataFrame, sources: DataFrame, language: str) -> tuple[DataFrame, DataFrame]:
    """Seeds for a fuzzer: files (source, target, candidate_id, group_uid, language) of covered evaluations of ``ready``
    candidates (candidate_id) in one language, and the distinct (kind, id) that they stand for: candidates, groups, features.

    ``groups`` (group_uid, candidate_id, pos, source_feature_uids): a group is found by its id, else by the candidate's."""
    names = ["c++", "cpp", "cxx"] if language == "c++" else [language]
    spoken = F.when(F.coalesce("language", F.lit("")) == "", F.lit("c")).otherwise(F.col("language"))
    rows = evaluations.where("evaluation_status = 'covered'").where(spoken.isin(names)).join(ready.select("candidate_id").distinct(), "candidate_id", "left_semi")
    rows = rows.join(sources.select(F.col("path").alias("source_path")).distinct(), "source_path", "left_semi")
    name = _or(F.col("instantiation_id"), F.col("candidate_id"))
    ending = _or(_suffix("source_path"), F.lit(".cc" if language == "c++" else ".c"))
    files = rows.select(F.col("source_path").alias("source"), F.concat(name, ending).alias("target"), "candidate_id", F.coalesce("group_uid", F.lit("")).alias("group_uid"), F.lit(language).alias("language"))
    index = groups.select(F.explode(F.array("group_uid", "candidate_id")).alias("key"), "pos", "source_feature_uids").where("key <> ''")
    index = index.groupBy("key").agg(F.max_by("source_feature_uids", "pos").alias("uids"))
    own = files.join(index.select(F.col("key").alias("group_uid"), F.col("uids").alias("a")), "group_uid", "left").join(index.select(F.col("key").alias("candidate_id"), F.col("uids").alias("b")), "candidate_id", "left")
    features = own.select(F.explode(F.coalesce("a", "b")).alias("id")).where("id <> ''")
    pair = lambda df, kind, c: df.select(F.lit(kind).alias("kind"), F.col(c).alias("id"))
    stood = pair(files, "candidate", "candidate_id").unionByName(pair(files.where("group_uid <> ''"), "group", "group_uid")).unionByName(pair(features, "feature", "id"))
    return files, stood.distinct()


def vector_mentions(reports: DataFrame, lsx: str, lasx: str) -> DataFrame:
    """(scope, extension, reports): distinct reports (bug_id, search_text, llm_ready, expanded_llm_ready) that mention an
    extension, by scope (all, core, expanded); ``vector`` counts either extension and vector words."""
    text = F.coalesce("search_text", F.lit(""))
    one, two = text.rlike(lsx), text.rlike(lasx)
    scopes = F.array_compact(F.array(F.lit("all"), F.when(F.col("llm_ready"), F.lit("core")), F.when(F.col("expanded_llm_ready"), F.lit("expanded"))))
    kinds = F.array_compact(F.array(F.when(one, F.lit("lsx")), F.when(two, F.lit("lasx")), F.when(one | two | text.rlike(VECTOR_WORDS), F.lit("vector"))))
    rows = reports.select("bug_id", scopes.alias("scopes"), kinds.alias("kinds")).select("bug_id", "kinds", F.explode("scopes").alias("scope"))
    return rows.select("bug_id", "scope", F.explode("kinds").alias("extension")).groupBy("scope", "extension").agg(F.count_distinct("bug_id").alias("reports"))


def first_errors(errors: DataFrame, by: str, key: str, most: int = 50) -> DataFrame:
    """(``by``, n, ids): how many distinct ``key`` an error has, and the first ``most`` of them; sets are cut before they
    are gathered, so a common error is no large row."""
    from pyspark.sql import Window as W

    rows = errors.select(by, key).distinct()
    counts = rows.groupBy(by).agg(F.count("*").alias("n"))
    ranked = rows.withColumn("at", F.row_number().over(W.partitionBy(by).orderBy(key))).where(F.col("at") <= most)  # the planner keeps the first rows of a window ahead of the shuffle
    return ranked.groupBy(by).agg(F.array_sort(F.collect_list(key)).alias("ids")).join(counts, by).select(by, "n", "ids")


def chat_endpoint(base_url: str) -> str:
    """The address that chat requests go to."""
    base = base_url.strip().rstrip("/")
    if not base:
        raise ValueError("the endpoint is empty")
    return base if base.endswith("/chat/completions") else f"{base}/chat/completions"


def csv_values(value: str) -> list[str]:
    """Values between commas, of which there must be one."""
    found = [item.strip() for item in value.split(",") if item.strip()]
    if not found:
        raise ValueError("expected at least one comma-separated value")
    return found
