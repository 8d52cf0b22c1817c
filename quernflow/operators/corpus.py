"""Reports: testcases in comments, fix history, prompts within a budget, pools of features, first and last rows, violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quernflow.functions import text as T

FENCED = r"(?s)```\s*([A-Za-z0-9_+.-]*)\s*\n(.*?)```"

#: Budgets of a prompt from wide to narrow: comments, their characters, fix entries, theirs, programs, theirs, all programs'.
LADDER = (
    (12, 8000, 8, 12000, 8, 50000, 100000),
    (8, 5000, 6, 8000, 6, 30000, 70000),
    (6, 2500, 5, 5000, 4, 20000, 40000),
    (4, 1500, 4, 3000, 3, 10000, 25000),
    (2, 1000, 3, 2000, 2, 6000, 12000),
)


def comment_testcases(comments: DataFrame, fence: str = FENCED) -> DataFrame:
    """(bug_id, comment_number, kind, block_number, language, content) from comments (bug_id, count, text).

    Fenced blocks of 20 characters or more; comments without any fence but with words and signs of a program count whole.
    ``fence`` has a group for the language and one for the code.
    """
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "\r\n", "\n")
    base = comments.select("bug_id", F.col("count").alias("comment_number"), text.alias("text"))
    zipped = F.arrays_zip(F.regexp_extract_all("text", F.lit(fence), F.lit(1)).alias("hint"), F.regexp_extract_all("text", F.lit(fence), F.lit(2)).alias("code"))
    base = base.withColumn("blocks", zipped)
    blocks = base.select("bug_id", "comment_number", F.posexplode("blocks").alias("pos", "b"))
    code = F.concat(F.btrim("b.code", F.lit(" \t\n\r\x0b\x0c")), F.lit("\n"))
    named = T.language_for(F.lit(""), F.lit(""), F.col("b.hint"))
    fenced = blocks.select("bug_id", "comment_number", F.lit("comment_code_block").alias("kind"), (F.col("pos") + 1).alias("block_number"), named.alias("named"), code.alias("content")).where(F.length("content") >= 20)
    fenced = fenced.withColumn("language", F.when(F.col("named") == "unknown", T.language_for_content(F.col("content"))).otherwise(F.col("named"))).drop("named")
    semicolons = F.length("text") - F.length(F.replace("text", F.lit(";"), F.lit("")))
    signs = (semicolons >= 2) | F.col("text").rlike(r"\b(?:gcc|g\+\+|cc1|cc1plus)\b[^\n]*\s-[A-Za-z0-9]") | F.col("text").rlike(r"\b(?:int|void|struct|class|enum|template)\s+[A-Za-z_]")
    whole = base.where((F.size("blocks") == 0) & F.col("text").rlike(T.REPRO_WORD) & signs & (F.length("text") >= 40))
    whole = whole.select("bug_id", "comment_number", F.lit("comment_reproducer").alias("kind"), F.lit(1).alias("block_number"), F.concat(F.btrim("text", F.lit(" \t\n\r\x0b\x0c")), F.lit("\n")).alias("content"), T.language_for_content(F.col("text")).alias("language"))
    return fenced.unionByName(whole)


def fix_history(comments: DataFrame, attachments: DataFrame | None = None) -> DataFrame:
    """(bug_id, evidence_count, commit_hashes) from comments (bug_id, count, text) and attachments (bug_id, summary,
    file_name, is_patch): hashes in order of first mention."""
    hits = comments.where(T.is_fix_comment(F.col("text"))).select("bug_id", F.col("count").alias("pos"), T.commit_hashes(F.col("text")).alias("h"))
    if attachments is not None:
        proof = attachments.where(T.attachment_is_fix_evidence(F.col("summary"), F.col("file_name"), F.col("is_patch")))
        hits = hits.unionByName(proof.select("bug_id", F.lit(None).cast(hits.schema["pos"].dataType).alias("pos"), F.array().cast("array<string>").alias("h")))
    ordered = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "h"))))
    return hits.groupBy("bug_id").agg(F.count("*").alias("evidence_count"), F.array_distinct(F.flatten(F.transform(ordered, lambda x: x["h"]))).alias("commit_hashes"))


def compact_comments(comments: Column, fix_counts: Column, most: int, chars: int) -> Column:
    """Comments (array of structs count, text, attachment_id) for a prompt: the first and last three, fixes and
    attachments, filled up in order to ``most``; texts clipped to ``chars``."""
    n = F.size(comments)
    marked = F.transform(comments, lambda x, i: F.struct(i.alias("i"), ((i < 3) | (i >= F.greatest(n - 3, F.lit(0))) | F.array_contains(fix_counts, x["count"]) | x["attachment_id"].isNotNull()).alias("must"), x.alias("c")))
    must = F.filter(marked, lambda m: m["must"])
    rest = F.filter(marked, lambda m: ~m["must"])
    fill = F.slice(rest, 1, F.greatest(F.lit(most) - F.size(must), F.lit(0)))
    chosen = F.slice(F.array_sort(F.concat(must, fill), lambda a, b: a["i"] - b["i"]), 1, most)
    return F.transform(chosen, lambda m: F.struct(m["c"]["count"].alias("count"), T.clip(m["c"]["text"], chars).alias("text"), T.is_clipped(m["c"]["text"], chars).alias("truncated_for_prompt")))


def compact_programs(programs: Column, most: int, chars: int, total: int) -> Column:
    """Program texts (array of strings) for a prompt: a fold that shares what is left of ``total`` among those to come."""
    chosen = F.slice(programs, 1, most)
    n = F.size(chosen)
    marker = F.lit(T.CLIP_MARKER)

    def step(state, p):
        slots = F.greatest(n - F.size(state["out"]), F.lit(1))
        budget = F.greatest(F.lit(1000), F.least(F.lit(chars), F.floor(state["left"] / slots).cast("int")))
        keep = budget - F.length(marker)
        half = F.floor(keep / 2).cast("int")
        cut = F.when(F.length(p) <= budget, p).otherwise(F.concat(F.left(p, half), marker, F.right(p, keep - half)))
        return F.struct(F.greatest(state["left"] - F.length(cut), F.lit(0)).alias("left"), F.array_append(state["out"], cut).alias("out"))

    start = F.struct(F.lit(total).alias("left"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(chosen, start, step, lambda s: s["out"])


def prompt_ladder(record: DataFrame, most_chars: int = 120_000) -> DataFrame:
    """(bug_id, step, prompt): the record as JSON if it fits, else by the first step of the ladder that fits, else the last.

    ``record`` has bug_id, description, comments (array of structs), fix_counts (array), programs (array of strings).
    ``step`` is 0 for the whole record; 6 says that even the last step is over the budget.
    """
    def packed(comments, programs):
        return F.to_json(F.struct("bug_id", "description", comments.alias("comments"), programs.alias("programs")))

    out = record.withColumn("p0", packed(F.col("comments"), F.col("programs")))
    for i, (a, b, _, _, e, f, g) in enumerate(LADDER, 1):
        out = out.withColumn(f"p{i}", packed(compact_comments(F.col("comments"), F.col("fix_counts"), a, b), compact_programs(F.col("programs"), e, f, g)))
    step = lambda n, source: F.struct(F.lit(n).alias("step"), F.col(source).alias("prompt"))
    choice = F.when(F.length("p0") <= most_chars, step(0, "p0"))
    for i in range(1, len(LADDER) + 1):
        choice = choice.when(F.length(f"p{i}") <= most_chars, step(i, f"p{i}"))
    choice = choice.otherwise(step(len(LADDER) + 1, f"p{len(LADDER)}"))
    return out.select("bug_id", choice.alias("c")).select("bug_id", "c.step", "c.prompt")


def feature_pool(outputs: DataFrame) -> DataFrame:
    """One normalised record per feature of model outputs (bug_id, source_url, root_cause_summary, features: array of structs).

    ``feature_uid`` is made of the bug, the feature's id and a hash of what it says.
    """
    f = F.col("f")
    text = lambda c, d: F.when(F.coalesce(c, F.lit("")) == "", F.lit(d)).otherwise(c)
    rows = outputs.select("bug_id", "source_url", F.coalesce("root_cause_summary", F.lit("")).alias("root_cause_summary"), F.explode("features").alias("f")).where("f is not null")
    mark = T.flat_hash(16, bug_id=F.col("bug_id"), feature_id=f["feature_id"], description=f["description"], code_witness=f["code_witness"])
    uid = F.concat(F.lit("bug-"), F.col("bug_id").cast("string"), F.lit("-"), F.coalesce(f["feature_id"], F.lit("F")), F.lit("-"), mark)
    lists = {n: F.coalesce(f[n], F.array().cast("array<string>")).alias(n) for n in ("target_options", "mutation_knobs", "composition_tags")}
    return rows.select(
        uid.alias("feature_uid"), "bug_id", "source_url", "root_cause_summary", f["feature_id"].alias("feature_id"),
        text(f["feature_type"], "semantic_invariant").alias("feature_type"), F.coalesce(f["description"], F.lit("")).alias("description"),
        F.coalesce(f["code_witness"], F.lit("")).alias("code_witness"), text(f["witness_kind"], "exact_poc").alias("witness_kind"),
        text(f["evidence_strength"], "medium").alias("evidence_strength"), text(f["language"], "unknown").alias("language"),
        text(f["compiler_area"], "other").alias("compiler_area"), text(f["failure_mode"], "other").alias("failure_mode"), *lists.values(),
        F.coalesce(f["root_cause_link"], F.lit("")).alias("root_cause_link"), f["confidence"].alias("confidence"),
    )


def load_pool(pool: DataFrame, languages, least_confidence: float = 0.0) -> DataFrame:
    """Eligible features: allowed language, a description, enough confidence (0.5 where it is missing). A repeated
    feature_uid is an error, and so is a pool of which nothing is left."""
    if not pool.groupBy("feature_uid").count().where("count > 1").isEmpty():
        raise ValueError("a feature_uid occurs twice in the pool")
    out = pool.where(T.canonical_language(F.col("language")).isin(*languages) & ~T.blank(F.col("description")) & (F.coalesce(F.col("confidence").cast("double"), F.lit(0.5)) >= least_confidence))
    if out.isEmpty():
        raise ValueError("no eligible features remained")
    return out


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key; a window sort, or a ``min_by`` where rows are narrow."""
    return df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def last_by(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The row of each key with the greatest position, aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), pos).alias("r")).select(*keys, "r.*")


def tail(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def most_common(df: DataFrame, keys: list[str], value: str, pos: str, unknown: str = "unknown") -> DataFrame:
    """(keys, value) with the most frequent value of each key, ties to the one seen first; only ``unknown`` values count
    for nothing, and a key that has no other gets ``unknown``."""
    counts = df.where(F.coalesce(F.col(value), F.lit(unknown)) != unknown).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(pos).alias("p"))
    best = counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n"), F.col("p"))).alias(value))
    return df.select(*keys).distinct().join(best, keys, "left").fillna(unknown, [value])


def set_mismatch(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side) of rows in one of two sets only."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.join(y, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, keys, "left_anti").withColumn("side", F.lit("right")))


def corpus_index(reports: DataFrame) -> DataFrame:
    """Flat index of reports: lists joined by semicolons, newest change first."""
    lists = {n: F.array_join(n, ";").alias(n) for n, kind in reports.dtypes if kind == "array<string>"}
    return reports.select(*[lists.get(n, F.col(n)) for n in reports.columns]).orderBy(F.desc("last_change_time"), F.desc("bug_id"))


def stale(metadata: DataFrame, cache: DataFrame) -> DataFrame:
    """Reports to fetch again: not in the cache (bug_id, last_change_time, schema_version = 3) as they are now."""
    good = cache.where("schema_version = 3").select("bug_id", "last_change_time")
    return metadata.join(good, ["bug_id", "last_change_time"], "left_anti")


def discover(found: DataFrame, limit: int = 0) -> DataFrame:
    """Reports of several searches (pos, source, bug_id, last_change_time): the last row of each bug with all its sources,
    newest first, as many as ``limit`` says if it is not 0."""
    sources = found.groupBy("bug_id").agg(F.array_sort(F.collect_set("source")).alias("discovery_sources"))
    out = last_by(found.drop("source"), ["bug_id"], "pos").join(sources, "bug_id").orderBy(F.desc("last_change_time"), F.desc("bug_id"))
    return out.limit(limit) if limit else out
