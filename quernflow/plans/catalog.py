"""Queries over the driver tables, each with the SQL that says the same.

The tables stand in for the pipeline's records: documents for reports, conversations for comments, lineitem for edge maps and
features of groups, orders for groups, part and supplier for features, events for evaluations. Where a rule needs words that
the tables lack, a phrase from a short list is added by a key, alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernflow.functions import classify as K
from quernflow.functions import features as X
from quernflow.functions import text as T
from quernflow.operators import corpus as C
from quernflow.operators import coverage as V
from quernflow.operators import feedback as B
from quernflow.operators import groups as G
from quernflow.operators import instantiation as I
from quernflow.operators import pairs as P
from quernflow.scratch import fresh_path
from quernflow.session import table
from quernflow.sources import files as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return keep


def pick(values: list[str], key: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.expr(key), F.lit(len(values))) + 1).cast("int"))


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick_sql(values: list[str], key: str) -> str:
    return f"([{', '.join(map(q, values))}])[({key} % {len(values)}) + 1]"


def words_sql(values) -> str:
    return "[" + ", ".join(map(q, values)) + "]"


# ---------------------------------------------------------------- coverage feedback


@query("""
WITH s AS (SELECT DISTINCT l_orderkey AS seq, l_partkey AS edge FROM lineitem),
n AS (SELECT seq, count(*) AS new_edges FROM (SELECT edge, min(seq) AS seq FROM s GROUP BY edge) GROUP BY seq),
e AS (SELECT seq, count(*) AS edge_entries FROM s GROUP BY seq)
SELECT e.seq, edge_entries, coalesce(new_edges, 0) AS new_edges, round(coalesce(new_edges, 0) / edge_entries, 6) AS new_edge_ratio,
  (sum(coalesce(new_edges, 0)) OVER (ORDER BY e.seq))::BIGINT AS union_edges_after
FROM e LEFT JOIN n ON n.seq = e.seq""")
def edge_union_novelty(spark, sf):
    return B.edge_novelty(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("seq"), F.col("l_partkey").alias("edge_id")))


REWARD_ROWS_SQL = """
s AS (SELECT DISTINCT l_orderkey AS seq, l_partkey AS edge FROM lineitem),
n AS (SELECT seq, count(*) AS new_edges FROM (SELECT edge, min(seq) AS seq FROM s GROUP BY edge) GROUP BY seq),
e AS (SELECT seq, count(*) AS edge_entries FROM s GROUP BY seq),
u AS (SELECT DISTINCT l_orderkey AS seq, l_suppkey AS uid FROM lineitem),
k AS (SELECT seq, count(*) AS uids FROM u GROUP BY seq),
r AS (SELECT u.uid, e.edge_entries, coalesce(n.new_edges, 0) AS new_edges, coalesce(n.new_edges, 0) / k.uids AS share
  FROM u JOIN e ON e.seq = u.seq JOIN k ON k.seq = u.seq LEFT JOIN n ON n.seq = u.seq),
g AS (SELECT uid AS feature_uid, count(*) AS covered_group_count, count(*) FILTER (new_edges > 0) AS novel_group_count,
  sum(edge_entries)::BIGINT AS edge_entries_sum, round(sum(share), 3) AS new_edges_sum, max(new_edges) AS max_group_new_edges FROM r GROUP BY uid)"""


@query(f"WITH {REWARD_ROWS_SQL} SELECT *, round(new_edges_sum + 25.0::DOUBLE * novel_group_count + 0.001::DOUBLE * edge_entries_sum, 3) AS reward_score FROM g")
def feature_reward(spark, sf):
    items = table(spark, sf, "lineitem")
    novelty = B.edge_novelty(items.select(F.col("l_orderkey").alias("seq"), F.col("l_partkey").alias("edge_id")))
    uids = items.groupBy(F.col("l_orderkey").alias("seq")).agg(F.collect_set("l_suppkey").alias("source_feature_uids"))
    none = F.array().cast("array<string>")
    rows = novelty.join(uids, "seq").withColumn("candidate_ids", none).withColumn("group_uids", none)
    return B.feature_rewards(rows).drop("candidate_ids", "group_uids")


@query("""
WITH o AS (SELECT DISTINCT l_partkey AS e FROM lineitem WHERE l_returnflag = 'A'), n AS (SELECT DISTINCT l_partkey AS e FROM lineitem WHERE l_returnflag = 'R')
SELECT (SELECT count(*) FROM (SELECT e FROM n EXCEPT SELECT e FROM o)) AS added, (SELECT count(*) FROM (SELECT e FROM o EXCEPT SELECT e FROM n)) AS lost,
  (SELECT count(*) FROM (SELECT e FROM o INTERSECT SELECT e FROM n)) AS common""")
def edge_map_diff(spark, sf):
    maps = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_partkey").alias("edge_id"))
    return B.map_diff(maps.where("l_returnflag = 'A'"), maps.where("l_returnflag = 'R'"))


@query("SELECT l_suppkey AS map_id, count(*) AS edge_map_entries, count(DISTINCT l_partkey) AS distinct_edges FROM lineitem GROUP BY l_suppkey")
def edge_map_entries_vs_distinct(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("map_id")).agg(F.count("*").alias("edge_map_entries"), F.count_distinct("l_partkey").alias("distinct_edges"))


@query("""
WITH e AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT min(n) AS min, max(n) AS max, round(avg(n), 1) AS avg, round(median(n), 1) AS median FROM e""")
def edge_summary_stats(spark, sf):
    return V.edge_summary(table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("edge_map_entries")))


LANGS = ["c", "c++", "fortran", "c", "asm"]


@query(f"""
WITH g AS (SELECT o_orderkey, {pick_sql(LANGS, "o_orderkey")} AS language FROM orders),
i AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'ready' ELSE 'rejected' END AS status FROM orders WHERE o_orderstatus <> 'O'),
x AS (SELECT (SELECT count(*) FROM g) AS ready_groups, (SELECT count(*) FROM g WHERE language IN ('c', 'c++')) AS c_cpp_ready_groups,
  (SELECT count(DISTINCT o_orderkey) FROM i) AS selected_groups, (SELECT count(*) FROM i WHERE status = 'ready') AS instantiated_ready,
  (SELECT count(*) FROM events WHERE event_type = 'purchase') AS covered)
SELECT *, round(100.0::DOUBLE * selected_groups / c_cpp_ready_groups, 2) AS selection_rate, round(100.0::DOUBLE * instantiated_ready / selected_groups, 2) AS generation_rate,
  round(100.0::DOUBLE * covered / instantiated_ready, 2) AS covered_rate, round(100.0::DOUBLE * covered / selected_groups, 2) AS end_to_end_rate,
  round(100.0::DOUBLE * covered / ready_groups, 2) AS overall_rate FROM x""")
def report_funnel(spark, sf):
    orders = table(spark, sf, "orders")
    groups = orders.select(F.col("o_orderkey").alias("group_uid"), pick(LANGS, "o_orderkey").alias("language"))
    made = orders.where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("group_uid"), F.when(F.col("o_orderstatus") == "F", "ready").otherwise("rejected").alias("status"))
    ran = table(spark, sf, "events").select(F.when(F.col("event_type") == "purchase", "covered").otherwise("coverage_failed").alias("status"))
    return V.funnel(groups, made, ran)


@query("""
SELECT 'lang' AS dimension, coalesce(lang, 'unknown') AS value, count(*) AS n FROM documents GROUP BY 2
UNION ALL SELECT 'source', coalesce(source, 'unknown'), count(*) FROM documents GROUP BY 2""")
def status_histogram_sets(spark, sf):
    return V.histograms(table(spark, sf, "documents"), "lang", "source")


STATUS = ["covered", "covered", "ice", "timeout", "covered"]


@query("""
WITH e AS (SELECT event_id, CASE event_type WHEN 'signup' THEN FALSE ELSE TRUE END AS ready,
  CASE WHEN event_id % 7 = 0 THEN 'fortran' ELSE 'c' END AS language, event_type = 'error' AND value > 15 AS timed_out,
  CASE event_type WHEN 'error' THEN 4 WHEN 'click' THEN 1 ELSE 0 END AS returncode, CASE WHEN value > 20 THEN 0 ELSE 3 END AS edges FROM events)
SELECT CASE WHEN NOT ready THEN 'skipped_not_ready' WHEN language NOT IN ('c', 'c++') THEN 'skipped_unsupported_language' WHEN timed_out THEN 'timeout'
  WHEN returncode = 4 THEN 'ice' WHEN returncode <> 0 AND edges = 0 THEN 'compile_failed' WHEN returncode = 0 AND edges >= 1 THEN 'covered'
  ELSE 'coverage_failed' END AS evaluation_status, count(*) AS n FROM e GROUP BY 1""")
def evaluation_status(spark, sf):
    e = table(spark, sf, "events")
    code = F.when(F.col("event_type") == "error", 4).when(F.col("event_type") == "click", 1).otherwise(0)
    language = F.when(F.col("event_id") % 7 == 0, "fortran").otherwise("c")
    status = K.evaluation_status(F.col("event_type") != "signup", language, (F.col("event_type") == "error") & (F.col("value") > 15), code, F.when(F.col("value") > 20, 0).otherwise(3))
    return e.select(status.alias("evaluation_status")).groupBy("evaluation_status").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- classifiers

SUMMARIES = ["LoongArch: ICE with LSX", "wrong code at -O3", "[15 regression] internal compiler error: in foo", "missed optimization on aarch64", "loongarch64-linux crash", "xloongarchy is no match"]
TARGETS = ["", "loongarch64-*-*", "aarch64, loongarch64, x86_64", "x86_64-linux-gnu"]
EDGE = "(^|[^A-Za-z0-9_])"
ARCH_SQL = f"(?i){EDGE}loongarch(64|32)?([^A-Za-z0-9_]|$)"
OTHER_SQL = f"(?i){EDGE}(x86_64|i[3-6]86|aarch64|arm(64)?|mips|powerpc|ppc(64)?|riscv|s390x?|sparc|alpha|ia64|hppa|m68k|nvptx|amdgcn|bpf|sh[0-9]?)([^A-Za-z0-9_]|$)"


@query(f"""
WITH d AS (SELECT doc_id, {pick_sql(SUMMARIES, "doc_id")} AS s, {pick_sql(TARGETS, "doc_id")} AS t FROM documents),
m AS (SELECT *, regexp_matches(s, '{ARCH_SQL}') AS sa, regexp_matches(t, '{ARCH_SQL}') AS ta, regexp_matches(t, '{OTHER_SQL}') AS o FROM d)
SELECT doc_id, CASE WHEN sa OR (ta AND NOT o) THEN 'architecture_specific' WHEN ta THEN 'multi_arch_shared' ELSE 'not_loongarch' END AS tier,
  CASE WHEN sa THEN 'summary_mentions_loongarch' WHEN ta AND NOT o THEN 'gcc_target_is_loongarch' WHEN ta THEN 'gcc_target_includes_loongarch_and_other_architectures'
  ELSE 'no_summary_or_target_evidence' END AS reason FROM m""")
def relevance_tier(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", K.relevance(pick(SUMMARIES, "doc_id"), pick(TARGETS, "doc_id")).alias("r")).select("doc_id", "r.tier", "r.reason")


NOTES = [
    "This ICE is reproducible on loongarch64-linux-gnu.", "Bootstrapped and regtested on loongarch64.", "Nothing to see here.",
    "A crash happens. " + "x" * 400 + " seen with lsx only", "fails with -mlasx", "tested on loongarch: the hang is gone",
]
FAIL_SQL = r"\b(ice|internal compiler error|wrong code|miscompil(e|ation)|fails?|failure|hang|crash|segfault|unrecognizable|missed optimization|reproducer|timeout|abort)\b"
NEAR_SQL = r"(\bloongarch(64|32)?\b|(\b|-m)(lsx|lasx)\b)"
VALID_SQL = K.ARCH_VALIDATION.removeprefix("(?i)")


@query(f"""
WITH d AS (SELECT conv_id, turn, regexp_replace({pick_sql(NOTES, "(conv_id + turn)")}, {q(VALID_SQL)}, ' ', 'gi') AS t FROM conversations)
SELECT conv_id, turn, regexp_matches(t, {q(FAIL_SQL + ".{0,320}" + NEAR_SQL + "|" + NEAR_SQL + ".{0,320}" + FAIL_SQL)}, 'is') AS near FROM d""")
def failure_near_arch(spark, sf):
    c = table(spark, sf, "conversations").withColumn("k", F.col("conv_id") + F.col("turn"))
    return c.select("conv_id", "turn", K.failure_near_architecture(pick(NOTES, "k")).alias("near"))


@query(f"SELECT {pick_sql(NOTES, '(conv_id + turn)')} AS note, CASE (conv_id + turn) % 6 WHEN 0 THEN 'failure' WHEN 1 THEN 'validation' WHEN 3 THEN 'mention' WHEN 4 THEN 'failure' WHEN 5 THEN 'validation' END AS evidence, count(*) AS n FROM conversations GROUP BY 1, 2")
def comment_evidence(spark, sf):
    c = table(spark, sf, "conversations").withColumn("k", F.col("conv_id") + F.col("turn"))
    return c.select(pick(NOTES, "k").alias("note")).withColumn("evidence", K.comment_evidence(F.col("note"))).groupBy("note", "evidence").agg(F.count("*").alias("n"))


TEXTS = [
    "internal compiler error when using gcc -O2, reduced testcase attached", "wrong code with a regression since 12", "please compile with g++ -O3 and watch the crash",
    "missed optimization, known to work in 11", "nothing", "-mlasx on LA664 gives a hang", "uses ilp32d abi", "loongarch32 and lp64d both",
]
COMPONENTS = ["target", "web", "tree-optimization"]
RESOLUTIONS = ["FIXED", "INVALID", "", "DUPLICATE", "MOVED"]
SIGNAL_SQL = {
    "ice": (2, r"(?i)\b(ice|internal compiler error|unrecognizable insn)\b"), "wrong_code": (2, r"(?i)\b(wrong[ -]?code|miscompil(e|ation)|incorrect code|runtime failure)\b"),
    "crash_or_hang": (2, r"(?i)\b(crash|segfault|hang|timeout|infinite loop)\b"), "missed_optimization": (2, r"(?i)\b(missed optimization|missed-optimization|pessimiz|performance regression)\b"),
    "reduced_testcase": (1, r"(?i)\b(reduced|reducer|creduce|cvise|minimized|minimal)\b"), "preprocessed_source": (1, r"(?i)\b(preprocessed source|\.ii\b|\.i\b)\b"),
    "command_line": (1, r"(?i)\b(gcc|g\+\+|cc1|cc1plus|compile with|command line)\b[^\n]{0,160}\s-[A-Za-z0-9]"), "regression": (1, r"(?i)\b(regression|known to work|known to fail|started with|bisected)\b"),
}
REPORT_SQL = f"""
d AS (SELECT d.doc_id, {pick_sql(TEXTS, "d.doc_id")} AS t, CASE WHEN d.doc_id % 11 = 0 THEN ' ' ELSE 'described' END AS description, l.quality IS NOT NULL AS has_testcase,
  {pick_sql(COMPONENTS, "d.doc_id")} AS component, {pick_sql(RESOLUTIONS, "d.doc_id")} AS resolution, CASE WHEN d.doc_id % 4 = 0 THEN 1 ELSE 0 END AS kw,
  {pick_sql(SUMMARIES, "d.doc_id")} AS s, {pick_sql(TARGETS, "d.doc_id")} AS target
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id, 1 AS quality FROM labels) l ON l.doc_id = d.doc_id),
sc AS (SELECT *, (trim(description) <> '')::INT + 3 * has_testcase::INT + (component <> 'web')::INT + kw
  + {" + ".join(f"{n} * regexp_matches(t, {q(p)})::INT" for n, p in SIGNAL_SQL.values())}
  - 6 * (resolution IN ('INVALID', 'MOVED'))::INT + (resolution IN ('FIXED', 'DUPLICATE', 'WORKSFORME'))::INT AS raw FROM d)"""


def _reports(spark, sf) -> DataFrame:
    known = table(spark, sf, "labels").select("doc_id").distinct().withColumn("has_testcase", F.lit(True))
    d = table(spark, sf, "documents").select("doc_id").join(known, "doc_id", "left")
    words = F.when(F.col("doc_id") % 4 == 0, F.array(F.lit("Regression"))).otherwise(F.array().cast("array<string>"))
    return d.select(
        "doc_id", pick(TEXTS, "doc_id").alias("t"), F.when(F.col("doc_id") % 11 == 0, " ").otherwise("described").alias("description"), F.coalesce("has_testcase", F.lit(False)).alias("has_testcase"),
        pick(COMPONENTS, "doc_id").alias("component"), pick(RESOLUTIONS, "doc_id").alias("resolution"), words.alias("keywords"), pick(SUMMARIES, "doc_id").alias("s"), pick(TARGETS, "doc_id").alias("target"),
    )


def _quality() -> Column:
    return K.general_quality(*[F.col(c) for c in ("t", "description", "has_testcase", "component", "keywords", "resolution")])


@query(f"WITH {REPORT_SQL} SELECT doc_id, greatest(raw, 0) AS score, CASE WHEN raw >= 8 THEN 'high' WHEN raw >= 6 THEN 'medium' ELSE 'low' END AS quality_tier FROM sc")
def general_quality_score(spark, sf):
    return _reports(spark, sf).select("doc_id", _quality().alias("q")).select("doc_id", "q.score", "q.quality_tier")


E64_SQL, E32_SQL = K.EVIDENCE_64.replace("?:", ""), K.EVIDENCE_32.replace("?:", "")
SCOPE_SQL = f"""CASE WHEN regexp_matches(t, {q(E64_SQL)}) AND regexp_matches(t, {q(E32_SQL)}) THEN 'mixed_loongarch32_loongarch64' WHEN regexp_matches(t, {q(E64_SQL)}) THEN 'loongarch64'
  WHEN regexp_matches(t, {q(E32_SQL)}) THEN 'loongarch32' ELSE 'loongarch_family_unspecified' END"""


@query(f"WITH {REPORT_SQL} SELECT {SCOPE_SQL} AS scope, count(*) AS n FROM d GROUP BY 1")
def arch_scope(spark, sf):
    return _reports(spark, sf).select(K.architecture_scope(F.col("t")).alias("scope")).groupBy("scope").agg(F.count("*").alias("n"))


COMMON_SQL = "CASE WHEN trim(description) = '' THEN 'missing_bug_description' END, CASE WHEN NOT has_testcase THEN 'missing_testcase' END, CASE WHEN resolution IN ('INVALID', 'MOVED') THEN 'resolution_' || lower(resolution) END"
TIER_SQL = f"CASE WHEN regexp_matches(s, '{ARCH_SQL}') OR (regexp_matches(target, '{ARCH_SQL}') AND NOT regexp_matches(target, '{OTHER_SQL}')) THEN 'architecture_specific' WHEN regexp_matches(target, '{ARCH_SQL}') THEN 'multi_arch_shared' ELSE 'not_loongarch' END"


@query(f"""
WITH {REPORT_SQL}, z AS (SELECT *, {TIER_SQL} AS tier, {SCOPE_SQL} AS scope FROM sc)
SELECT doc_id, array_to_string(list_filter([CASE WHEN tier <> 'architecture_specific' THEN 'not_architecture_specific' END, CASE WHEN scope <> 'loongarch64' THEN 'no_explicit_loongarch64_evidence' END, {COMMON_SQL}], lambda x: x IS NOT NULL), ';') AS strict,
 array_to_string(list_filter([CASE WHEN tier NOT IN ('architecture_specific', 'multi_arch_shared') THEN 'no_loongarch_failure_or_testsuite_evidence' END, CASE WHEN scope <> 'loongarch64' THEN 'no_explicit_loongarch64_evidence' END, {COMMON_SQL}], lambda x: x IS NOT NULL), ';') AS expanded,
 array_to_string(list_filter([CASE WHEN greatest(raw, 0) < 6 THEN 'quality_score_below_6' END, {COMMON_SQL}], lambda x: x IS NOT NULL), ';') AS general
FROM z""")
def readiness_gates(spark, sf):
    r = _reports(spark, sf)
    gates = K.readiness(K.relevance(F.col("s"), F.col("target"))["tier"], K.architecture_scope(F.col("t")), F.col("description"), F.col("has_testcase"), F.col("resolution"), _quality()["score"])
    return r.select("doc_id", gates.alias("g")).select("doc_id", *[F.array_join(f"g.{n}", ";").alias(n) for n in ("strict", "expanded", "general")])


@query("""
SELECT count(*) AS reports, count(*) FILTER (lang = 'en') AS english, count(*) FILTER (n_chars > 1000) AS long_reports, count(*) FILTER (regexp_matches(text, '\\b[0-9a-f]{12,40}\\b')) AS with_hash,
  count(DISTINCT source) AS sources, count(DISTINCT sha256(text)) AS distinct_texts, count(DISTINCT CASE WHEN lang = 'en' THEN source END) AS english_sources FROM documents""")
def corpus_counts(spark, sf):
    d = table(spark, sf, "documents")
    return d.agg(
        F.count("*").alias("reports"), F.count_if(F.col("lang") == "en").alias("english"), F.count_if(F.col("n_chars") > 1000).alias("long_reports"),
        F.count_if(F.col("text").rlike(r"\b[0-9a-f]{12,40}\b")).alias("with_hash"), F.count_distinct("source").alias("sources"),
        F.count_distinct(F.sha2(F.col("text").cast("binary"), 256)).alias("distinct_texts"), F.count_distinct(F.when(F.col("lang") == "en", F.col("source"))).alias("english_sources"),
    )


FILES = ["a.C", "dir/b.f90", "notes.txt", "x.patch", "m.II", "noext", ".hidden", "t.s"]
MIMES = ["text/plain", "text/x-csrc; charset=utf-8", "application/pdf"]
HINTS = ["cpp", "", "asm", "Rust"]
SUFFIX_SQL = "regexp_extract({0}, '[^/.][^/]*(\\.[^./]+)$', 1)"


def _map_sql(key: str, values: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in values.items()) + " END"


@query(f"""
WITH p AS (SELECT page_id, {pick_sql(FILES, "page_id")} AS f, {pick_sql(MIMES, "page_id")} AS m, {pick_sql(HINTS, "page_id")} AS h FROM pages),
l AS (SELECT *, CASE WHEN {SUFFIX_SQL.format("f")} = '.C' THEN 'c++' ELSE coalesce({_map_sql(SUFFIX_SQL.format("lower(f)"), T.SUFFIX_LANGUAGE)}, {_map_sql("lower(trim(split_part(m, ';', 1)))", T.MIME_LANGUAGE)}, {_map_sql("lower(h)", T.HINT_LANGUAGE)}, 'unknown') END AS language FROM p)
SELECT page_id, language, coalesce({_map_sql("language", T.LANGUAGE_SUFFIX)}, '.txt') AS extension,
  ({SUFFIX_SQL.format("lower(f)")} IN ({", ".join(map(q, T.SUFFIX_LANGUAGE))}) OR lower(split_part(m, ';', 1)) IN ({", ".join(map(q, T.MIME_LANGUAGE))})) AS is_source FROM l""")
def file_language(spark, sf):
    f, m, h = pick(FILES, "page_id"), pick(MIMES, "page_id"), pick(HINTS, "page_id")
    p = table(spark, sf, "pages").select("page_id", T.language_for(f, m, h).alias("language"), K.is_source_attachment(F.lit(False), f, m, F.lit("")).alias("is_source"))
    return p.withColumn("extension", T.extension_for_language(F.col("language")))


CODES = ["int main(void) { return 0; }", "std::vector<int> v;", "program hello", "addi.d $r4, $r4, 1", "plain words", "use g++ here", "#include <stdio.h>", "real :: x"]


@query(f"""
WITH d AS (SELECT doc_id, {pick_sql(CODES, "doc_id")} AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, '\\b(g\\+\\+|cc1plus)\\b') OR regexp_matches(t, '\\b(std::|template\\s*<|namespace\\s+[A-Za-z_]|class\\s+[A-Za-z_])') THEN 'c++'
 WHEN regexp_matches(lower(t), '\\b(program\\b|subroutine\\b|integer\\s*::|real\\s*::)') AND NOT t LIKE 'real ::%' THEN 'fortran'
 WHEN regexp_matches(t, '\\b(gcc|cc1)\\b') OR regexp_matches(t, '#\\s*include|\\b(int|void|struct|enum)\\s+[A-Za-z_]|__attribute__') THEN 'c'
 WHEN regexp_matches(lower(t), '\\b(\\.text|\\.globl|addi\\.d|ld\\.d|st\\.d)\\b') THEN 'assembly' ELSE 'unknown' END AS language FROM d""")
def content_language(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.language_for_content(pick(CODES, "doc_id")).alias("language"))


RAW_LANGS = ["CPP", " c ", "g++", "", "F90", "assembly", "Rtl"]


@query(f"SELECT CASE l WHEN 'cpp' THEN 'c++' WHEN 'cxx' THEN 'c++' WHEN 'g++' THEN 'c++' WHEN 'f90' THEN 'fortran' WHEN 'f95' THEN 'fortran' WHEN 'assembly' THEN 'asm' WHEN '' THEN 'unknown' ELSE l END AS language, count(*) AS n FROM (SELECT lower(trim({pick_sql(RAW_LANGS, 'p_partkey')})) AS l FROM part) GROUP BY 1")
def canonical_languages(spark, sf):
    return table(spark, sf, "part").select(T.canonical_language(pick(RAW_LANGS, "p_partkey")).alias("language")).groupBy("language").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- text

FENCE = ["", "\n```c\nint main(void) { return 42; }\n```\n", "\nreduced testcase: int x; int y; int z; compile it please\n", "\n```\nshort\n```\n", "\n```cpp\nstd::string s = \"abc\";\n```\nand\n```\nplain text of a block here\n```"]
STRIP_SQL = "trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))"


@query(f"""
WITH c AS (SELECT conv_id, turn, text || {pick_sql(FENCE, "(conv_id + turn)")} AS t FROM conversations),
b AS (SELECT conv_id, turn, unnest(regexp_extract_all(t, '(?s)```\\s*([A-Za-z0-9_+.-]*)\\s*\\n(.*?)```', 1)) AS hint, unnest(regexp_extract_all(t, '(?s)```\\s*([A-Za-z0-9_+.-]*)\\s*\\n(.*?)```', 2)) AS code,
  generate_subscripts(regexp_extract_all(t, '(?s)```\\s*([A-Za-z0-9_+.-]*)\\s*\\n(.*?)```', 2), 1) AS block_number FROM c),
f AS (SELECT conv_id AS bug_id, turn AS comment_number, 'comment_code_block' AS kind, block_number::INT AS block_number, {STRIP_SQL.format("code")} || chr(10) AS content FROM b)
SELECT * FROM f WHERE length(content) >= 20
UNION ALL SELECT conv_id, turn, 'comment_reproducer', 1, {STRIP_SQL.format("t")} || chr(10) FROM c WHERE NOT contains(t, '```') AND regexp_matches(t, '(?i)\\b(reduced|test[ -]?case|reproducer)\\b') AND length(t) - length(replace(t, ';', '')) >= 2 AND length(t) >= 40""")
def code_block_extract(spark, sf):
    c = table(spark, sf, "conversations").withColumn("k", F.col("conv_id") + F.col("turn"))
    return C.comment_testcases(c.select(F.col("conv_id").alias("bug_id"), F.col("turn").alias("count"), F.concat("text", pick(FENCE, "k")).alias("text"))).drop("language")


@query("""
WITH h AS (SELECT doc_id, list_transform(regexp_extract_all(text, '\\b([0-9a-fA-F]{12,40})\\b', 1), lambda x: lower(x)) AS h FROM documents)
SELECT doc_id, unnest(list_distinct(h)) AS commit_hash FROM h""")
def commit_hashes(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(T.commit_hashes(F.col("text"))).alias("commit_hash"))


FIXES = ["Fixed by commit 0123456789abcdef0123", "no news", "The branch has been updated: 00ff00ff00ff00ff and 0123456789abcdef0123", "I see the same"]


@query(f"""
WITH c AS (SELECT conv_id AS bug_id, turn, {pick_sql(FIXES, "(conv_id + turn)")} AS t FROM conversations),
e AS (SELECT * FROM c WHERE regexp_matches(t, '(?i)(branch has been updated|\\bcommit\\b|\\bfixed\\b)')),
h AS (SELECT bug_id, turn, unnest(regexp_extract_all(t, '\\b([0-9a-f]{{12,40}})\\b', 1)) AS h, generate_subscripts(regexp_extract_all(t, '\\b([0-9a-f]{{12,40}})\\b', 1), 1) AS i FROM e),
f AS (SELECT bug_id, h, min((turn, i)) AS p FROM h GROUP BY 1, 2), l AS (SELECT bug_id, string_agg(h, ';' ORDER BY p) AS commit_hashes FROM f GROUP BY 1),
n AS (SELECT bug_id, count(*) AS evidence_count FROM e GROUP BY 1)
SELECT n.bug_id, evidence_count, coalesce(commit_hashes, '') AS commit_hashes FROM n LEFT JOIN l ON l.bug_id = n.bug_id""")
def fix_history(spark, sf):
    c = table(spark, sf, "conversations").withColumn("k", F.col("conv_id") + F.col("turn"))
    out = C.fix_history(c.select(F.col("conv_id").alias("bug_id"), F.col("turn").alias("count"), pick(FIXES, "k").alias("text")))
    return out.withColumn("commit_hashes", F.array_join("commit_hashes", ";"))


MARK_SQL = "chr(10) || chr(10) || '[... content truncated to fit the model context ...]' || chr(10) || chr(10)"
NAMES = ["a/b\\c d?.txt", "...", "plain.c", "sk-abcdefgh12345 and sk-short", "ünïcode name"]


@query(f"""
SELECT doc_id, CASE WHEN length(text) <= 500 THEN text ELSE left(text, 222) || {MARK_SQL} || right(text, 222) END AS clipped, length(text) > 500 AS was_clipped,
  CASE WHEN length(text) > 40 THEN left(text, 40) || ' ...' ELSE text END AS head,
  coalesce(nullif(left(trim(regexp_replace(translate({pick_sql(NAMES, "doc_id")}, '\\/', '__'), '[^A-Za-z0-9._+-]+', '_', 'g'), '._'), 160), ''), 'artifact') AS safe_name,
  regexp_replace({pick_sql(NAMES, "doc_id")}, '\\bsk-[A-Za-z0-9_-]{{8,}}\\b', '<redacted-api-key>', 'g') AS redacted FROM documents""")
def clip_and_names(spark, sf):
    t, n = F.col("text"), pick(NAMES, "doc_id")
    return table(spark, sf, "documents").select("doc_id", T.clip(t, 500).alias("clipped"), T.is_clipped(t, 500).alias("was_clipped"), T.head(t, 40, " ...").alias("head"), T.safe_filename(n).alias("safe_name"), T.redact_secrets(n).alias("redacted"))


TOKENS_SQL = "list_distinct(list_filter(list_transform(regexp_extract_all({0}, '[A-Za-z0-9_+.-]+'), lambda x: lower(x)), lambda x: length(x) > 1))"


@query(f"""
WITH t AS (SELECT doc_id, {TOKENS_SQL.format("text")} AS k FROM documents)
SELECT a.doc_id AS left_id, b.doc_id AS right_id, len(list_intersect(a.k, b.k)) AS shared,
  CASE WHEN len(a.k) + len(b.k) = 0 THEN 0.0::DOUBLE ELSE round(len(list_intersect(a.k, b.k)) / (len(a.k) + len(b.k) - len(list_intersect(a.k, b.k))), 6) END AS jaccard
FROM t a JOIN t b ON b.doc_id = a.doc_id + 1""")
def token_set_jaccard(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", T.token_set(F.col("text")).alias("k"))
    a, b = t.select(F.col("doc_id").alias("left_id"), F.col("k").alias("a")), t.select(F.col("doc_id").alias("right_id"), F.col("k").alias("b"))
    both = a.join(b, F.col("right_id") == F.col("left_id") + 1)
    return both.select("left_id", "right_id", F.size(F.array_intersect("a", "b")).cast("long").alias("shared"), F.round(T.jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"))


OPTION_SETS = ["-O2 -o out.s -lm -Wall", "-c -O0 -g -L/usr/lib", "-march=loongarch64", "-static -Ofast x.c -Wl,-z", "", "-S -o a -O3 -shared"]


@query(f"""
WITH o AS (SELECT p_partkey, string_split({pick_sql(OPTION_SETS, "p_partkey")}, ' ') AS o FROM part),
k AS (SELECT p_partkey, list_filter(o, lambda x, i: x <> '' AND x NOT IN ('-o', '-c', '-S', '-E', '-shared', '-static', '-pie') AND NOT regexp_matches(x, '^(-l|-Wl,|-L)') AND coalesce(list_extract(o, i - 1), '') <> '-o') AS kept FROM o)
SELECT p_partkey, array_to_string(list_prepend('-Ofast', list_filter(kept, lambda x: NOT regexp_full_match(x, '-O([0-3sSzZg]|fast)'))), ' ') AS forced,
  array_to_string(CASE WHEN len(list_filter(kept, lambda x: regexp_full_match(x, '-O([0-3sSzZg]|fast)'))) > 0 THEN kept ELSE list_prepend('-O2', kept) END, ' ') AS preserved FROM k""")
def option_sanitizer(spark, sf):
    o = F.split(pick(OPTION_SETS, "p_partkey"), " ")
    return table(spark, sf, "part").select("p_partkey", F.array_join(T.sanitize_options(o), " ").alias("forced"), F.array_join(T.sanitize_options(o, "preserve"), " ").alias("preserved"))


CONTENTS = ['{"a": 1}', 'Here:\n```json\n{"a": 2}\n```\nbye', 'noise {"a": 3} noise', "not json", "[1, 2]", "```{broken```"]


@query(f"""
WITH c AS (SELECT o_orderkey, {pick_sql(CONTENTS, "o_orderkey")} AS t FROM orders),
x AS (SELECT *, regexp_extract(t, '(?si)```(?:json)?\\s*(\\{{.*\\}})\\s*```', 1) AS fenced, regexp_extract(t, '(?s)(\\{{.*\\}})', 1) AS outermost FROM c),
y AS (SELECT o_orderkey, CASE WHEN json_valid(t) THEN t ELSE CASE WHEN fenced <> '' THEN fenced ELSE outermost END END AS j FROM x)
SELECT o_orderkey, CASE WHEN json_valid(j) AND left(j, 1) = '{{' THEN (j->>'$.a') END AS a, CASE WHEN json_valid(j) AND left(j, 1) = '{{' THEN 'ok' ELSE 'parse_error' END AS status FROM y""")
def model_json(spark, sf):
    j = T.parse_json_content(pick(CONTENTS, "o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", F.get_json_object(j, "$.a").alias("a"), F.when(j.isNull(), "parse_error").otherwise("ok").alias("status"))


USAGE = ['{"usage": {"total_tokens": 12, "prompt_tokens": 5}}', '{"usage": {"total_tokens": "bad"}}', "{}"]


@query(f"""
SELECT coalesce(sum(try_cast(json_extract_string(r, '$.usage.prompt_tokens') AS BIGINT)), 0)::BIGINT AS prompt_tokens, 0::BIGINT AS completion_tokens,
  coalesce(sum(try_cast(json_extract_string(r, '$.usage.total_tokens') AS BIGINT)), 0)::BIGINT AS total_tokens FROM (SELECT {pick_sql(USAGE, "o_orderkey")} AS r FROM orders)""")
def token_usage(spark, sf):
    from quernflow.operators.connectors import token_usage as usage

    return usage(table(spark, sf, "orders").select(pick(USAGE, "o_orderkey").alias("response")))


# ---------------------------------------------------------------- features and pairs

TYPES = ["semantic_invariant", "code_shape", "failure_oracle", "pass_interaction", "mutation_knob", "target_condition"]
FAILS = ["wrong-code", "ice", "", "missed-optimization"]
DESCS = ["vector loop with the lsx unit", "soft float on loongarch", "runtime differential of shifts", "must reject bad constraint", "linker bootstrap", "x86 avx zmm spill"]
OPTS = ["-mlsx -O2", "-msoft-float", "", "-mabi=lp64d", "-mno-lsx", "-march=rv64"]
STRENGTH = ["strong", "medium", "weak", ""]


def _features(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier")
    k, uid = F.col("s_suppkey"), F.concat(F.lit("f-"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))
    return s.select(
        F.struct(
            uid.alias("feature_uid"), F.floor(k / 2).alias("bug_id"), pick(TYPES, "s_suppkey").alias("feature_type"), pick(DESCS, "s_suppkey div 2").alias("description"), F.when(k % 3 == 0, "").otherwise("int x;").alias("code_witness"),
            pick(STRENGTH, "s_suppkey").alias("evidence_strength"), pick(["c", "cpp", "unknown", "c++", "C"], "s_suppkey").alias("language"), F.concat(F.lit("area"), k % 7).alias("compiler_area"), pick(FAILS, "s_suppkey").alias("failure_mode"),
            F.split(pick(OPTS, "s_suppkey div 3"), " ").alias("target_options"), F.array(F.concat(F.lit("knob"), k % 5)).alias("mutation_knobs"), F.array(F.concat(F.lit("tag"), k % 11), F.lit("gcc")).alias("composition_tags"),
            ((k % 10) / 10).alias("confidence"), F.lit("").alias("root_cause_summary"),
        ).alias("f")
    )


VECTOR_SQL = f"""
s AS (SELECT 'f-' || lpad(s_suppkey::VARCHAR, 9, '0') AS feature_uid, floor(s_suppkey / 2)::BIGINT AS bug_id, {pick_sql(TYPES, "s_suppkey")} AS feature_type, {pick_sql(DESCS, "(s_suppkey // 2)")} AS d,
  CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'int x;' END AS w, {pick_sql(STRENGTH, "s_suppkey")} AS strength, {pick_sql(["c", "c++", "unknown", "c++", "c"], "s_suppkey")} AS language,
  'area' || (s_suppkey % 7) AS area, {pick_sql(FAILS, "s_suppkey")} AS fail, {pick_sql(OPTS, "(s_suppkey // 3)")} AS o, 'knob' || (s_suppkey % 5) AS knob, 'tag' || (s_suppkey % 11) AS tag, (s_suppkey % 10) / 10 AS conf FROM supplier),
v AS (SELECT *, list_sort(list_filter(list_distinct(list_concat([tag, knob], list_filter({TOKENS_SQL.format("d")}, lambda x: NOT list_contains({words_sql(X.STOPWORDS)}, x)))), lambda x: NOT list_contains({words_sql(X.GENERIC)}, x))) AS tokens,
  lower(o || ' ' || w || ' ' || d || ' ') AS need, {TOKENS_SQL.format("lower(d || ' ' || w || ' ' || tag || ' gcc ' || o || ' ')")} AS words,
  0.55::DOUBLE * least(conf, 1.0) + 0.3::DOUBLE * CASE strength WHEN 'strong' THEN 1.0 WHEN 'medium' THEN 0.7 WHEN 'weak' THEN 0.35 ELSE 0.5 END + 0.15::DOUBLE * (w <> '')::INT AS quality,
  lower(d || ' ' || w || ' ' || feature_type || ' ' || fail || ' ' || tag || ' gcc ') AS mt FROM s),
m AS (SELECT *, CASE {" ".join("WHEN " + " OR ".join(f"contains(mt, {q(c)})" for c in cues) + f" THEN {q(n)}" for n, cues in X.MODE_CUES.items())} ELSE 'compile' END AS mode,
  list_filter([{", ".join(f"CASE WHEN len(list_intersect(words, {words_sql(t)})) > 0 THEN {q(n)} END" for n, t in X.ARCH_TERMS.items())}], lambda x: x IS NOT NULL) AS archs,
  list_filter([{", ".join("CASE WHEN " + " OR ".join(f"contains(need, {q(c)})" for c in cues) + f" THEN {q(n)} END" for n, cues in X.REQUIRED_CUES.items())}], lambda x: x IS NOT NULL) AS required FROM v)"""


@query(f"WITH {VECTOR_SQL} SELECT feature_uid, bug_id, language, array_to_string(tokens, ' ') AS tokens, array_to_string(archs, ' ') AS archs, array_to_string(required, ' ') AS required, mode, round(quality, 6) AS quality FROM m")
def feature_vectors(spark, sf):
    v = _features(spark, sf).select(*X.vector(F.col("f")))
    joined = [F.array_join(n, " ").alias(n) for n in ("tokens", "archs", "required")]
    return v.select("feature_uid", "bug_id", "language", *joined, "mode", F.round("quality", 6).alias("quality"))


OPT_SQL = """CASE WHEN contains({0}.o, '-msoft-float') THEN 'soft' WHEN contains({0}.o, '-mlsx') OR contains({0}.o, '-mabi=lp64d') THEN 'hard' ELSE '' END"""


@query(f"""
WITH {VECTOR_SQL}, p AS (SELECT a.feature_uid AS "left", b.feature_uid AS "right", len(list_intersect(a.tokens, b.tokens)) AS sh, len(list_distinct(list_concat(a.tokens, b.tokens))) AS un,
  a.area = b.area AS same_compiler_area, a.fail <> '' AND a.fail = b.fail AS same_failure_mode, a.feature_type <> b.feature_type AS complementary_feature_types, len(list_intersect(a.archs, b.archs)) > 0 AS prof, a.quality + b.quality AS ql,
  a.language = b.language OR a.language = 'unknown' OR b.language = 'unknown' AS language_compatible, a.mode = b.mode OR (a.mode NOT IN ('build_or_link', 'diagnostic') AND b.mode NOT IN ('build_or_link', 'diagnostic')) AS test_mode_compatible,
  CASE WHEN len(a.required) > 0 THEN a.required ELSE a.archs END AS ra, CASE WHEN len(b.required) > 0 THEN b.required ELSE b.archs END AS rb,
  NOT ({OPT_SQL.format("a")} || {OPT_SQL.format("b")} IN ('softhard', 'hardsoft') OR (contains(a.o, '-mno-lsx') AND contains(b.o, '-mlsx')) OR (contains(b.o, '-mno-lsx') AND contains(a.o, '-mlsx'))) AS options_compatible
  FROM m a JOIN m b ON a.feature_uid < b.feature_uid AND a.bug_id <> b.bug_id),
r AS (SELECT *, len(ra) = 0 OR len(rb) = 0 OR len(list_intersect(ra, rb)) > 0 AS architecture_compatible,
  5.0::DOUBLE * CASE WHEN un = 0 THEN 0 ELSE sh / un END + least(2.0, 0.45::DOUBLE * sh) + 1.4::DOUBLE * same_compiler_area::INT + 0.7::DOUBLE * same_failure_mode::INT + 0.8::DOUBLE * complementary_feature_types::INT + 1.0::DOUBLE * prof::INT + 0.6::DOUBLE * ql AS raw FROM p)
SELECT "left", "right", round(raw, 4) AS score, sh AS n_shared, same_compiler_area, same_failure_mode, complementary_feature_types FROM r
WHERE language_compatible AND test_mode_compatible AND options_compatible AND architecture_compatible AND round(raw, 4) >= 3.2""")
def pair_affinity(spark, sf):
    v = _features(spark, sf).select(*X.vector(F.col("f")))
    out = P.pair_affinity(v)
    return out.select("left", "right", "score", F.size("shared_tags").cast("long").alias("n_shared"), "same_compiler_area", "same_failure_mode", "complementary_feature_types")


@query("""
WITH o AS (SELECT DISTINCT l_orderkey AS g, l_suppkey AS f FROM lineitem)
SELECT a.f AS "left", b.f AS "right", count(*) AS n FROM o a JOIN o b ON a.g = b.g AND a.f < b.f GROUP BY 1, 2""")
def cooccurrence_pairs(spark, sf):
    return P.cooccurrence(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("group_id"), F.col("l_suppkey").alias("feature_uid")))


@query()
def sampler_demo(spark, sf):
    """Groups drawn from the features by the seeded sampler; the draws have no SQL."""
    from quernflow.scratch import materialize

    v = materialize(_features(spark, sf).select(*X.vector(F.col("f"), "any")), "vectors")
    pool = [r.asDict() for r in v.select("feature_uid", "bug_id", "feature_type", "profile_match").orderBy("feature_uid").collect()]
    groups = P.Sampler(pool, P.partners(v)).groups(8)
    return spark.createDataFrame([(i, p, u) for i, g in enumerate(groups, 1) for p, u in enumerate(g)], "group_index int, pos int, feature_uid string")


@query("""
WITH p AS (SELECT p_partkey AS k, p_partkey % 13 = 4 AS odd, p_partkey % 7 = 2 AND p_partkey % 13 <> 4 AS rej FROM part),
s AS (SELECT *, NOT odd AND NOT rej AS ready, CASE WHEN k % 5 = 0 THEN '' WHEN k % 19 = 6 THEN 'int exploit;' ELSE 'int x;' END AS src, k % 3 = 0 AS bare FROM p)
SELECT k AS p_partkey, CASE WHEN odd THEN 'odd' WHEN rej THEN 'rejected' ELSE 'ready' END AS instantiation_status, CASE WHEN k % 17 = 3 THEN 'other-tongue' ELSE 'c++' END AS language,
  array_to_string(CASE WHEN k % 23 = 7 THEN [] ELSE ['-O2', '-g'] END, ' ') AS options, CASE WHEN bare THEN NULL WHEN k % 29 = 8 THEN ' ' ELSE 'runtime' END AS oracle_kind,
  CASE WHEN bare THEN '{}' ELSE '{"kind":"' || CASE WHEN k % 29 = 8 THEN ' ' ELSE 'runtime' END || '","n":' || k || '}' END AS oracle, 'mode' || (k % 3) AS group_test_mode, 'r' || k AS response_id,
  'c' || k || '-' || left(sha256('{"options":[' || CASE WHEN k % 23 = 7 THEN '' ELSE '"-O2","-g"' END || '],"source":"' || src || '"}'), 16) AS instantiation_id,
  array_to_string(list_filter([CASE WHEN k % 11 = 1 THEN 'wrong_group_uid' END, CASE WHEN odd THEN 'invalid_status' END, CASE WHEN rej AND k % 2 = 1 THEN 'rejected_without_reason' END,
    CASE WHEN ready AND k % 17 = 3 THEN 'unsupported_language' END, CASE WHEN ready AND src = '' THEN 'empty_source' END, CASE WHEN ready AND contains(src, 'exploit') THEN 'bad_purpose' END,
    CASE WHEN ready AND k % 23 = 7 THEN 'no_options' END, CASE WHEN ready AND (bare OR k % 29 = 8) THEN 'no_oracle_kind' END, CASE WHEN ready AND k % 31 = 9 THEN 'checklist_incomplete' END,
    CASE WHEN ready AND k % 31 <> 9 AND k % 37 = 10 THEN 'checklist_without_implementation' END], lambda x: x IS NOT NULL), ' ') AS violations FROM s""")
def instantiation_rules(spark, sf):
    """Answers for groups, one a part, made whole from their groups and held against the rules of instantiations."""
    k = F.col("p_partkey")
    tick = lambda uid, how: F.struct(F.lit(uid).alias("feature_uid"), how.alias("implemented_by"))
    how = F.when(k % 37 == 10, " ").otherwise("a loop")
    answer = F.to_json(
        F.struct(
            F.when(k % 11 == 1, "other").alias("group_uid"), F.when(k % 13 == 4, "odd").when(k % 7 == 2, "Rejected").alias("instantiation_status"), F.when(k % 2 == 0, F.array(F.lit("why"))).alias("rejection_reasons"),
            F.when(k % 17 == 3, "other-tongue").alias("language"), F.when(k % 5 == 0, "").when(k % 19 == 6, "int exploit;").otherwise("int x;").alias("source_code"), F.when(k % 23 == 7, F.array().cast("array<string>")).alias("compiler_options"),
            F.when(k % 3 != 0, F.struct(F.when(k % 29 == 8, " ").otherwise("runtime").alias("kind"), k.alias("n"))).alias("oracle"), F.when(k % 31 == 9, F.array(tick("f1", F.lit("a loop")))).otherwise(F.array(tick("f1", F.lit("a loop")), tick("f2", how))).alias("preservation_checklist"),
        )
    )
    group = F.struct(
        F.concat(F.lit("g"), k).alias("group_uid"), F.concat(F.lit("c"), k).alias("candidate_id"), F.lit("cpp").alias("language"), F.array(F.lit("-O2"), F.lit("-g")).alias("target_options"),
        F.array(F.lit("f1"), F.lit("f2")).alias("source_feature_uids"), F.lit("sha").alias("source_features_sha256"), F.concat(F.lit("mode"), k % 3).alias("test_mode"),
    )
    by = I.provenance(F.concat(F.lit('{"id":"r'), k, F.lit('"}')), "m", "http://h/", F.lit("now"))
    rows = table(spark, sf, "part").select(k, answer.alias("answer"), group.alias("want"))
    rows = rows.select(k, I.normalize_instantiation(F.col("answer"), F.col("want"), I.FROM_GROUP, by).alias("i"), "want").select(k, "i.*", "want").withColumn("violations", G.instantiation_violations())
    return rows.select(k, "instantiation_status", "language", F.array_join("compiler_options", " ").alias("options"), "oracle_kind", "oracle", "group_test_mode", "generated_by.response_id", "instantiation_id", F.array_join("violations", " ").alias("violations"))


GLUE = ["G1-shared-accumulator", "g2_x", "G3", "glue", "G01", " G4 "]


@query(f"SELECT s_suppkey, CASE WHEN regexp_matches(trim(g), '^[Gg]([1-9][0-9]*)([-_][A-Za-z0-9][A-Za-z0-9_-]*)?$') THEN 'G' || regexp_extract(trim(g), '^[Gg]([1-9][0-9]*)', 1) END AS glue_id FROM (SELECT s_suppkey, {pick_sql(GLUE, 's_suppkey')} AS g FROM supplier)")
def glue_ids(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", T.canonical_glue_id(pick(GLUE, "s_suppkey")).alias("glue_id"))


@query("""
WITH f AS (SELECT l_orderkey AS bug_id, 'F' || l_linenumber AS feature_id, l_returnflag AS description, l_linestatus AS code_witness, CASE WHEN l_suppkey % 2 = 0 THEN 'c' ELSE '' END AS language FROM lineitem)
SELECT bug_id, 'bug-' || bug_id || '-' || feature_id || '-' || left(sha256('{"bug_id":' || bug_id || ',"code_witness":"' || code_witness || '","description":"' || description || '","feature_id":"' || feature_id || '"}'), 16) AS feature_uid,
  CASE WHEN language = '' THEN 'unknown' ELSE language END AS language, 'other' AS compiler_area, 'semantic_invariant' AS feature_type FROM f""")
def feature_pool(spark, sf):
    i = table(spark, sf, "lineitem")
    none, empty = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    f = F.struct(
        F.concat(F.lit("F"), "l_linenumber").alias("feature_id"), none.alias("feature_type"), F.col("l_returnflag").alias("description"), F.col("l_linestatus").alias("code_witness"), none.alias("witness_kind"), none.alias("evidence_strength"),
        F.when(F.col("l_suppkey") % 2 == 0, "c").otherwise("").alias("language"), none.alias("compiler_area"), none.alias("failure_mode"), empty.alias("target_options"), empty.alias("mutation_knobs"), empty.alias("composition_tags"), none.alias("root_cause_link"), F.lit(0.5).alias("confidence"),
    )
    outputs = i.groupBy(F.col("l_orderkey").alias("bug_id")).agg(F.collect_list(f).alias("features")).withColumn("source_url", none).withColumn("root_cause_summary", none)
    return C.feature_pool(outputs).select("bug_id", "feature_uid", "language", "compiler_area", "feature_type")


# ---------------------------------------------------------------- joins, sets, order


@query("SELECT doc_id, h AS sha256 FROM (SELECT doc_id, sha256(text) AS h, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def sha_dedup_first(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return C.first_by(d, ["sha256"], ["doc_id"]).select("doc_id", "sha256")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def last_wins_upsert(spark, sf):
    return C.last_by(table(spark, sf, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("SELECT lang, count(*) AS missing FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY lang")
def missing_outputs(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_anti").groupBy("lang").agg(F.count("*").alias("missing"))


@query("SELECT lang, count(*) AS known FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY lang")
def known_semi(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_semi").groupBy("lang").agg(F.count("*").alias("known"))


@query("""
WITH g AS (SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'u' || o_orderkey END AS group_uid, 'c' || o_custkey AS candidate_id FROM orders),
k AS (SELECT key, max(pos) AS pos FROM (SELECT group_uid AS key, pos FROM g UNION ALL SELECT candidate_id, pos FROM g) WHERE key IS NOT NULL GROUP BY key)
SELECT e.event_id, coalesce(a.pos, b.pos) AS group_pos FROM events e LEFT JOIN k a ON a.key = 'u' || e.event_id LEFT JOIN k b ON b.key = 'c' || e.user_id WHERE coalesce(a.pos, b.pos) IS NOT NULL""")
def fallback_key_join(spark, sf):
    o, e = table(spark, sf, "orders"), table(spark, sf, "events")
    groups = o.select(F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("n"), F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("u"), "o_orderkey")).alias("group_uid"), F.concat(F.lit("c"), "o_custkey").alias("candidate_id"))
    evaluations = e.select("event_id", F.concat(F.lit("u"), "event_id").alias("group_uid"), F.concat(F.lit("c"), "user_id").alias("candidate_id"))
    return B.resolve_groups(evaluations, groups).select("event_id", F.col("group.n").alias("group_pos"))


COVER_SQL = """
c AS (SELECT l_partkey AS f, count(*) AS n FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1), r AS (SELECT l_partkey AS f, count(*) AS n FROM lineitem WHERE l_linenumber = 1 AND l_quantity > 40 GROUP BY 1),
x AS (SELECT p_partkey AS feature_uid, coalesce(c.n, 0) AS candidate_group_count, coalesce(r.n, 0) AS ready_group_count, CASE WHEN r.n > 0 THEN 'ready_covered' WHEN c.n > 0 THEN 'candidate_only' ELSE 'never_sampled' END AS status
  FROM part LEFT JOIN c ON c.f = p_partkey LEFT JOIN r ON r.f = p_partkey)"""


def _coverage(spark, sf):
    i = table(spark, sf, "lineitem")
    grouped = lambda rows: rows.groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("source_feature_uids"))
    candidates, ready = grouped(i.where("l_linenumber <= 2")), grouped(i.where("l_linenumber = 1 AND l_quantity > 40"))
    pool = table(spark, sf, "part").select(F.col("p_partkey").alias("feature_uid"), "p_size")
    return pool, candidates, ready


@query(f"WITH {COVER_SQL} SELECT * FROM x")
def feature_coverage(spark, sf):
    pool, candidates, ready = _coverage(spark, sf)
    return V.feature_coverage(pool.drop("p_size"), candidates, ready)


@query(f"""
WITH {COVER_SQL}, e AS (SELECT p_partkey AS f FROM part WHERE p_size > 10), a AS (SELECT (SELECT count(*) FROM x) AS feature_pool_records, (SELECT count(*) FROM x WHERE status = 'candidate_only') AS candidate_only_features,
 (SELECT count(*) FROM x WHERE status = 'never_sampled') AS never_sampled_features, (SELECT count(*) FROM x WHERE status <> 'ready_covered') AS uncovered_features, (SELECT count(*) FROM e) AS eligible_feature_pool_records,
 (SELECT count(*) FROM c) AS candidate_covered_features, (SELECT count(*) FROM c JOIN e ON e.f = c.f) AS eligible_candidate_covered_features, (SELECT count(*) FROM r) AS ready_covered_features, (SELECT count(*) FROM r JOIN e ON e.f = r.f) AS eligible_ready_covered_features)
SELECT *, round(ready_covered_features / feature_pool_records, 4) AS ready_coverage_of_full_pool, round(eligible_ready_covered_features / eligible_feature_pool_records, 4) AS ready_coverage_of_eligible_pool,
 round(candidate_covered_features / feature_pool_records, 4) AS candidate_coverage_of_full_pool, round(eligible_candidate_covered_features / eligible_feature_pool_records, 4) AS candidate_coverage_of_eligible_pool FROM a""")
def feature_coverage_counts(spark, sf):
    pool, candidates, ready = _coverage(spark, sf)
    return V.coverage_counts(V.feature_coverage(pool, candidates, ready), candidates, ready, pool.where("p_size > 10"))


FILE_SQL = """
l AS (SELECT l_suppkey AS file, l_partkey AS line, max(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS c FROM lineitem GROUP BY 1, 2),
f AS (SELECT l_suppkey AS file, l_returnflag || l_linestatus AS name, max(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END) AS c FROM lineitem GROUP BY 1, 2),
b AS (SELECT l_suppkey AS file, l_partkey AS line, l_linenumber AS idx, max(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS c FROM lineitem GROUP BY 1, 2, 3),
x AS (SELECT * FROM (SELECT file, count(*) AS lines_total, count(*) FILTER (c > 0) AS lines_covered FROM l GROUP BY 1) JOIN (SELECT file, count(*) AS functions_total, count(*) FILTER (c > 0) AS functions_covered FROM f GROUP BY 1) USING (file)
  JOIN (SELECT file, count(*) AS branches_total, count(*) FILTER (c > 0) AS branches_covered FROM b GROUP BY 1) USING (file))"""


def _files(spark, sf) -> DataFrame:
    i = table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "file")
    hit = lambda c: F.when(c, 1).otherwise(0).alias("count")
    lines = i.select("file", F.col("l_partkey").alias("line"), hit(F.col("l_quantity") > 25))
    functions = i.select("file", F.concat("l_returnflag", "l_linestatus").alias("name"), hit(F.col("l_quantity") > 49))
    branches = i.select("file", F.col("l_partkey").alias("line"), F.col("l_linenumber").alias("idx"), hit(F.col("l_discount") > 0.05))
    return V.source_coverage(lines, functions, branches)


@query(f"WITH {FILE_SQL} SELECT * FROM x")
def file_line_coverage(spark, sf):
    return _files(spark, sf)


@query(f"""
WITH {FILE_SQL}, t AS (SELECT count(*) AS files_total, sum(lines_total)::BIGINT AS lines_total, sum(lines_covered)::BIGINT AS lines_covered, sum(functions_total)::BIGINT AS functions_total, sum(functions_covered)::BIGINT AS functions_covered,
  sum(branches_total)::BIGINT AS branches_total, sum(branches_covered)::BIGINT AS branches_covered FROM x)
SELECT *, round(100.0::DOUBLE * lines_covered / lines_total, 2) AS line_coverage_percent, round(100.0::DOUBLE * functions_covered / functions_total, 2) AS function_coverage_percent, round(100.0::DOUBLE * branches_covered / branches_total, 2) AS branch_coverage_percent FROM t""")
def coverage_totals(spark, sf):
    return V.coverage_totals(_files(spark, sf))


@query(f"WITH {FILE_SQL} SELECT file, lines_covered FROM x ORDER BY lines_covered DESC, file LIMIT 50")
def top_files(spark, sf):
    return _files(spark, sf).select("file", "lines_covered").orderBy(F.desc("lines_covered"), "file").limit(50)


@query(f"WITH {REWARD_ROWS_SQL}, w AS (SELECT *, round(new_edges_sum + 25.0::DOUBLE * novel_group_count + 0.001::DOUBLE * edge_entries_sum, 3) AS reward_score FROM g) SELECT feature_uid, reward_score FROM w ORDER BY reward_score DESC, feature_uid LIMIT 100")
def ranked_rewards(spark, sf):
    return feature_reward(spark, sf).select("feature_uid", "reward_score").orderBy(F.desc("reward_score"), "feature_uid").limit(100)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 48")
def latest_n_tail(spark, sf):
    return C.tail(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 48)


@query("""
WITH n AS (SELECT source, lang, count(*) AS n, min(doc_id) AS p FROM documents WHERE lang <> 'en' GROUP BY 1, 2)
SELECT s.source, coalesce(l.lang, 'en') AS lang FROM (SELECT DISTINCT source FROM documents) s LEFT JOIN (SELECT source, arg_min(lang, (-n, p)) AS lang FROM n GROUP BY 1) l ON l.source = s.source""")
def mode_language(spark, sf):
    return C.most_common(table(spark, sf, "documents"), ["source"], "lang", "doc_id", unknown="en")


@query("""
SELECT 'orders_without_customer' AS rule, o_orderkey AS key FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.o_custkey)
UNION ALL SELECT DISTINCT 'lines_without_order', l_orderkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.l_orderkey)
UNION ALL SELECT 'orders_without_lines', o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey)
UNION ALL SELECT 'chars_differ', doc_id FROM documents WHERE n_chars <> length(text)""")
def ref_integrity_violations(spark, sf):
    o, i, c, d = (table(spark, sf, t) for t in ("orders", "lineitem", "customer", "documents"))
    rule = lambda df, name: df.select(F.lit(name).alias("rule"), "key")
    sets = C.set_mismatch(i.select(F.col("l_orderkey").alias("key")), o.select(F.col("o_orderkey").alias("key")), ["key"])
    return (
        rule(o.join(c, o["o_custkey"] == c["c_custkey"], "left_anti").select(F.col("o_orderkey").alias("key")), "orders_without_customer")
        .unionByName(rule(sets.where("side = 'left'"), "lines_without_order"))
        .unionByName(rule(sets.where("side = 'right'"), "orders_without_lines"))
        .unionByName(rule(d.where(F.length("text") != F.col("n_chars")).select(F.col("doc_id").alias("key")), "chars_differ"))
    )


@query("""
WITH f AS (SELECT user_id, min(ts::DATE) AS day FROM events GROUP BY 1), d AS (SELECT DISTINCT ts::DATE AS day FROM events), n AS (SELECT d.day, count(f.user_id) AS added FROM d LEFT JOIN f ON f.day = d.day GROUP BY 1),
u AS (SELECT day, added, (sum(added) OVER (ORDER BY day))::BIGINT AS union_after FROM n)
SELECT strftime(day, '%Y-%m-%d') AS day, coalesce(lag(union_after) OVER (ORDER BY day), 0) AS union_before, union_after, added AS delta FROM u""")
def iteration_delta(spark, sf):
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id")
    n = B.edge_novelty(e, "day", "user_id")
    return n.select("day", (F.col("union_edges_after") - F.col("new_edges")).alias("union_before"), F.col("union_edges_after").alias("union_after"), F.col("new_edges").alias("delta"))


@query("SELECT event_type, min((props->>'$.k')::BIGINT) AS lowest, max((props->>'$.k')::BIGINT) AS highest, sum((props->>'$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY 1")
def stats_kv_pivot(spark, sf):
    path = fresh_path(spark, "stats")
    table(spark, sf, "events").select(F.concat_ws(" : ", "event_type", F.get_json_object("props", "$.k"))).write.text(path)
    k = F.col("value").cast("long")
    return S.read_stats(spark, path).groupBy(F.col("key").alias("event_type")).agg(F.min(k).alias("lowest"), F.max(k).alias("highest"), F.sum(k).alias("total"))


TEST_NAMES = ["testsuite/pr%d.c", "testsuite/xpr%d-2.C", "testsuite/pr-%d.c", "testsuite/0pr%d.f90", "testsuite/PR%dx", "testsuite/9Pr%d"]
TEST_NOTES = ["/* PR target/%d */", "// pr tree_opt.x/%d", "PR  c++/%d and", "SUPR target/%d", "no bug"]


def _numbered(texts, key, number):
    return F.replace(pick(texts, key), F.lit("%d"), F.col(number).cast("string"))


@query(f"""
WITH f AS (SELECT replace({pick_sql(TEST_NAMES, "o_orderkey")}, '%d', o_custkey::VARCHAR) AS path, replace({pick_sql(TEST_NOTES, "o_custkey")}, '%d', o_orderkey::VARCHAR) AS text FROM orders),
i AS (SELECT path, unnest(list_concat(regexp_extract_all(regexp_extract(path, '[^/]*$'), '(?i)(?:^|[^0-9])pr([0-9]{{4,}})(?:[^0-9]|$)', 1), regexp_extract_all(text, '(?i)\\bPR\\s+[a-z0-9_+.-]+/([0-9]{{4,}})', 1))) AS n FROM f)
SELECT DISTINCT n::BIGINT AS bug_id, path FROM i WHERE n::BIGINT IN (SELECT ps FROM (SELECT o_orderkey AS ps FROM orders UNION SELECT o_custkey FROM orders))""")
def linked_tests(spark, sf):
    o = table(spark, sf, "orders")
    tests = o.select(_numbered(TEST_NAMES, "o_orderkey", "o_custkey").alias("path"), _numbered(TEST_NOTES, "o_custkey", "o_orderkey").alias("text"))
    wanted = o.select(F.col("o_orderkey").alias("bug_id")).union(o.select("o_custkey"))
    return S.linked_tests(tests, True, wanted)


BASE_TIERS = ["not_loongarch", "architecture_specific", "multi_arch_shared", "not_loongarch", "not_loongarch"]


@query(f"""
SELECT o_orderkey, CASE WHEN {pick_sql(BASE_TIERS, "o_orderkey")} <> 'not_loongarch' THEN {pick_sql(BASE_TIERS, "o_orderkey")} WHEN o_orderstatus = 'P' THEN 'loongarch_testsuite_linked'
  WHEN o_custkey % 3 = 0 THEN 'loongarch_observed' WHEN o_custkey % 3 = 1 THEN 'loongarch_validation_only' ELSE 'not_loongarch' END AS tier FROM orders""")
def report_tiers(spark, sf):
    kind = F.when(F.col("o_custkey") % 3 == 0, F.array(F.lit("mention"), F.lit("failure"))).when(F.col("o_custkey") % 3 == 1, F.array(F.lit("validation"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf, "orders").select("o_orderkey", K.full_tier(pick(BASE_TIERS, "o_orderkey"), F.col("o_orderstatus") == "P", kind).alias("tier"))


@query("""
WITH g AS (SELECT o_orderkey AS pos, 'g' || o_custkey AS group_uid, 'c' || (o_orderkey % 50) AS candidate_id, ['f' || (o_orderkey % 7), 'f' || (o_custkey % 11)] AS uids FROM orders),
k AS (SELECT key, arg_max(uids, pos) AS uids FROM (SELECT group_uid AS key, pos, uids FROM g UNION ALL SELECT candidate_id, pos, uids FROM g) GROUP BY 1),
r AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN ['z', 'a', 'z', ''] ELSE [] END AS own, ['g' || user_id, 'c' || (event_id % 60)] AS keys FROM events),
f AS (SELECT event_id, string_agg(DISTINCT u, ';' ORDER BY u) AS found FROM (SELECT event_id, unnest(k.uids) AS u FROM (SELECT event_id, unnest(keys) AS key FROM r) x JOIN k ON k.key = x.key) GROUP BY 1)
SELECT r.event_id AS native_run_id, CASE WHEN len(own) > 0 THEN 'a;z' ELSE coalesce(found, '') END AS source_feature_uids FROM r LEFT JOIN f ON f.event_id = r.event_id""")
def native_run_sources(spark, sf):
    none = F.array().cast("array<string>")
    named = lambda letter, n: F.concat(F.lit(letter), n)
    o, e = table(spark, sf, "orders"), table(spark, sf, "events")
    groups = o.select(F.col("o_orderkey").alias("pos"), named("g", F.col("o_custkey")).alias("group_uid"), named("c", F.col("o_orderkey") % 50).alias("candidate_id"), F.array(named("f", F.col("o_orderkey") % 7), named("f", F.col("o_custkey") % 11)).alias("source_feature_uids"))
    own = F.when(F.col("event_id") % 4 == 0, F.array(*map(F.lit, ("z", "a", "z", "")))).otherwise(none)
    runs = e.select(F.col("event_id").alias("native_run_id"), own.alias("source_feature_uids"), F.array(named("g", F.col("user_id"))).alias("group_uids"), F.array(named("c", F.col("event_id") % 60)).alias("candidate_ids"))
    return B.native_sources(runs, groups).select("native_run_id", F.array_join("source_feature_uids", ";").alias("source_feature_uids"))


@query("""
WITH e AS (SELECT event_id, user_id, string_split('note ' || (event_id % 5) || chr(10) || repeat('line' || chr(10), (event_id % 30)::INT) || 'end', chr(10)) AS l FROM events WHERE event_type = 'error'),
s AS (SELECT event_id, user_id, array_to_string(l[greatest(len(l) - 19, 1):], chr(10)) AS t FROM e), g AS (SELECT o_custkey, max(o_orderkey) AS last_order FROM orders GROUP BY 1)
SELECT event_id, sha256(t) AS stderr_signature_sha256, coalesce(last_order, -1) AS last_order FROM s LEFT JOIN g ON g.o_custkey = s.user_id""")
def ice_triage(spark, sf):
    e, o = table(spark, sf, "events"), table(spark, sf, "orders")
    stderr = F.concat(F.lit("note "), F.col("event_id") % 5, F.lit("\n"), F.expr("repeat('line\\n', cast(event_id % 30 as int))"), F.lit("end"))
    runs = e.select(F.when(F.col("event_type") == "error", "ice").otherwise("covered").alias("evaluation_status"), F.col("user_id").alias("candidate_id"), F.col("event_id").alias("instantiation_id"), stderr.alias("stderr"))
    groups = o.select(F.col("o_custkey").alias("candidate_id"), F.col("o_orderkey").alias("pos"), F.array("o_orderkey").alias("source_bug_ids"))
    out = V.ice_candidates(runs, groups)
    return out.select(F.col("instantiation_id").alias("event_id"), "stderr_signature_sha256", F.coalesce(F.try_element_at("source_bug_ids", F.lit(1)), F.lit(-1)).alias("last_order"))


@query("""
WITH RECURSIVE e AS (SELECT 's' || l_suppkey AS a, 'p' || l_partkey AS b FROM lineitem WHERE l_quantity >= 49 AND l_linenumber = 7), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS seen FROM u UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.seen)
SELECT node, min(seen) AS component FROM r GROUP BY node""")
def graph_connectivity(spark, sf):
    i = table(spark, sf, "lineitem").where("l_quantity >= 49 AND l_linenumber = 7")
    edges = i.select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst")).distinct()
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    return G.connected_groups(nodes, edges)


@query()
def prompt_ladder(spark, sf):
    """Documents with the turns of a conversation as comments, packed within 4,000 characters: JSON sizes have no SQL."""
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("count"), "text", F.lit(None).cast("long").alias("attachment_id")))).alias("comments"))
    d = table(spark, sf, "documents").join(c, F.col("doc_id") == F.col("conv_id"), "left")
    none = F.array().cast("array<struct<count:bigint,text:string,attachment_id:bigint>>")
    record = d.select(F.col("doc_id").alias("bug_id"), F.lit("").alias("description"), F.coalesce("comments", none).alias("comments"), F.array().cast("array<bigint>").alias("fix_counts"), F.array("text").alias("programs"))
    return C.prompt_ladder(record, 4000).select("bug_id", "step", F.length("prompt").alias("chars"))


@query("""
WITH f AS (SELECT row_number() OVER (ORDER BY event_id) AS pos, event_type AS source, user_id AS bug_id, strftime(ts, '%Y-%m-%d') AS last_change_time FROM events),
l AS (SELECT bug_id, arg_max(last_change_time, pos) AS last_change_time, string_agg(DISTINCT source, ';' ORDER BY source) AS discovery_sources FROM f GROUP BY 1)
SELECT * FROM l ORDER BY last_change_time DESC, bug_id DESC LIMIT 80""")
def discover_reports(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("pos"), F.col("event_type").alias("source"), F.col("user_id").alias("bug_id"), F.date_format("ts", "yyyy-MM-dd").alias("last_change_time"))
    out = C.discover(e, 80)
    return out.select("bug_id", "last_change_time", F.array_join("discovery_sources", ";").alias("discovery_sources"))


@query("SELECT word AS tag, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1")
def exploded_histogram(spark, sf):
    return table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- instantiations and covered corpora

PROGRAM_LANGUAGES = ["c", "C++", "cxx", "fortran", ""]


@query("SELECT o_orderkey AS group_uid FROM orders WHERE o_orderkey IN (1, 7, 33, 12, 40, 44) OR o_custkey IN (1, 7, 33, 12, 40, 44)")
def selected_groups(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("group_uid"), F.col("o_custkey").cast("string").alias("candidate_id"), F.lit("c").alias("language"))
    return I.select_groups(o, ["1", "7", "33", "12", "40", "44"]).select(F.col("group_uid").cast("long").alias("group_uid"))


@query(f"""
WITH p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'id ' || o_orderkey || '/x' ELSE '' END AS own, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'c ' || o_custkey END AS cand, 'g' || o_custkey AS grp, o_orderstatus AS status,
  lower({pick_sql(PROGRAM_LANGUAGES, "o_orderkey")}) AS lang, CASE WHEN o_orderkey % 2 = 0 THEN 'dir/my prog.v2.c' ELSE '' END AS file, o_comment AS source FROM (SELECT *, 'int x; // ' || o_custkey || CASE WHEN o_custkey % 2 = 0 THEN chr(10) ELSE '' END AS o_comment FROM orders)),
n AS (SELECT *, CASE WHEN own <> '' THEN regexp_replace(own, '[^A-Za-z0-9_.-]+', '_', 'g') ELSE regexp_replace(coalesce(cand, grp), '[^A-Za-z0-9_.-]+', '_', 'g') || '-' ||
  left(sha256('{{"candidate_id":' || CASE WHEN cand IS NULL THEN 'null' ELSE '"' || cand || '"' END || ',"group_uid":"' || grp || '","status":"' || status || '"}}'), 16) END AS id, CASE WHEN source LIKE '%' || chr(10) THEN source ELSE source || chr(10) END AS content FROM p)
SELECT id AS instantiation_id, 'programs/' || id || '.' || CASE WHEN file = '' THEN id ELSE 'my_prog.v2' END || CASE WHEN lang = 'c' THEN '.c' WHEN lang IN ('c++', 'cxx') THEN '.cc' WHEN lang = 'fortran' THEN '.f90' ELSE '.txt' END AS path,
  octet_length(encode(content)) AS bytes, sha256(content) AS sha256 FROM n""")
def program_files(spark, sf):
    o, none = table(spark, sf, "orders"), F.lit(None).cast("string")
    key, who = F.col("o_orderkey"), F.col("o_custkey")
    rows = o.select(
        F.when(key % 3 == 0, F.concat(F.lit("id "), key, F.lit("/x"))).otherwise("").alias("instantiation_id"), F.when(key % 5 == 0, none).otherwise(F.concat(F.lit("c "), who)).alias("candidate_id"),
        F.concat(F.lit("g"), who).alias("group_uid"), F.col("o_orderstatus").alias("instantiation_status"), pick(PROGRAM_LANGUAGES, "o_orderkey").alias("language"),
        F.when(key % 2 == 0, "dir/my prog.v2.c").otherwise("").alias("file_name"), F.concat(F.lit("int x; // "), who, F.when(who % 2 == 0, "\n").otherwise("")).alias("source_code"),
    )
    return I.program_files(rows).drop("content")


def _evaluations(spark, sf):
    path = F.concat(F.lit("p/"), F.col("event_id") % 400, pick([".c", ".cc", "", ".s"], "event_id"))
    e = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "purchase", "covered").otherwise("failed").alias("evaluation_status"), F.concat(F.lit("i"), "event_id").alias("instantiation_id"), F.concat(F.lit("c"), F.col("user_id") % 200).alias("candidate_id"),
        F.concat(F.lit("g"), F.col("user_id") % 90).alias("group_uid"), pick(["c", "c++", "cxx", ""], "event_id").alias("language"), path.alias("source_path"),
    )
    return e, e.select(F.col("source_path").alias("path"), F.sha2("source_path", 256).alias("sha256")).where("path NOT LIKE '%7%'").distinct()


EVALUATIONS = """
e AS (SELECT event_type = 'purchase' AS covered, 'i' || event_id AS id, 'c' || (user_id % 200) AS cand, 'g' || (user_id % 90) AS grp, (['c', 'c++', 'cxx', ''])[event_id % 4 + 1] AS lang,
  'p/' || (event_id % 400) || (['.c', '.cc', '', '.s'])[event_id % 4 + 1] AS path FROM events)"""


@query(f"WITH {EVALUATIONS} SELECT path AS source, id || regexp_extract(path, '[.][a-z]+$') AS target, sha256(path) AS sha256 FROM e WHERE covered AND path NOT LIKE '%7%'")
def covered_corpus(spark, sf):
    return I.covered_corpus(*_evaluations(spark, sf))


@query(f"""
WITH {EVALUATIONS}, f AS (SELECT * FROM e WHERE covered AND lang IN ('c++', 'cxx') AND path NOT LIKE '%7%' AND cand IN (SELECT 'c' || (o_custkey % 120) FROM orders WHERE o_orderstatus = 'F')),
g AS (SELECT p_partkey AS pos, 'g' || (p_partkey % 60) AS grp, 'c' || (p_partkey % 150) AS cand, ['f' || (p_partkey % 13), ''] AS uids FROM part),
k AS (SELECT key, arg_max(uids, pos) AS uids FROM (SELECT grp AS key, pos, uids FROM g UNION ALL SELECT cand, pos, uids FROM g) GROUP BY 1),
s AS (SELECT unnest(coalesce(a.uids, b.uids)) AS id FROM f LEFT JOIN k a ON a.key = f.grp LEFT JOIN k b ON b.key = f.cand)
SELECT 'candidate' AS kind, cand AS id FROM f UNION SELECT 'group', grp FROM f UNION SELECT 'feature', id FROM s WHERE id <> ''""")
def seed_corpus(spark, sf):
    e, sources = _evaluations(spark, sf)
    ready = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("c"), F.col("o_custkey") % 120).alias("candidate_id"))
    part = F.col("p_partkey")
    groups = table(spark, sf, "part").select(part.alias("pos"), F.concat(F.lit("g"), part % 60).alias("group_uid"), F.concat(F.lit("c"), part % 150).alias("candidate_id"), F.array(F.concat(F.lit("f"), part % 13), F.lit("")).alias("source_feature_uids"))
    return I.seed_corpus(e, ready, groups, sources, "c++")[1]


VECTOR_NOTES = ["built with -mlsx", "__lasx_xvadd here", "the loop is not vectorized", "a/vect/b.c", "plain", "lsxx and mlasx"]


@query(f"""
WITH r AS (SELECT o_custkey AS bug, {pick_sql(VECTOR_NOTES, "o_orderkey")} AS t, o_orderstatus = 'F' AS core, o_orderstatus <> 'O' AS wide FROM orders),
x AS (SELECT bug, core, wide, t IN ('built with -mlsx') AS lsx, t = '__lasx_xvadd here' AS lasx, t IN ('built with -mlsx', '__lasx_xvadd here', 'the loop is not vectorized', 'a/vect/b.c') AS vector FROM r),
s AS (SELECT *, 'all' AS scope FROM x UNION ALL SELECT *, 'core' FROM x WHERE core UNION ALL SELECT *, 'expanded' FROM x WHERE wide)
SELECT scope, extension, count(DISTINCT bug) AS reports FROM (SELECT scope, bug, unnest(list_filter([CASE WHEN lsx THEN 'lsx' END, CASE WHEN lasx THEN 'lasx' END, CASE WHEN vector THEN 'vector' END], lambda v: v IS NOT NULL)) AS extension FROM s) GROUP BY 1, 2""")
def vector_mentions(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("bug_id"), pick(VECTOR_NOTES, "o_orderkey").alias("search_text"), (F.col("o_orderstatus") == "F").alias("llm_ready"), (F.col("o_orderstatus") != "O").alias("expanded_llm_ready"))
    return I.vector_mentions(o, K.LSX, K.LASX)


@query("""
WITH r AS (SELECT DISTINCT event_type, user_id FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS place FROM r)
SELECT event_type, count(*) AS n, string_agg(CASE WHEN place <= 50 THEN user_id END, ';' ORDER BY user_id) AS ids FROM k GROUP BY 1""")
def first_errors(spark, sf):
    return I.first_errors(table(spark, sf, "events"), "event_type", "user_id").withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ";"))
