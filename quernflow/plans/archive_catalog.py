"""Queries over the driver tables for archives, written files, rebuilt tables and model inputs, each with the SQL that says the same.

Documents stand in for reports, the turns of conversations for test cases, nations for recorded searches. Faults are planted by
remainders of keys, alike on both sides, so that each rule is broken somewhere.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quernflow.functions import text as T
from quernflow.operators import coverage as V
from quernflow.operators import inputs as N
from quernflow.operators.digests import reconcile
from quernflow.operators.rebuild import Kept
from quernflow.plans import archive as A
from quernflow.plans.catalog import FIXES, MARK_SQL, pick, pick_sql, query
from quernflow.scratch import fresh_path
from quernflow.session import table
from quernflow.sources import files, named_files

TIERS = ["architecture_specific", "architecture_specific", "multi_arch_shared", "not_loongarch", "loongarch_observed", "loongarch_validation_only", "architecture_specific"]
KINDS = ["comment_code_block", "gcc_testsuite_regression", "bugzilla_attachment", "other"]
_LISTED = {"ready": "i % 4 = 0", "expanded": "i % 4 IN (0, 1)", "general": "i % 2 = 0"}
_LIST_FAULTS = {"ready": "i % 31 <> 3", "expanded": "i % 43 <> 1", "general": "i % 47 <> 2"}


def _archive(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id AS i", "if(doc_id % 101 = 4, ' ', coalesce(text, '')) AS text", "concat('reports/bug-', doc_id) AS folder")
    turns = table(spark, sf, "conversations").selectExpr("conv_id AS i", "turn", "sha2(text, 256) AS sha", "concat('reports/bug-', conv_id, '/testcases/', turn, '.c') AS path")
    nation = table(spark, sf, "nation")
    flags = [f"({c}) AS {A.FLAGS[n]}" for n, c in _LISTED.items()]
    pick = lambda values, key: f"element_at(array({', '.join(map(repr, values))}), cast({key} AS int) + 1)"
    reports = docs.selectExpr(
        "if(i % 97 = 5, i + 1000000000, i) AS bug_id", "concat(folder, '/report.json') AS path", "folder", f"if(i % 53 = 1, 'http://other/', concat('{A.WEB}show_bug.cgi?id=', if(i % 97 = 5, i + 1000000000, i))) AS source_url",
        "text AS description", "if(i % 41 = 2, concat(text, '!'), text) AS first_comment", f"{pick(TIERS, 'i % 7')} AS tier", "if(i % 5 = 4, 'loongarch32', 'loongarch64') AS scope", "i % 13 <> 6 AS eligible", "cast(i % 3 AS int) AS n_testcases", *flags,
    )
    files = docs.selectExpr("explode(array(if(i % 83 <> 1, 'report.json', ''), if(i % 79 <> 1, 'report.md', ''), if(i % 73 <> 1, 'raw/bug.json', ''), if(i % 71 <> 1, 'raw/comments.json', ''), if(i % 67 <> 1, 'raw/attachments.json', ''))) AS name", "folder")
    files = files.where("name <> ''").selectExpr("concat(folder, '/', name) AS path", "cast(null AS string) AS sha256").unionByName(turns.where("(i + turn) % 11 <> 3").selectExpr("path", "sha AS sha256"))
    files = files.unionByName(nation.where("n_nationkey % 5 <> 0").selectExpr("if(n_nationkey = 1, 'manifest.json', concat('raw/', n_name)) AS path", "cast(null AS string) AS sha256"))
    manifest = nation.selectExpr("n_name AS raw_file").agg(F.collect_list(F.struct("raw_file")).alias("queries")).selectExpr("queries", "array('late') AS errors", "'http://other/rest' AS base_url")
    figures = docs.agg((F.count("*") - 1).alias("value")).selectExpr("explode(array('candidate_reports', 'llm_ready_reports', 'llm_dataset_records')) AS name", "value")
    out = {
        "reports": reports, "files": files, "manifest": manifest, "figures": figures, "index": docs.selectExpr("i AS bug_id", "if(i % 89 = 7, concat(folder, 'x/report.json'), concat(folder, '/report.json')) AS report_path", *flags),
        "testcases": turns.selectExpr("i AS bug_id", "path", "if(turn % 7 = 3, 'bad', sha) AS sha256", f"{pick(KINDS, '(i + turn) % 4')} AS kind", f"if(i % 6 = 1, null, '{A.WEB}x') AS source_url", "if(i % 5 = 1, '', 'r1') AS revision"),
    }
    for n, c in _LISTED.items():
        out[f"{n}_list"] = docs.where(f"({c}) AND {_LIST_FAULTS[n]}").selectExpr("i AS bug_id")
        out[f"{n}_dataset"] = docs.where(f"({c} OR i % 61 = 3) AND i % 29 <> 5").selectExpr("i AS bug_id", "if(i % 59 = 0, concat(text, '?'), text) AS description", "if(i % 5 = 4, 'loongarch32', 'loongarch64') AS scope", "cast(i % 3 AS int) AS n_testcases")
        out[f"{n}_testcases"] = turns.selectExpr("i AS bug_id", "path AS source_path", "if(turn % 2 = 1 AND i % 4 = 3, 'same', sha) AS source_sha256")
    return out


def _sql() -> str:
    def bad(rule, key, source, where):
        return f"SELECT '{rule}' AS rule, ({key})::VARCHAR AS key FROM {source} WHERE {where}"

    missing = lambda path: f"({path}) NOT IN (SELECT path FROM files)"
    tiers = ", ".join(f"'{t}'" for t in A.EXPANDED_TIERS)
    rules = [
        bad("manifest_errors", "'manifest'", "(SELECT 1)", "true"), bad("manifest_source", "'manifest'", "(SELECT 1)", "true"),
        bad("required_file", "p", f"(SELECT unnest([{', '.join(repr(p) for p in (*A.REQUIRED, 'raw/version.json'))}]) AS p UNION ALL SELECT 'raw/' || n_name FROM nation)", missing("p")),
        bad("report_file", "i", "idx", missing("rp")), bad("report_row", "i", "idx", "rp NOT IN (SELECT path FROM rep)"), bad("report_id", "idx.i", "idx JOIN rep ON rp = path", "idx.i <> bug"),
        bad("report_markdown", "bug", "rep", missing("folder || '/report.md'")), *[bad(f"report_raw_{n}", "bug", "rep", missing(f"folder || '/raw/{n}.json'")) for n in A.RAW_OF_REPORT],
        bad("report_source", "bug", "rep", "i % 53 = 1"), bad("report_description", "bug", "rep", "i % 41 = 2"), bad("report_relevant", "bug", "rep", "tier = 'not_loongarch'"),
        bad("testcase_file", "path", "t", missing("path")), bad("testcase_checksum", "path", "t JOIN files USING (path)", "t.s <> files.sha"),
        bad("testcase_provenance", "path", "t", "kind IN ('comment_code_block', 'bugzilla_attachment') AND i % 6 = 1"), bad("testcase_revision", "path", "t", "kind = 'gcc_testsuite_regression' AND i % 5 = 1"),
        bad("figure_reports", "'candidate_reports'", "(SELECT 1)", "true"), bad("figure_testcases", "'testcase_artifacts'", "(SELECT 1)", "true"),
    ]
    for name, flag, tier in (("ready", _LISTED["ready"], "tier = 'architecture_specific'"), ("expanded", _LISTED["expanded"], f"tier IN ({tiers})")):
        wants = {"tier": tier, "scope": "i % 5 <> 4", "disposition": "i % 13 <> 6", "description": r"regexp_matches(text, '\S')", "testcases": "i % 3 > 0"}
        rules += [bad(f"{name}_{what}", "bug", "rep", f"{flag} AND NOT ({c})") for what, c in wants.items()]
    for n, c in _LISTED.items():
        members, data = f"SELECT i FROM d WHERE {c} AND {_LIST_FAULTS[n]}", f"SELECT * FROM d WHERE ({c} OR i % 61 = 3) AND i % 29 <> 5"
        flagged, own = f"SELECT i FROM d WHERE {c}", f"SELECT i FROM ({data})"
        rules += [bad(rule, "i", f"(({a} EXCEPT {b}) UNION ({b} EXCEPT {a}))", "true") for rule, a, b in ((f"{n}_list", flagged, members), (f"{n}_dataset", members, own))]
        rules += [bad(f"figure_{n}_list", f"'{A.FIGURES[n]}'", "(SELECT 1)", "true"), bad(f"figure_{n}_dataset", f"'{A.FIGURES[n].replace('_ready_reports', '_dataset_records')}'", "(SELECT 1)", "true")]
        rules += [bad(f"{n}_dataset_description", "i", f"({data})", "i % 59 = 0 AND i % 97 <> 5"), bad(f"{n}_dataset_testcases", "i", f"({data})", "i % 3 = 0")]
        rules += [bad(f"{n}_dataset_source", "path", "t", missing("path")), bad(f"{n}_dataset_checksum", "path", "t", "turn % 2 = 1 AND i % 4 = 3 AND path IN (SELECT path FROM files)")]
        if n != "ready":
            rules.append(bad(f"{n}_dataset_eligible", "i", f"({data})", f"NOT ({c}) AND i % 97 <> 5"))
        if n != "general":
            repeats = "(SELECT i, CASE WHEN turn % 2 = 1 AND i % 4 = 3 THEN 'same' ELSE sha END AS s, count(*) AS n FROM t GROUP BY 1, 2)"
            rules += [bad(f"{n}_dataset_scope", "i", f"({data})", "i % 5 = 4"), f"SELECT DISTINCT '{n}_dataset_repeats', i::VARCHAR FROM {repeats} WHERE n > 1"]
    case = lambda values, key: f"([{', '.join(map(repr, values))}])[{key} + 1]"
    return f"""
WITH d AS (SELECT doc_id AS i, CASE WHEN doc_id % 101 = 4 THEN ' ' ELSE coalesce(text, '') END AS text, 'reports/bug-' || doc_id AS folder FROM documents),
rep AS (SELECT *, CASE WHEN i % 97 = 5 THEN i + 1000000000 ELSE i END AS bug, folder || '/report.json' AS path, {case(TIERS, "i % 7")} AS tier FROM d),
idx AS (SELECT i, CASE WHEN i % 89 = 7 THEN folder || 'x/report.json' ELSE folder || '/report.json' END AS rp FROM d),
t AS (SELECT conv_id AS i, turn, sha256(text) AS sha, CASE WHEN turn % 7 = 3 THEN 'bad' ELSE sha256(text) END AS s, 'reports/bug-' || conv_id || '/testcases/' || turn || '.c' AS path, {case(KINDS, "(conv_id + turn) % 4")} AS kind FROM conversations),
files AS (SELECT path, NULL AS sha FROM rep WHERE i % 83 <> 1 UNION ALL SELECT folder || '/report.md', NULL FROM d WHERE i % 79 <> 1 UNION ALL SELECT folder || '/raw/bug.json', NULL FROM d WHERE i % 73 <> 1
  UNION ALL SELECT folder || '/raw/comments.json', NULL FROM d WHERE i % 71 <> 1 UNION ALL SELECT folder || '/raw/attachments.json', NULL FROM d WHERE i % 67 <> 1 UNION ALL SELECT path, sha FROM t WHERE (i + turn) % 11 <> 3
  UNION ALL SELECT CASE WHEN n_nationkey = 1 THEN 'manifest.json' ELSE 'raw/' || n_name END, NULL FROM nation WHERE n_nationkey % 5 <> 0)
{" UNION ALL ".join(rules)}"""


@query(_sql())
def archive_violations(spark, sf):
    return A.archive_violations(_archive(spark, sf)).select("rule", "key")


@query("""
WITH e AS (SELECT 'i' || event_id AS id, 'u/' || (user_id % 10) || '/' || event_id || CASE WHEN event_id % 3 = 0 THEN '.c' ELSE '.cc' END AS path, props AS content FROM events WHERE event_type = 'purchase')
SELECT path, octet_length(encode(content)) AS bytes, sha256(content) AS sha256, true AS listed FROM e""")
def written_files(spark, sf):
    """The properties of purchases as files, written twice, read back and held against the manifest."""
    path = F.expr("concat('u/', user_id % 10, '/', event_id, if(event_id % 3 = 0, '.c', '.cc'))")
    rows = table(spark, sf, "events").where("event_type = 'purchase'").select(path.alias("path"), F.col("props").alias("content"))
    root = fresh_path(spark, "named")
    named_files.write_files(rows.withColumn("content", F.concat("content", F.lit(" "))), root)
    listed = named_files.write_files(rows, root)
    faults = named_files.verify(spark, root)
    return listed.join(faults, "path", "left").select("path", "bytes", "sha256", F.col("fault").isNull().alias("listed"))


@query("""
WITH n AS (SELECT doc_id, coalesce(len(regexp_extract_all(lower(text), '[a-z]+')), 0)::BIGINT AS n_words, length(text)::BIGINT AS chars FROM documents)
SELECT doc_id, n_words, chars, CASE WHEN doc_id % 10 = 3 OR doc_id % 17 = 5 THEN 2 ELSE 1 END AS made_in FROM n""")
def rebuilt_words(spark, sf):
    """Word counts of all documents, kept: made from a table where some texts were others, some missing and some too many, then
    rebuilt twice from the table as it is."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    before = docs.where("doc_id % 17 <> 5").withColumn("text", F.expr("if(doc_id % 10 = 3, concat(text, ' and more words'), text)"))
    before = before.unionByName(docs.where("doc_id % 23 = 2").select((F.col("doc_id") + 1_000_000_000).alias("doc_id"), "text"))
    kept = Kept(spark, fresh_path(spark, "kept"), ["doc_id"], 64)
    words = F.coalesce(F.regexp_count(F.lower("text"), F.lit("[a-z]+")), F.lit(0)).cast("long")
    counts = lambda rows, made_in: lambda keys: rows.join(keys, "doc_id", "left_semi").select("doc_id", words.alias("n_words"), F.length("text").cast("long").alias("chars"), F.lit(made_in).alias("made_in"))
    kept.rebuild(before, counts(before, 1), "first")
    kept.rebuild(docs, counts(docs, 2), "first")
    kept.rebuild(docs, counts(docs, 3), "first")
    return kept.read()


@query("""
WITH o AS (SELECT o_custkey AS key, o_orderkey AS a, o_totalprice AS b FROM orders),
l AS (SELECT key, a, b FROM o WHERE key % 19 <> 4),
r AS (SELECT key, a, CASE WHEN key % 31 = 7 THEN b + 1 ELSE b END AS b FROM o WHERE key % 23 <> 6 UNION ALL SELECT key, a, b FROM o WHERE key % 37 = 2 AND key % 23 <> 6),
k AS (SELECT key, (SELECT count(*) FROM l WHERE l.key = x.key) AS left_rows, (SELECT count(*) FROM r WHERE r.key = x.key) AS right_rows FROM (SELECT DISTINCT key FROM o) x)
SELECT key, CASE WHEN right_rows = 0 THEN 'left' WHEN left_rows = 0 THEN 'right' ELSE 'differ' END AS fault, left_rows, right_rows FROM k
WHERE left_rows + right_rows > 0 AND (left_rows = 0 OR right_rows = 0 OR key % 31 = 7 OR key % 37 = 2)""")
def reconciled_orders(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("a"), F.col("o_totalprice").alias("b"))
    right = o.where("key % 23 <> 6")
    again = right.where("key % 37 = 2")
    right = right.withColumn("b", F.expr("if(key % 31 = 7, b + 1, b)")).unionByName(again)
    return reconcile(o.where("key % 19 <> 4"), right, ["key"], buckets=256)


def _inputs(spark, sf):
    """Documents as reports, turns as comments with a note on fixes, every other turn as a program, events as attachments."""
    docs, turns, events = (table(spark, sf, n) for n in ("documents", "conversations", "events"))
    none = lambda kind: F.lit(None).cast(kind)
    reports = docs.select(F.col("doc_id").alias("bug_id"), none("string").alias("source_url"), F.col("text").alias("description"), "lang")
    note = F.concat(pick(FIXES, "conv_id + turn"), F.lit(" "), "text")
    comments = turns.select(F.col("conv_id").alias("bug_id"), F.col("turn").cast("long").alias("count"), none("string").alias("time"), none("long").alias("attachment_id"), note.alias("text"))
    programs = turns.where("turn % 2 = 1").select(F.col("conv_id").alias("bug_id"), F.col("turn").alias("index"), F.col("role").alias("kind"), none("string").alias("language"), F.lit("p.c").alias("path"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"), F.col("text").alias("content"))
    patches = events.select(F.col("user_id").alias("bug_id"), F.col("event_id").alias("index"), F.col("event_id").alias("id"), F.col("event_type").alias("summary"), none("string").alias("file_name"), (F.col("event_id") % 7 == 0).alias("is_patch"), none("boolean").alias("downloaded"))
    return N.prepared_inputs(reports, comments, programs, patches, 200, 100)


_HASHES = r"regexp_extract_all(t, '\b([0-9a-f]{12,40})\b', 1)"


@query(f"""
WITH c AS (SELECT conv_id AS bug_id, turn, {pick_sql(FIXES, "(conv_id + turn)")} || ' ' || text AS raw FROM conversations),
k AS (SELECT bug_id, turn, CASE WHEN length(raw) <= 200 THEN raw ELSE left(raw, 72) || {MARK_SQL} || right(raw, 72) END AS t, length(raw) > 200 AS cut, regexp_matches(raw, '{T.FIX_EVIDENCE}') AS fix FROM c),
p AS (SELECT conv_id AS bug_id, turn, CASE WHEN length(text) <= 100 THEN text ELSE left(text, 22) || {MARK_SQL} || right(text, 22) END AS t FROM conversations WHERE turn % 2 = 1),
h AS (SELECT bug_id, turn, unnest({_HASHES}) AS h, generate_subscripts({_HASHES}, 1) AS i FROM k WHERE fix),
f AS (SELECT bug_id, string_agg(h, ';' ORDER BY p) AS hashes FROM (SELECT bug_id, h, min((turn, i)) AS p FROM h GROUP BY 1, 2) GROUP BY 1),
cs AS (SELECT bug_id, count(*) AS n, count(*) FILTER (cut) AS cut, count(*) FILTER (fix) AS fixes, string_agg(t, '|' ORDER BY turn) AS ts FROM k GROUP BY 1), ps AS (SELECT bug_id, count(*) AS n, string_agg(t, '|' ORDER BY turn) AS ts FROM p GROUP BY 1),
es AS (SELECT user_id AS bug_id, count(*) AS n FROM events WHERE event_id % 7 = 0 GROUP BY 1),
a AS (SELECT doc_id, length(text)::INT AS chars, coalesce(cs.n, 0)::INT AS comments, coalesce(cut, 0)::INT AS clipped, coalesce(ps.n, 0)::INT AS programs, (coalesce(fixes, 0) + coalesce(es.n, 0))::INT AS evidence, coalesce(hashes, '') AS commit_hashes,
  sha256(coalesce(cs.ts, '')) AS comments_sha256, sha256(coalesce(ps.ts, '')) AS programs_sha256 FROM documents LEFT JOIN cs ON cs.bug_id = doc_id LEFT JOIN ps ON ps.bug_id = doc_id LEFT JOIN es ON es.bug_id = doc_id LEFT JOIN f ON f.bug_id = doc_id)
SELECT *, concat_ws(';', CASE WHEN programs = 0 THEN '{N.NO_PROGRAM}' END, CASE WHEN evidence = 0 THEN '{N.NO_FIX}' END) AS gaps FROM a""")
def prepared_inputs(spark, sf):
    texts = lambda c, name: F.sha2(F.array_join(F.transform(c, lambda x: x[name]), "|"), 256)
    return _inputs(spark, sf).select(
        F.col("bug_id").alias("doc_id"), F.length("description").alias("chars"), F.size("comments").alias("comments"), F.size(F.filter("comments", lambda c: c["truncated"])).alias("clipped"), F.size("programs").alias("programs"),
        F.col("fix_history.evidence_count").alias("evidence"), F.array_join("fix_history.commit_hashes", ";").alias("commit_hashes"), texts("comments", "text").alias("comments_sha256"), texts("programs", "content").alias("programs_sha256"),
        F.array_join("evidence_gaps", ";").alias("gaps"),
    )


@query("""
WITH l AS (SELECT 'f' || (l_partkey % 20) || '.c' AS f, l_partkey AS line, l_quantity > 30 AS hit, l_linenumber AS n, 'fn' || (l_partkey % 50) AS fn, l_discount > 0.05 AS b FROM lineitem WHERE l_suppkey % 17 <> 3 AND l_partkey % 20 <> 7),
s AS (SELECT f, count(DISTINCT line) AS lines_total, count(DISTINCT line) FILTER (hit) AS lines_covered, count(DISTINCT fn) AS functions_total, count(DISTINCT fn) FILTER (hit) AS functions_covered,
  count(DISTINCT line * 2) AS b0, count(DISTINCT line) FILTER (b) AS b0_covered, count(DISTINCT line) FILTER (n > 2) AS b1, count(DISTINCT line) FILTER (n > 2 AND hit) AS b1_covered FROM l GROUP BY f)
SELECT '/src/gcc/' || f AS file, lines_total, lines_covered, functions_total, functions_covered, b0 + b1 AS branches_total, b0_covered + b1_covered AS branches_covered,
  (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_suppkey % 17 = 3) AS damaged FROM s""")
def gcov_rollup(spark, sf):
    """A coverage file for each supplier, with its lines as sources, some cut off in the middle, read back and merged."""
    i = table(spark, sf, "lineitem")
    number = lambda c: F.when(c, F.lit(3)).otherwise(F.lit(0)).cast("long")
    hit = F.col("l_quantity") > 30
    branch = lambda c: F.struct(number(c).alias("count"))
    branches = F.when(F.col("l_linenumber") > 2, F.array(branch(F.col("l_discount") > 0.05), branch(hit))).otherwise(F.array(branch(F.col("l_discount") > 0.05)))
    line = F.struct(F.col("l_partkey").alias("line_number"), number(hit).alias("count"), branches.alias("branches"))
    name = F.concat(F.when(F.col("l_partkey") % 20 == 7, "../../other/").when(F.col("l_partkey") % 3 == 0, "a/b/c/../.././../").otherwise("./"), F.lit("f"), F.col("l_partkey") % 20, F.lit(".c"))
    one = F.struct(name.alias("file"), F.array(line).alias("lines"), F.array(F.struct(F.concat(F.lit("fn"), F.col("l_partkey") % 50).alias("name"), number(hit).alias("execution_count"))).alias("functions"))
    payload = i.groupBy("l_suppkey").agg(F.to_json(F.struct(F.collect_list(one).alias("files"))).alias("json"))
    content = F.when(F.col("l_suppkey") % 17 == 3, F.expr("left(json, int(length(json) / 2))")).otherwise(F.col("json"))
    root = fresh_path(spark, "gcov")
    named_files.write_files(payload.select(F.concat("l_suppkey", F.lit(".gcov.json")).alias("path"), content.alias("content")), root)
    read = files.read_gcov(spark, f"{root}/*.gcov.json", "/src/gcc")
    damaged = read["read"].where("status = 'damaged'").agg(F.count("*").alias("damaged"))
    return V.source_coverage(read["lines"], read["functions"], read["branches"]).crossJoin(F.broadcast(damaged))  # a single row
