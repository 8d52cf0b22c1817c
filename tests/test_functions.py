"""Text functions and classifiers on small literals."""

import json

from pyspark.sql import functions as F

from quernflow.functions import classify as K
from quernflow.functions import features as X
from quernflow.functions import text as T

FEATURE = (
    "feature_uid string, bug_id long, feature_type string, description string, code_witness string, evidence_strength string, language string, compiler_area string, "
    "failure_mode string, target_options array<string>, mutation_knobs array<string>, composition_tags array<string>, confidence double, root_cause_summary string"
)


def one(spark, column, **values):
    names = list(values) or ["x"]
    df = spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{n} {'array<string>' if isinstance(values.get(n), list) else 'string'}" for n in names) if values else "x int")
    return df.select(column.alias("r")).first()["r"]


def test_clip_keeps_head_and_tail(spark):
    text = "a" * 300 + "b" * 300
    got = one(spark, T.clip(F.col("t"), 200), t=text)
    assert len(got) == 200 and got.startswith("a") and got.endswith("b") and "truncated" in got
    assert one(spark, T.clip(F.col("t"), 0), t=text) == text
    assert one(spark, T.clip(F.col("t"), 10), t=None) == ""


def test_names(spark):
    assert one(spark, T.safe_filename(F.col("t")), t="a/b\\c d?.txt") == "a_b_c_d_.txt"
    assert one(spark, T.safe_filename(F.col("t")), t="...") == "artifact"
    assert one(spark, T.redact_secrets(F.col("t")), t="key sk-abcdefgh1 ok") == "key <redacted-api-key> ok"
    assert one(spark, T.canonical_glue_id(F.col("t")), t="g12-some_thing") == "G12"
    assert one(spark, T.canonical_glue_id(F.col("t")), t="G0") is None
    assert one(spark, T.safe_stem(F.col("t"), F.lit("x")), t="dir/my file.c") == "my_file"
    assert one(spark, T.indent(F.col("t")), t="a\nb") == "    a\n    b"


def test_languages(spark):
    empty = F.lit("")
    assert one(spark, T.language_for(F.col("t"), empty, empty), t="x.C") == "c++"
    assert one(spark, T.language_for(F.col("t"), empty, empty), t="x.F90") == "fortran"
    assert one(spark, T.language_for(F.col("t"), F.lit("text/x-csrc; a"), empty), t="x") == "c"
    assert one(spark, T.language_for(F.col("t"), empty, F.lit("CPP")), t="x") == "c++"
    assert one(spark, T.language_for_content(F.col("t")), t="std::vector<int> v;") == "c++"
    assert one(spark, T.language_for_content(F.col("t")), t="nothing") == "unknown"
    assert one(spark, T.canonical_language(F.col("t")), t=" CXX ") == "c++"
    assert one(spark, T.language_for_wrapper(F.col("t")), t="fortran") == "c"


def test_options(spark):
    given = ["-O2", "-o", "out", "-lm", " ", "-Wall", "-c", "-static", "-Wl,-z"]
    assert one(spark, T.sanitize_options(F.col("t")), t=given) == ["-Ofast", "-Wall"]
    assert one(spark, T.sanitize_options(F.col("t"), "preserve"), t=given) == ["-O2", "-Wall"]
    assert one(spark, T.sanitize_options(F.col("t"), "preserve"), t=["-Wall"]) == ["-O2", "-Wall"]
    assert one(spark, T.replay_options(F.col("t")), t=["-x", "c", "-O1", "-pipe", "-g"]) == ["-O1", "-g"]


def test_model_answers(spark):
    for text, want in [('{"a":1}', '{"a":1}'), ('x\n```json\n{"a":2}\n```', '{"a":2}'), ('so {"a":3} there', '{"a":3}'), ("no", None), ("[1]", None)]:
        assert one(spark, T.parse_json_content(F.col("t")), t=text) == want
    assert one(spark, T.model_content(F.col("t")), t='{"choices":[{"message":{"content":"hi"}}]}') == "hi"
    assert one(spark, T.model_content(F.col("t")), t='{"choices":[]}') is None


def test_hash_of_nested_and_flat_records_agree(spark):
    row = '{"b": 1, "a": "x"}'
    nested = one(spark, T.py_json_hash(16)(F.col("t")), t=row)
    assert nested == one(spark, T.flat_hash(16, b=F.lit(1), a=F.lit("x")))
    for text in ("\x1b[31mred\x1b[0m", "\x0b\x0c\x0e\x7f\x00", "\\u001B kept \\\x1b", "\\\\\x1f", "é\u2028😀\"/"):
        assert one(spark, T.py_json_hash(16)(F.col("t")), t=json.dumps({"a": text})) == one(spark, T.flat_hash(16, a=F.col("t")), t=text)


def test_relevance(spark):
    tier = lambda s, t: one(spark, K.relevance(F.col("s"), F.col("t"))["tier"], s=s, t=t)
    assert tier("LoongArch: ICE with LSX", "") == "architecture_specific"
    assert tier("x", "aarch64, loongarch64, x86_64") == "multi_arch_shared"
    assert tier("x", "loongarch64-*-*") == "architecture_specific"
    assert tier(None, None) == "not_loongarch"


def test_comment_evidence():
    assert K.evidence_of("This ICE is reproducible on loongarch64-linux-gnu.") == "failure"
    assert K.evidence_of("Bootstrapped and regtested on loongarch64.") == "validation"
    assert K.evidence_of("It fails on other targets. " + "z " * 300 + " Bootstrapped and regtested on loongarch64.") == "validation"
    assert K.evidence_of("nothing") is None and K.evidence_of(None) is None


def test_scope_and_quality(spark):
    assert one(spark, K.architecture_scope(F.col("t")), t="-mlasx on LA664") == "loongarch64"
    assert one(spark, K.architecture_scope(F.col("t")), t="ilp32d") == "loongarch32"
    words = F.array().cast("array<string>")
    score = K.general_quality(F.col("t"), F.lit("d"), F.lit(True), F.lit("target"), words, F.lit("FIXED"))["score"]
    assert one(spark, score, t="reduced ICE with gcc -O2") >= 6
    score = K.general_quality(F.col("t"), F.lit("d"), F.lit(False), F.lit("target"), words, F.lit("INVALID"))["score"]
    assert one(spark, score, t="something") < 6


def test_option_conflicts(spark):
    def fits(a, b):
        df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
        return df.select(X.options_compatible(X.option_constraints(F.col("a")), X.option_constraints(F.col("b"))).alias("r")).first()["r"]

    assert not fits(["-msoft-float"], ["-mlasx"])
    assert not fits(["-mno-lsx"], ["-mlsx"])
    assert not fits(["-mbig-endian"], ["-mlsx"])
    assert not fits(["-mabi=lp64d"], ["-mabi=ilp32"])
    assert fits(["-O0"], ["-O3"]) and fits([], [])


def test_affinity_of_conflicting_features(spark):
    from quernflow.operators.pairs import pair_affinity

    base = ("code_shape", "vector loop", "int x;", "strong", "c", "vectorizer", "ice", ["-mlsx"], ["k"], ["loop"], 0.9, "")
    rows = [("a", 1, *base), ("b", 2, *base[:7], ["-msoft-float"], *base[8:]), ("c", 3, *base)]
    v = spark.createDataFrame(rows, FEATURE).select(F.struct("*").alias("f")).select(*X.vector(F.col("f")))
    pairs = spark.createDataFrame([("a", "b"), ("a", "c")], "left string, right string")
    got = {(r["left"], r["right"]): r["score"] for r in pair_affinity(v, pairs).collect()}
    assert got["a", "b"] == -1000.0 and got["a", "c"] > 3.2
    assert {(r["left"], r["right"]) for r in pair_affinity(v).collect()} == {("a", "c")}


def test_string_lists_are_trimmed(spark):
    assert one(spark, T.string_list(F.col("t")), t=[" f1 ", "", " ", "0a0", "1b"]) == ["f1", "0a0", "1b"]
