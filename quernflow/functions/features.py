"""Feature records as columns: tokens, architectures, quality, modes, options, and what makes two of them compatible.

The functions take ``f``, a struct with feature_uid, bug_id, feature_type, description, code_witness, evidence_strength,
language, compiler_area, failure_mode, target_options, mutation_knobs, composition_tags, confidence, root_cause_summary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernflow.functions.text import blank, canonical_language, jaccard, string_list, token_set

# Tokens that say nothing about affinity, stop words, terms of profiles and architectures, cues.
GENERIC = "-o0 -o1 -o2 -o3 -os -march -mtune compiler gcc ice loongarch loongarch64 la64 lsx lasx optimization optimizer other target wrong-code".split()
STOPWORDS = (
    "about after also and are before being between both can code compile compiled compiler could does during each e.g. for from gcc has have "
    "into its may must not only other same should such than that the their then this through under used using when where which while with"
).split()
ARCH_TERMS = {
    "loongarch": "loongarch loongarch64 loong64 la64 lsx lasx".split(),
    "x86": "x86 x86-64 i386 i686 x86_64 avx avx512 avx512f sse zmm".split(),
    "arm": "arm arm64 aarch64 neon sve".split(),
    "alpha": "alpha ev4 ev5 ev6".split(),
    "m68k": "m68k m68000 68000".split(),
    "mips": "mips mips64".split(),
    "riscv": "riscv risc-v riscv64 riscv32 rv64 rv32".split(),
    "powerpc": "powerpc ppc ppc64 altivec vsx".split(),
}
PROFILE_TERMS = {"loongarch": ARCH_TERMS["loongarch"]}
REQUIRED_CUES = {
    "loongarch": ("-march=loongarch", "-mabi=lp64", "-mlsx", "-mlasx", "loongarch-specific", "loongarch target", "loongarch backend", "loongarch psabi"),
    "x86": ("-m32", "-m64", "-mavx", "-mavx512", "-mfpmath=387", "x87", "gotpcrel", "mxcsr", "__builtin_ia32", 'asm("xmm', 'asm("ymm', 'asm("zmm', "xmm0", "xmm1", "xmm2", "x86-specific", "x86 target", "x86-64 target"),
    "arm": ("-march=arm", "-march=armv", "-march=aarch64", "aarch64 target", "aarch64-specific"),
    "m68k": ("-mcpu=68000", "-m68000", "m68k target", "m68k-specific"),
    "alpha": ("-mcpu=ev4", "-mcpu=ev5", "-mcpu=ev6", "alpha target", "alpha-specific"),
    "powerpc": ("-mcpu=power", "-mpowerpc", "powerpc target", "powerpc-specific"),
    "riscv": ("-march=rv", "riscv target", "risc-v target", "riscv-specific", "risc-v-specific", "on riscv", "on risc-v", "riscv64"),
    "mips": ("-mips", "mips32", "mips64", "mips target", "mips-specific", "on mips"),
}
MODE_CUES = {
    "build_or_link": ("linker", "link failure", "build-failure", "bootstrap", "configure"),
    "diagnostic": ("diagnostic", "rejects-valid", "reject-valid", "must reject", "error message"),
    "assembly_or_compile": ("assembly scan", "scan assembly", "expected assembly", "instruction selection", "missed-optimization"),
    "execute_or_compile": ("wrong-code", "runtime", "execute", "differential"),
}
FEEDBACK_LANGUAGES = ("c", "c++", "asm", "c-header", "other", "unknown")
FEEDBACK_EXCLUDES = (
    "__builtin_ia32", "mxcsr", 'asm("xmm', 'asm("ymm', 'asm("zmm', "xmm0", "xmm1", "xmm2", "x86 hard register", "-mips", "mips32", "mips64",
    "-mbig-endian", "big-endian", "big endian", "-fplugin", "gcc plugin", "dlopen", "-shared", "-pthread",
)
CORE_TYPES = ("semantic_invariant", "code_shape", "pass_interaction", "target_condition")
SUPPORT_TYPES = ("failure_oracle", "mutation_knob")
GATE = 3.2


def _text(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def _joined(c: Column) -> Column:
    return F.array_join(string_list(c), " ")


def _any(text: Column, cues) -> Column:
    out = F.lit(False)
    for cue in cues:
        out = out | F.contains(text, F.lit(cue))
    return out


def _words(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def composition_tokens(f: Column) -> Column:
    """Tags, telling words of the description and knobs, without generic tokens, sorted."""
    tags = token_set(F.array_join(F.coalesce(f["composition_tags"], F.array().cast("array<string>")), " "))
    words = F.array_except(token_set(f["description"]), _words(STOPWORDS))
    knobs = token_set(F.array_join(F.coalesce(f["mutation_knobs"], F.array().cast("array<string>")), " "))
    return F.array_sort(F.array_except(F.array_union(F.array_union(tags, words), knobs), _words(GENERIC)))


def _searchable(f: Column) -> Column:
    return _text(f["description"], f["code_witness"], _joined(f["composition_tags"]), _joined(f["target_options"]), f["root_cause_summary"])


def architectures(f: Column) -> Column:
    """Architectures that the record names as tokens, in a fixed order."""
    words = token_set(_searchable(f))
    return F.array_compact(F.array(*[F.when(F.arrays_overlap(words, _words(terms)), F.lit(name)) for name, terms in ARCH_TERMS.items()]))


def required_architectures(f: Column) -> Column:
    """Architectures that the record needs, by cues anywhere in its text."""
    text = _text(_joined(f["target_options"]), f["code_witness"], f["description"], f["root_cause_summary"])
    return F.array_compact(F.array(*[F.when(_any(text, cues), F.lit(name)) for name, cues in REQUIRED_CUES.items()]))


def matches_profile(f: Column, profile: str) -> Column:
    name = profile.strip().lower()
    if name in ("", "any"):
        return F.lit(True)
    return F.arrays_overlap(token_set(_searchable(f)), _words(PROFILE_TERMS.get(name, [name])))


def quality(f: Column) -> Column:
    value = F.coalesce(F.least(F.greatest(F.expr("1.0D") * f["confidence"].cast("double"), F.lit(0.0)), F.lit(1.0)), F.lit(0.5))
    strength = F.lower(F.coalesce(f["evidence_strength"], F.lit("")))
    weight = F.when(strength == "strong", 1.0).when(strength == "medium", 0.7).when(strength == "weak", 0.35).otherwise(0.5)
    return 0.55 * value + 0.3 * weight + 0.15 * F.when(blank(f["code_witness"]), 0.0).otherwise(1.0)


def test_mode(f: Column) -> Column:
    text = _text(f["description"], f["code_witness"], f["feature_type"], f["failure_mode"], _joined(f["composition_tags"]), f["root_cause_summary"])
    out = None
    for name, cues in MODE_CUES.items():
        out = F.when(_any(text, cues), name) if out is None else out.when(_any(text, cues), name)
    return out.otherwise("compile")


def option_constraints(options: Column) -> Column:
    """What a record's options demand or forbid. Optimisation levels stay empty: the text is lower-cased before a pattern in
    upper case is looked for, a quirk that results depend on."""
    text = F.lower(_joined(options))
    abis = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?:-mabi=|\b)(lp64[dfs]|ilp32[dfs]?)\b"), F.lit(1))))
    vector, wide = ("-mlsx", "-mlasx", "-msimd=lsx", "-msimd=lasx"), ("-mlasx", "-msimd=lasx")
    return F.struct(
        abis.alias("abis"),
        F.array().cast("array<string>").alias("optimization_levels"),
        _any(text, ("-msoft-float", "-mfpu=none", "-mabi=lp64s")).alias("soft_float"),
        _any(text, ("-mhard-float", "-mfpu=64", "-mabi=lp64d", *vector)).alias("hard_float"),
        _any(text, vector).alias("requires_lsx"),
        _any(text, wide).alias("requires_lasx"),
        _any(text, ("-mno-lsx",)).alias("forbids_lsx"),
        _any(text, ("-mno-lasx",)).alias("forbids_lasx"),
        _any(text, ("-mbig-endian", "-mbig", "big-endian", "big endian")).alias("big_endian"),
        _any(text, ("-mlittle-endian", "-mlittle", "little-endian", "little endian")).alias("little_endian"),
    )


def feedback_compatible(f: Column, profile: str) -> Column:
    """Whether a feature belongs in the current feedback loop."""
    text = _text(f["description"], f["code_witness"], f["root_cause_summary"])
    good = canonical_language(f["language"]).isin(*FEEDBACK_LANGUAGES) & ~_any(text, ("gccgo", "libgo", "go frontend", ".go source"))
    good = good & ~(_any(text, ("unsupported-target",)) | (_any(text, ("fixed-point",)) & _any(text, ("unsupported target",)))) & ~_any(text, FEEDBACK_EXCLUDES)
    name = profile.strip().lower()
    if name not in ARCH_TERMS:
        return good
    need, have = required_architectures(f), architectures(f)
    fits = F.when(F.size(need) > 0, need == _words([name])).otherwise((F.size(have) == 0) | F.array_contains(have, name))
    return good & fits


def vector(f: Column, profile: str = "loongarch") -> list[Column]:
    """The columns of a feature that pairs are judged by."""
    return [
        f["feature_uid"].alias("feature_uid"), f["bug_id"].alias("bug_id"), f["feature_type"].alias("feature_type"),
        f["compiler_area"].alias("compiler_area"), f["failure_mode"].alias("failure_mode"),
        canonical_language(f["language"]).alias("language"), composition_tokens(f).alias("tokens"), architectures(f).alias("archs"),
        required_architectures(f).alias("required"), test_mode(f).alias("mode"), option_constraints(f["target_options"]).alias("options"),
        quality(f).alias("quality"), matches_profile(f, profile).alias("profile_match"),
    ]


def languages_compatible(a: Column, b: Column) -> Column:
    return (a == b) | (a == "unknown") | (b == "unknown")


def architectures_compatible(ra: Column, aa: Column, rb: Column, ab: Column) -> Column:
    """Needs meet needs; where only one side has needs they meet what the other needs or names; else names meet names."""
    has = lambda c: F.size(c) > 0
    left, right = F.when(has(ra), ra).otherwise(aa), F.when(has(rb), rb).otherwise(ab)
    return ~has(left) | ~has(right) | F.arrays_overlap(left, right)


def modes_compatible(a: Column, b: Column) -> Column:
    loose = ("compile", "assembly_or_compile", "execute_or_compile")
    return (a == b) | (a.isin(*loose) & b.isin(*loose))


def options_compatible(a: Column, b: Column) -> Column:
    bad = (F.size(a["abis"]) > 0) & (F.size(b["abis"]) > 0) & ~F.arrays_overlap(a["abis"], b["abis"])
    for x, y in ((a, b), (b, a)):
        bad = bad | (x["soft_float"] & y["hard_float"]) | (x["forbids_lsx"] & y["requires_lsx"]) | (x["forbids_lasx"] & y["requires_lasx"])
        bad = bad | (x["big_endian"] & (y["little_endian"] | y["requires_lsx"] | y["requires_lasx"]))
    both = (F.size(a["optimization_levels"]) == 1) & (F.size(b["optimization_levels"]) == 1)
    return ~(bad | (both & (a["optimization_levels"] != b["optimization_levels"])))


def affinity(a, b) -> dict[str, Column]:
    """Score and flags of a pair of vectors; ``a`` and ``b`` map a name to a column. Incompatible pairs score -1000."""
    shared = F.array_sort(F.array_intersect(a("tokens"), b("tokens")))
    same = lambda name: (F.coalesce(a(name), F.lit("")) != "") & F.coalesce(a(name) == b(name), F.lit(False))
    different = ~a("feature_type").eqNullSafe(b("feature_type"))
    bonus = lambda c, n: F.when(c, F.lit(n)).otherwise(F.lit(0.0))
    score = (
        5.0 * jaccard(a("tokens"), b("tokens")) + F.least(F.lit(2.0), 0.45 * F.size(shared)) + bonus(same("compiler_area"), 1.4) + bonus(same("failure_mode"), 0.7)
        + bonus(different, 0.8) + bonus(F.arrays_overlap(a("archs"), b("archs")), 1.0) + 0.6 * (a("quality") + b("quality"))
    )
    fits = {
        "language_compatible": languages_compatible(a("language"), b("language")),
        "architecture_compatible": architectures_compatible(a("required"), a("archs"), b("required"), b("archs")),
        "options_compatible": options_compatible(a("options"), b("options")),
        "test_mode_compatible": modes_compatible(a("mode"), b("mode")),
    }
    every = F.lit(True)
    for c in fits.values():
        every = every & c
    return {"score": F.round(F.when(every, score).otherwise(F.lit(-1000.0)), 4), **fits, "shared_tags": shared, "same_compiler_area": same("compiler_area"), "same_failure_mode": same("failure_mode"), "complementary_feature_types": different}
