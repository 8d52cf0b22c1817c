"""Classifiers of defect reports: relevance, quality, scope, readiness, evaluation status."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quernflow.functions.text import MIME_LANGUAGE, REPRO_WORD, SUFFIX_LANGUAGE, blank, suffix

# The patterns by which reports are judged.
ARCH = r"(?i)(?<![A-Za-z0-9_])loongarch(?:64|32)?(?![A-Za-z0-9_])"
OTHER_ARCH = (
    r"(?i)(?<![A-Za-z0-9_])(?:x86_64|i[3-6]86|aarch64|arm(?:64)?|mips|powerpc|ppc(?:64)?|riscv|s390x?|sparc|alpha|ia64|hppa|m68k|"
    r"nvptx|amdgcn|bpf|sh[0-9]?)(?![A-Za-z0-9_])"
)
FAILURE = (
    r"(?i)\b(?:ice|internal compiler error|wrong code|miscompil(?:e|ation)|fails?|failure|hang|crash|segfault|unrecognizable|"
    r"missed optimization|reproducer|timeout|abort)\b"
)
VALIDATION = r"(?i)\b(?:bootstrapped|regtested|tested|test results?|passes? on|verified)\b"
ARCH_VALIDATION = (
    r"(?i)(?:bootstrapped(?:\s+and)?|regression\s+tested|regtested|tested|verified)[^.\n]{0,240}(?:loongarch(?:64)?|(?:-m)?(?:lsx|lasx))|"
    r"(?:loongarch(?:64)?|(?:-m)?(?:lsx|lasx))[^.\n]{0,160}(?:bootstrapped|regression\s+tested|regtested|tested|verified)"
)
VECTOR_EXTENSION = r"(?i)(?<![A-Za-z0-9_])(?:-m)?(?:lsx|lasx)(?![A-Za-z0-9_])|__(?:lsx|lasx)_"
LSX = r"(?i)(?<![A-Za-z0-9_])(?:-m)?lsx(?![A-Za-z0-9_])|__lsx_"
LASX = r"(?i)(?<![A-Za-z0-9_])(?:-m)?lasx(?![A-Za-z0-9_])|__lasx_"
EVIDENCE_64 = (
    r"(?im)loongarch64|longarch64|elf64-loongarch|(?:^|[^A-Za-z0-9_])la64(?:[^A-Za-z0-9_]|$)|(?:^|[^A-Za-z0-9_])la(?:464|664)(?:[^A-Za-z0-9_]|$)|"
    r"(?:^|[^A-Za-z0-9_])lp64[dfs]?(?:[^A-Za-z0-9_]|$)|-m(?:lsx|lasx)|(?:^|[^A-Za-z0-9_])(?:lsx|lasx)(?:[^A-Za-z0-9_]|$)"
)
EVIDENCE_32 = r"(?im)loongarch32|(?:^|[^A-Za-z0-9_])la32(?:[^A-Za-z0-9_]|$)|(?:^|[^A-Za-z0-9_])ilp32[dfs]?(?:[^A-Za-z0-9_]|$)"
NON_BUG = ("INVALID", "MOVED")
RADIUS = 320
LEAST_SCORE = 6
COMPONENTS = ("middle-end", "target", "tree-optimization", "rtl-optimization", "c", "c++", "fortran", "libstdc++", "lto", "sanitizer")
FAILURE_SIGNALS = {
    "ice": r"(?i)\b(?:ice|internal compiler error|unrecognizable insn)\b",
    "wrong_code": r"(?i)\b(?:wrong[ -]?code|miscompil(?:e|ation)|incorrect code|runtime failure)\b",
    "crash_or_hang": r"(?i)\b(?:crash|segfault|hang|timeout|infinite loop)\b",
    "missed_optimization": r"(?i)\b(?:missed optimization|missed-optimization|pessimiz|performance regression)\b",
}
REPRO_SIGNALS = {
    "reduced_testcase": r"(?i)\b(?:reduced|reducer|creduce|cvise|minimized|minimal)\b",
    "preprocessed_source": r"(?i)\b(?:preprocessed source|\.ii\b|\.i\b)\b",
    "command_line": r"(?i)\b(?:gcc|g\+\+|cc1|cc1plus|compile with|command line)\b[^\n]{0,160}\s-[A-Za-z0-9]",
    "regression": r"(?i)\b(?:regression|known to work|known to fail|started with|bisected)\b",
}
EXPANDED_TIERS = ("architecture_specific", "multi_arch_shared", "loongarch_testsuite_linked", "loongarch_observed")


def relevance(summary: Column, target: Column) -> Column:
    """Struct (tier, reason) from a summary and a target field."""
    summary, target = F.coalesce(summary, F.lit("")), F.coalesce(target, F.lit(""))
    verdict = lambda tier, reason: F.struct(F.lit(tier).alias("tier"), F.lit(reason).alias("reason"))
    return (
        F.when(summary.rlike(ARCH), verdict("architecture_specific", "summary_mentions_loongarch"))
        .when(target.rlike(ARCH) & ~target.rlike(OTHER_ARCH), verdict("architecture_specific", "gcc_target_is_loongarch"))
        .when(target.rlike(ARCH), verdict("multi_arch_shared", "gcc_target_includes_loongarch_and_other_architectures"))
        .otherwise(verdict("not_loongarch", "no_summary_or_target_evidence"))
    )


def other_architectures(target: Column) -> Column:
    found = F.regexp_extract_all(F.coalesce(target, F.lit("")), F.lit(OTHER_ARCH), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, F.lower)))


def failure_near_architecture(text: Column) -> Column:
    """Whether failure words stand within 320 characters of a mention of the architecture, by one bounded pattern.

    Mentions in statements that only validate are blanked first. The exact form, which needs the places of matches, is
    ``comment_evidence``.
    """
    arch = r"(?:(?<![A-Za-z0-9_])loongarch(?:64|32)?(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?:-m)?(?:lsx|lasx)(?![A-Za-z0-9_]))"
    rest = F.regexp_replace(F.coalesce(text, F.lit("")), ARCH_VALIDATION, " ")
    failure = FAILURE.removeprefix("(?i)")
    return rest.rlike(f"(?is){failure}.{{0,{RADIUS}}}{arch}|{arch}.{{0,{RADIUS}}}{failure}")


def _compiled(pattern: str) -> re.Pattern:
    flags, rest = re.match(r"\(\?([a-z]+)\)(.*)", pattern, re.S).groups()
    return re.compile(rest, (re.I if "i" in flags else 0) | (re.M if "m" in flags else 0) | (re.S if "s" in flags else 0))


def evidence_of(text: str | None) -> str | None:
    """``failure``, ``validation``, ``mention`` or None for a comment, from windows around each mention."""
    text = text or ""
    arch, vector, check, fail, valid = map(_compiled, (ARCH, VECTOR_EXTENSION, ARCH_VALIDATION, FAILURE, VALIDATION))
    mentions = [*arch.finditer(text), *vector.finditer(text)]
    if not mentions:
        return None
    spans = [m.span() for m in check.finditer(text)]
    free = (m for m in mentions if not any(a <= m.start() < b for a, b in spans))
    if any(fail.search(text[max(0, m.start() - RADIUS) : m.end() + RADIUS]) for m in free):
        return "failure"
    return "validation" if valid.search(text) else "mention"


def comment_evidence(text: Column) -> Column:
    """``evidence_of`` in Arrow batches: match places are beyond SQL functions. Texts without a mention never reach Python."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(evidence_of)

    mentions = [p.replace("(?i)", "(?iu)", 1) for p in (ARCH, VECTOR_EXTENSION)]  # Python's matching knows other letters' cases, too
    return of(F.when(text.rlike(mentions[0]) | text.rlike(mentions[1]), text))


def full_tier(base: Column, has_local_tests: Column, evidence: Column) -> Column:
    """The tier of a report from its fields' tier, linked tests and the evidence of its comments (array of strings)."""
    return (
        F.when(base != "not_loongarch", base)
        .when(has_local_tests, "loongarch_testsuite_linked")
        .when(F.array_contains(evidence, "failure"), "loongarch_observed")
        .when(F.exists(evidence, lambda e: e.isNotNull()), "loongarch_validation_only")
        .otherwise(base)
    )


def general_quality(text: Column, description: Column, has_testcase: Column, component: Column, keywords: Column, resolution: Column) -> Column:
    """Struct (score, signals, quality_tier): points for what makes a report usable, taken away from non-bugs."""
    component = F.lower(F.trim(F.coalesce(component, F.lit(""))))
    resolution = F.upper(F.coalesce(resolution, F.lit("")))
    rules = [(~blank(description), 1, F.lit("has_description")), (has_testcase, 3, F.lit("has_extractable_testcase")), (component.isin(*COMPONENTS), 1, F.concat(F.lit("component_"), component))]
    rules.append((F.array_contains(F.transform(F.coalesce(keywords, F.array().cast("array<string>")), F.lower), "regression"), 1, F.lit("keyword_regression")))
    rules += [(text.rlike(p), 2, F.lit(n)) for n, p in FAILURE_SIGNALS.items()] + [(text.rlike(p), 1, F.lit(n)) for n, p in REPRO_SIGNALS.items()]
    rules += [(resolution.isin(*NON_BUG), -6, F.concat(F.lit("excluded_resolution_"), F.lower(resolution)))]
    rules += [(resolution.isin("FIXED", "DUPLICATE", "WORKSFORME"), 1, F.concat(F.lit("resolution_"), F.lower(resolution)))]
    score = sum((F.when(c, F.lit(n)).otherwise(F.lit(0)) for c, n, _ in rules), F.lit(0))
    signals = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, s) for c, _, s in rules]))))
    tier = F.when(score >= 8, "high").when(score >= 6, "medium").otherwise("low")
    return F.struct(F.greatest(score, F.lit(0)).alias("score"), signals.alias("signals"), tier.alias("quality_tier"))


def architecture_scope(text: Column) -> Column:
    wide, narrow = text.rlike(EVIDENCE_64), text.rlike(EVIDENCE_32)
    return F.when(wide & narrow, "mixed_loongarch32_loongarch64").when(wide, "loongarch64").when(narrow, "loongarch32").otherwise("loongarch_family_unspecified")


def scope_evidence(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.lower(F.trim(x)))))


def readiness(tier: Column, scope: Column, description: Column, has_testcase: Column, resolution: Column, score: Column, least: int = LEAST_SCORE) -> Column:
    """Struct of the three lists of reasons that keep a report out of the strict, expanded and general sets."""
    resolution = F.upper(F.coalesce(resolution, F.lit("")))
    common = [F.when(blank(description), "missing_bug_description"), F.when(~has_testcase, "missing_testcase"), F.when(resolution.isin(*NON_BUG), F.concat(F.lit("resolution_"), F.lower(resolution)))]
    scoped = F.when(scope != "loongarch64", "no_explicit_loongarch64_evidence")
    lists = {
        "strict": [F.when(tier != "architecture_specific", "not_architecture_specific"), scoped, *common],
        "expanded": [F.when(~tier.isin(*EXPANDED_TIERS), "no_loongarch_failure_or_testsuite_evidence"), scoped, *common],
        "general": [F.when(score < least, f"quality_score_below_{least}"), *common],
    }
    return F.struct(*[F.array_compact(F.array(*rules)).alias(name) for name, rules in lists.items()])


def is_source_attachment(is_patch: Column, name: Column, mime: Column, summary: Column) -> Column:
    kind = F.lower(F.split(F.coalesce(mime, F.lit("")), ";")[0])
    known = suffix(F.lower(name)).isin(*SUFFIX_LANGUAGE) | kind.isin(*MIME_LANGUAGE)
    told = kind.startswith("text/") & F.coalesce(summary, F.lit("")).rlike(REPRO_WORD)
    return ~F.coalesce(is_patch.cast("boolean"), F.lit(False)) & (known | told)


def evaluation_status(ready: Column, language: Column, timed_out: Column, returncode: Column, edges: Column, least_edges: int = 1) -> Column:
    """Status of a run: not ready, unsupported, timeout, ice, compile_failed, covered or coverage_failed, first that holds."""
    return (
        F.when(~ready, "skipped_not_ready")
        .when(~language.isin("c", "c++"), "skipped_unsupported_language")
        .when(timed_out, "timeout")
        .when(returncode == 4, "ice")
        .when(returncode.isNotNull() & (returncode != 0) & (edges == 0), "compile_failed")
        .when((returncode == 0) & (edges >= least_edges), "covered")
        .otherwise("coverage_failed")
    )
