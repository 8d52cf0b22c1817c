"""Text functions on columns: clipping, naming, languages, tokens, model responses, compiler options."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CLIP_MARKER = "\n\n[... content truncated to fit the model context ...]\n\n"

# Languages by file suffix, by MIME type and by hint; suffixes by language; aliases.
SUFFIX_LANGUAGE = {
    ".c": "c", ".i": "c-preprocessed", ".h": "c-header", ".cc": "c++", ".cp": "c++", ".cpp": "c++", ".cxx": "c++", ".c++": "c++",
    ".ii": "c++-preprocessed", ".f": "fortran", ".f90": "fortran", ".f95": "fortran", ".f03": "fortran", ".f08": "fortran",
    ".s": "assembly", ".asm": "assembly", ".rs": "rust", ".m": "objective-c", ".mm": "objective-c++",
}
MIME_LANGUAGE = {"text/x-csrc": "c", "text/x-c++src": "c++", "text/x-c++": "c++", "text/x-fortran": "fortran", "text/x-asm": "assembly"}
HINT_LANGUAGE = {"c": "c", "cpp": "c++", "c++": "c++", "cc": "c++", "fortran": "fortran", "asm": "assembly", "assembly": "assembly", "rust": "rust"}
LANGUAGE_SUFFIX = {
    "c": ".c", "c-preprocessed": ".i", "c++": ".cc", "c++-preprocessed": ".ii", "fortran": ".f90", "assembly": ".s", "rust": ".rs",
    "objective-c": ".m", "objective-c++": ".mm",
}
LANGUAGE_ALIAS = {"cpp": "c++", "cxx": "c++", "g++": "c++", "f90": "fortran", "f95": "fortran", "assembly": "asm"}
TOKEN = "[A-Za-z0-9_+.-]+"
SECRET = r"\bsk-[A-Za-z0-9_-]{8,}\b"
FIX_EVIDENCE = (
    r"(?i)(branch has been updated|https://gcc\.gnu\.org/g:|\bcommit\b|ChangeLog|\bfixed\b|\bfix(?:ed|es)?\b|\bpatch\b|root cause|caused by|"
    r"cherry picked|backport|regression fix)"
)
COMMIT_HASH = r"(?i)(?:gcc\.gnu\.org/g:)?\b([0-9a-f]{12,40})\b"
REPRO_WORD = (
    r"(?i)\b(?:test[ -]?case|reproducer|reduced|preprocessed source|compile with|command line|causes? (?:an )?ice|internal compiler error)\b"
)


def lookup(key: Column, table: Mapping[str, str], default: Column | str | None = None) -> Column:
    """A value of a small literal map."""
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    if default is None:
        return known[key]
    return F.coalesce(known[key], default if isinstance(default, Column) else F.lit(default))


def blank(c: Column) -> Column:
    """True for null, empty or white space."""
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def clip(text: Column, most: int, marker: str = CLIP_MARKER) -> Column:
    """Head, marker and tail of a text over ``most`` characters; ``most`` of 0 or less clips nothing."""
    text = F.coalesce(text, F.lit(""))
    if most <= 0:
        return text
    keep = max(0, most - len(marker))
    head, tail = keep // 2, keep - keep // 2
    end = F.right(text, F.lit(tail)) if tail else text  # a tail of no characters is, as in a slice from -0, the whole
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.left(text, F.lit(head)), F.lit(marker), end))


def is_clipped(text: Column, most: int) -> Column:
    return F.lit(most > 0) & (F.length(F.coalesce(text, F.lit(""))) > most)


def head(text: Column, most: int, note: str) -> Column:
    """The first ``most`` characters and a note, or the whole text."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit(note))).otherwise(text)


def safe_filename(name: Column, fallback: str = "artifact") -> Column:
    clean = F.regexp_replace(F.translate(F.coalesce(name, F.lit("")), "\\/\x00", "___"), "[^A-Za-z0-9._+-]+", "_")
    clean = F.left(F.btrim(clean, F.lit("._")), F.lit(160))
    return F.when(clean == "", F.lit(fallback)).otherwise(clean)


def safe_stem(name: Column, fallback: Column) -> Column:
    """File stem with unusual characters replaced, for program files."""
    base = F.regexp_extract(F.trim(F.coalesce(name, F.lit(""))), r"([^/]*)$", 1)
    stem = F.when(base.rlike(r"^.+\.[^.]*$"), F.regexp_replace(base, r"\.[^.]*$", "")).otherwise(base)
    clean = F.regexp_replace(F.when(stem == "", fallback).otherwise(stem), "[^A-Za-z0-9_.-]+", "_")
    return F.when(clean == "", fallback).otherwise(clean)


def suffix(name: Column) -> Column:
    """File suffix with its dot, or an empty string; names that only begin with a dot have none."""
    return F.regexp_extract(F.coalesce(name, F.lit("")), r"[^/.][^/]*(\.[^./]+)$", 1)


def language_for(name: Column, mime: Column, hint: Column) -> Column:
    """Language of a file from its suffix, else its MIME type, else a hint, else ``unknown``."""
    kind = F.lower(F.trim(F.split(F.coalesce(mime, F.lit("")), ";")[0]))
    return F.when(suffix(name) == ".C", F.lit("c++")).otherwise(
        F.coalesce(lookup(suffix(F.lower(name)), SUFFIX_LANGUAGE), lookup(kind, MIME_LANGUAGE), lookup(F.lower(F.trim(F.coalesce(hint, F.lit("")))), HINT_LANGUAGE), F.lit("unknown"))
    )


def extension_for_language(language: Column) -> Column:
    return lookup(language, LANGUAGE_SUFFIX, ".txt")


def language_for_content(text: Column) -> Column:
    """Language of a program by its content; the first rule that holds counts."""
    low = F.lower(text)
    return (
        F.when(text.rlike(r"\b(?:g\+\+|cc1plus)\b") | text.rlike(r"\b(?:std::|template\s*<|namespace\s+[A-Za-z_]|class\s+[A-Za-z_])"), "c++")
        .when(low.rlike(r"\b(?:program|subroutine|integer\s*::|real\s*::)\b"), "fortran")
        .when(text.rlike(r"\b(?:gcc|cc1)\b") | text.rlike(r"(?:#\s*include|\b(?:int|void|struct|enum)\s+[A-Za-z_]|__attribute__)"), "c")
        .when(low.rlike(r"\b(?:\.text|\.globl|addi\.d|ld\.d|st\.d)\b"), "assembly")
        .otherwise("unknown")
    )


def canonical_language(c: Column) -> Column:
    name = F.lower(F.trim(F.when(F.coalesce(c, F.lit("")) == "", F.lit("unknown")).otherwise(c)))
    return lookup(name, LANGUAGE_ALIAS, name)


def language_for_wrapper(c: Column) -> Column:
    return F.when(canonical_language(c) == "c++", "c++").otherwise("c")


def string_list(c: Column) -> Column:
    """Trimmed strings without the blank ones; null gives an empty array."""
    return F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")


def token_set(text: Column) -> Column:
    """Distinct lower-case tokens of two characters or more, in order of appearance."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.array_distinct(F.transform(F.filter(found, lambda x: F.length(x) > 1), F.lower))


def jaccard(a: Column, b: Column) -> Column:
    """Common over all elements of two sets, 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def redact_secrets(c: Column) -> Column:
    return F.regexp_replace(c, SECRET, "<redacted-api-key>")


def commit_hashes(text: Column) -> Column:
    """Distinct lower-case commit hashes in order of appearance."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(COMMIT_HASH), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def is_fix_comment(text: Column) -> Column:
    return F.coalesce(text.rlike(FIX_EVIDENCE), F.lit(False))


def attachment_is_fix_evidence(summary: Column, name: Column, is_patch: Column) -> Column:
    both = F.concat_ws(" ", F.coalesce(summary, F.lit("")), F.coalesce(name, F.lit("")))
    return F.coalesce(is_patch.cast("boolean"), F.lit(False)) | both.rlike(r"(?i)\b(patch|fix|backport)\b")


def canonical_glue_id(c: Column) -> Column:
    """``G<number>`` for the usual spellings of a glue id, else null."""
    found = F.regexp_extract(F.trim(F.coalesce(c, F.lit(""))), r"^[Gg]([1-9][0-9]*)(?:[-_][A-Za-z0-9][A-Za-z0-9_-]*)?$", 1)
    return F.when(found != "", F.concat(F.lit("G"), found))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(F.lit(100.0) * part / whole, 2))


def last_lines(text: Column, n: int = 20) -> Column:
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r?\n$", ""), r"\r?\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - (n - 1), F.lit(1)), F.lit(n)), "\n")


def stderr_signature(text: Column) -> Column:
    return F.sha2(last_lines(text).cast("binary"), 256)


def inside(path: Column, root: str) -> Column:
    return (path == root) | path.startswith(root.rstrip("/") + "/")


def normal_path(path: Column) -> Column:
    """A path without empty and ``.`` parts, each ``..`` resolved against the part before it, as deep as it goes; one that leaves
    the root stays at the root, a relative one keeps what it cannot resolve."""
    absolute = path.startswith("/")
    last = lambda parts: F.element_at(F.concat(F.array(F.lit("..")), parts), -1)

    def step(kept: Column, part: Column) -> Column:
        up = F.when(last(kept) != "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(absolute, kept).otherwise(F.array_append(kept, part))
        return F.when(part.isin("", "."), kept).when(part == "..", up).otherwise(F.array_append(kept, part))

    parts = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    return F.concat(F.when(absolute, "/").otherwise(""), F.array_join(parts, "/"))


def indent(text: Column) -> Column:
    body = F.concat(F.lit("    "), F.regexp_replace(F.regexp_replace(text, "\r\n", "\n"), "\n", "\n    "))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("    (empty)")).otherwise(body)


def sanitize_options(options: Column, optimization: str = "-Ofast") -> Column:
    """Compiler options without output, link and (when one is forced) optimisation flags; ``-o`` takes its argument along.

    ``preserve`` or an empty ``optimization`` keeps the given level and puts ``-O2`` first only where there is none.
    """
    force = bool(optimization and optimization != "preserve")
    level = r"^-O(?:[0-3sSzZg]|fast)$"

    def step(state: Column, raw: Column) -> Column:
        value = F.trim(raw)
        drop = value.isin("-o", "-c", "-S", "-E", "-shared", "-static", "-pie") | value.rlike(r"^(-l|-Wl,|-L)")
        if force:
            drop = drop | value.rlike(level)
        kept = F.when((value == "") | state["skip"] | drop, state["kept"]).otherwise(F.concat(state["kept"], F.array(value)))
        skip = F.when(value == "", state["skip"]).otherwise(~state["skip"] & (value == "-o"))
        return F.struct(skip.alias("skip"), kept.alias("kept"))

    start = F.struct(F.lit(False).alias("skip"), F.array().cast("array<string>").alias("kept"))
    kept = F.aggregate(F.coalesce(options, F.array().cast("array<string>")), start, step, lambda s: s["kept"])
    if force:
        return F.concat(F.array(F.lit(optimization)), kept)
    return F.when(F.exists(kept, lambda x: x.rlike(level)), kept).otherwise(F.concat(F.array(F.lit("-O2")), kept))


def replay_options(options: Column) -> Column:
    """The other sanitiser, of the coverage replay: it also drops ``-x`` with its argument, keeps the level it finds."""

    def step(state: Column, raw: Column) -> Column:
        item = F.trim(raw)
        drop = (item == "") | item.isin("-c", "-S", "-E", "-o", "-x", "-pipe", "-save-temps", "-shared", "-static", "-fuse-ld=gold", "-fuse-ld=lld") | item.rlike(r"^(-l|-L|-Wl,|-Xlinker|-fuse-ld=)")
        kept = F.when(state["skip"] | drop, state["kept"]).otherwise(F.concat(state["kept"], F.array(item)))
        return F.struct((~state["skip"] & item.isin("-o", "-x")).alias("skip"), kept.alias("kept"))

    start = F.struct(F.lit(False).alias("skip"), F.array().cast("array<string>").alias("kept"))
    kept = F.aggregate(F.coalesce(options, F.array().cast("array<string>")), start, step, lambda s: s["kept"])
    return F.when(F.exists(kept, lambda x: x.rlike(r"^-O[0-3sSzZgfast]+$")), kept).otherwise(F.concat(F.array(F.lit("-O2")), kept))


def parse_json_content(content: Column, greedy: bool = True) -> Column:
    """The JSON object in a model's answer as a string: the whole, else a fenced block, else the outermost braces; null if
    none of them parses to an object."""
    text = F.trim(F.coalesce(content, F.lit("")))
    body = r"\{.*\}" if greedy else r"\{.*?\}"
    fenced = F.regexp_extract(text, r"(?si)```(?:json)?\s*(" + body + r")\s*```", 1)
    outer = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    second = F.when(fenced != "", fenced).otherwise(outer)
    whole = F.try_parse_json(text)
    good = F.when(whole.isNotNull(), text).otherwise(F.when(F.try_parse_json(second).isNotNull(), second))
    return F.when(F.schema_of_variant(F.try_parse_json(good)).startswith("OBJECT"), good)


def model_content(raw: Column) -> Column:
    """``choices[0].message.content`` of a response, null where it is missing or blank."""
    found = F.get_json_object(raw, "$.choices[0].message.content")
    return F.when(~blank(found), found)


def py_json_hash(length: int):
    """SHA-256 prefix of JSON with sorted keys and no spaces, for nested records given as JSON strings (Arrow batches)."""

    @F.pandas_udf("string")
    def of(values: pd.Series) -> pd.Series:
        def one(v):
            if v is None:
                return None
            text = json.dumps(json.loads(v), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()[:length]

        return values.map(one)

    return of


def flat_hash(length: int, **fields: Column) -> Column:
    """The same hash for flat records of strings and integers, without Python."""
    ordered = [v.alias(k) for k, v in sorted(fields.items())]
    text = F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})
    lower = text
    for code in (0x0B, 0x0E, 0x0F, *range(0x1A, 0x20)):  # the hash is of lower-case escapes; an escaped backslash before is none
        lower = F.regexp_replace(lower, rf"(?<!\\)((?:\\\\)*)\\u{code:04X}", rf"$1\\u{code:04x}")
    return F.left(F.sha2(F.when(text.contains("\\u00"), lower).otherwise(text).cast("binary"), 256), F.lit(length))
