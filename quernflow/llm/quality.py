"""Quality rules: robust multivariate outliers among documents of one language and source.

Each document has a vector of transformed statistics. For every (language, source) the minimum-covariance-determinant
estimate of their centre and scatter is found as FAST-MCD does: many random starts of few rows on a bounded sample of the
group's distinct vectors, concentration steps there, then further steps over all of the group's rows for the best starts;
the lowest determinant wins, and a last step weighs out the rows that it finds far away. Over all rows a step is one
aggregation of counts and moments by bins of distance; the bin that the share ends in counts in part, so the share is exact.

A document is held against the group's scatter plus its own sampling error: the transforms make that known (a square root's
arcsine of k out of n has the variance 1 / 4n), so a short text is not an outlier for what a few words can do, and a group
without any symbol does not make one symbol an outlier.
"""

from __future__ import annotations

from math import exp, lgamma, log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches
from quernflow.scratch import materialize

SYMBOLS = "#*$%&|<>"
DIMS = ("word_length", "symbols", "repeated_lines", "repeated_words", "sentence_ends", "capitals", "short_words")
#: Statistics are kept as whole numbers of 1/GRID, distances in bins of 1/BINS of a power of two.
GRID, BINS = 1024, 16
SHARE, STEPS, LEAST_ROWS = 0.75, 2, 50
#: Distinct vectors of a group in the sample for starts, about; random starts; those that go on to all rows.
SAMPLE, STARTS, BEST = 1500, 200, 2
TAIL = 1e-6

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
STATS = BASE + ", " + ", ".join(f"x{i} long" for i in range(len(DIMS))) + ", noise array<double>"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_IS_END = np.isin(np.arange(256), list(b".!?"))


def statistics(raw: bytes | None) -> tuple:
    """The base statistics of a text in UTF-8, its vector on the grid and the vector's sampling variances; zeros without
    words. Capitals are words that begin with A-Z or a capital of Latin-1."""
    raw = raw or b""
    data = np.frombuffer(raw, np.uint8)
    symbols = int(_IS_SYMBOL[data].sum())
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, symbols, 0, 0, *(0 for _ in DIMS), [0.0] * len(DIMS))
    inside = np.r_[False, ~_IS_SPACE[data], False]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    upto = np.r_[np.int32(0), np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)]
    lengths = upto[end] - upto[start]
    chars = int(lengths.sum())
    first, second = data[start], data[np.minimum(start + 1, len(data) - 1)]
    capitals = int((((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97))).sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    again = len(lines) - len(set(lines))
    repeated = repeat_words(words)
    ends = int(_IS_END[data[end - 1]].sum())
    counts = ((symbols, chars), (again, len(lines)), (repeated, n), (ends, n), (capitals, n), (int((lengths <= 3).sum()), n))
    vector = [log(chars / n), *(float(np.arcsin(np.sqrt(min(1.0, k / m)))) for k, m in counts)]
    spread = float(lengths.var()) / (chars / n) ** 2
    # repeated words come by the line
    noise = [max(spread, 1 / n) / n, *(1 / (4 * m) for m in (chars, len(lines), len(lines), n, n, n))]
    return (n, chars, symbols, again, repeated, *(round(GRID * x) for x in vector), noise)


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that the text holds twice or more, the first included."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    at = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    two = np.unique(at[:-1] * len(ids) + at[1:], return_inverse=True)[1]
    _, where, count = np.unique(two[:-1] * len(ids) + at[2:], return_inverse=True, return_counts=True)
    twice = count[where] >= 2
    inside = np.zeros(len(words), dtype=bool)
    for k in range(3):
        inside[k : len(words) - 2 + k] |= twice
    return int(inside.sum())


def _statistics(text: Column) -> Column:
    @F.pandas_udf(STATS)
    def of(texts: pd.Series) -> pd.DataFrame:
        names = [x.split()[0] for x in STATS.split(", ")]
        return pd.DataFrame([statistics(t) for t in texts], columns=names)

    return of(text.cast("binary"))


# ---------------------------------------------------------------- chi-squared, without a statistics library


def chi2_cdf(x: float, k: int) -> float:
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * exp(-x + a * log(x) - lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


_D = len(DIMS)
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]
CUT = chi2_quantile(1 - TAIL, _D)
#: Rows beyond this quantile do not weigh in the last step.
NEAR = 0.975
#: The statistics' resolution: what keeps a scatter from being singular where most rows agree in a statistic.
GUARD = np.eye(_D) / GRID**2


def consistent(share: float) -> float:
    """The nearest ``share`` of a normal sample has less scatter than the whole; this makes up for it."""
    return share / chi2_cdf(chi2_quantile(share, _D), _D + 2)


# ---------------------------------------------------------------- estimates: rows of a group

_FIT = "grp string, start int, centre array<double>, scatter array<double>, inverse array<double>, logdet double"


def _fit_row(grp: str, start: int, centre: np.ndarray, scatter: np.ndarray) -> tuple:
    """A fit; ``scatter`` is that of the nearest share, without the guard."""
    whole = consistent(SHARE) * scatter + GUARD
    return grp, start, centre.tolist(), whole.ravel().tolist(), np.linalg.inv(whole).ravel().tolist(), float(np.linalg.slogdet(whole)[1])


def _moments(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    centre = w @ x / w.sum()
    away = x - centre
    return centre, (away * w[:, None]).T @ away / w.sum()


def _nearest(x: np.ndarray, n: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    """Weights of the nearest share of rows (x with counts n), the last of them in part."""
    away = x - centre
    order = np.argsort(np.einsum("ij,jk,ik->i", away, np.linalg.inv(scatter + GUARD), away), kind="stable")
    before = np.cumsum(n[order]) - n[order]
    w = np.zeros(len(n))
    w[order] = np.clip(SHARE * n.sum() - before, 0, n[order])
    return w


def start_fits(sample: pd.DataFrame) -> pd.DataFrame:
    """The best fits from random starts on a group's sampled vectors (with their counts), after concentration there."""
    grp = sample["grp"].iloc[0]
    sample = sample.sort_values([f"x{i}" for i in range(_D)])
    x, n = sample[[f"x{i}" for i in range(_D)]].to_numpy() / GRID, sample["n"].to_numpy(dtype=float)
    rng = np.random.default_rng(crc32(grp.encode()))

    def onward(centre, scatter, steps):
        for _ in range(steps):
            centre, scatter = _moments(x, _nearest(x, n, centre, scatter))
        return float(np.linalg.slogdet(scatter + GUARD)[1]), centre, scatter

    found = []
    for _ in range(STARTS):
        some = rng.choice(len(x), min(_D + 1, len(x)), replace=False)
        found.append(onward(*_moments(x[some], n[some]), 2))
    found = sorted((onward(*f[1:], 10) for f in sorted(found, key=lambda f: f[0])[:10]), key=lambda f: f[0])
    distinct = [f for i, f in enumerate(found) if not i or f[0] > found[i - 1][0] + 1e-9][:BEST]
    return pd.DataFrame([_fit_row(grp, i, centre, scatter) for i, (_, centre, scatter) in enumerate(distinct)], columns=[c.split()[0] for c in _FIT.split(", ")])


def next_fit(bins: pd.DataFrame) -> pd.DataFrame:
    """The fit to the nearest share of a group, from its sums by bin of distance; the last bin counts in part."""
    bins = bins.sort_values("bin")
    counts = bins["n"].to_numpy(dtype=float)
    want = SHARE * counts.sum()
    part = np.clip(want - (np.cumsum(counts) - counts), 0, counts) / counts
    centre, scatter = _from_sums(bins, part, want)
    return pd.DataFrame([_fit_row(bins["grp"].iloc[0], int(bins["start"].iloc[0]), centre, scatter)], columns=[c.split()[0] for c in _FIT.split(", ")])


def _from_sums(bins: pd.DataFrame, part: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    mean = np.array([part @ bins[f"s{i}"].to_numpy(dtype=float) for i in range(_D)]) / total / GRID
    scatter = np.zeros((_D, _D))
    for i, j in _PAIRS:
        scatter[i, j] = scatter[j, i] = part @ bins[f"s{i}_{j}"].to_numpy(dtype=float) / total / GRID**2 - mean[i] * mean[j]
    return mean, scatter


def last_fit(sums: pd.DataFrame) -> pd.DataFrame:
    """Centre and scatter of the rows that the lowest determinant's fit finds near."""
    total = float(sums["n"].iloc[0])
    centre, scatter = _from_sums(sums, np.ones(1), total)
    return pd.DataFrame({"grp": [sums["grp"].iloc[0]], "centre": [centre.tolist()], "scatter": [(consistent(NEAR) * scatter + GUARD).ravel().tolist()]})


def _raw_distance() -> Column:
    """Squared Mahalanobis distance of x0.. to ``centre`` under ``inverse``."""
    away = [F.col(f"x{i}") / F.lit(float(GRID)) - F.col("centre")[i] for i in range(_D)]
    total = F.lit(0.0)
    for i, j in _PAIRS:
        total = total + away[i] * away[j] * F.col("inverse")[i * _D + j] * F.lit(1.0 if i == j else 2.0)
    return F.when(total < 0, F.lit(0.0)).otherwise(total)


def distances(x: np.ndarray, noise: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    """Squared Mahalanobis distances of rows x under ``scatter`` plus each row's sampling variances."""
    away = x - centre
    whole = scatter + noise[:, :, None] * np.eye(_D)
    return np.einsum("ij,ij->i", away, np.linalg.solve(whole, away[:, :, None])[:, :, 0])


def distance() -> Column:
    """``distances`` of x0.. with ``noise`` to ``centre`` under ``scatter``; null without an estimate."""

    @F.pandas_udf("double")
    def of(x: pd.Series, noise: pd.Series, centre: pd.Series, scatter: pd.Series) -> pd.Series:
        out = np.full(len(x), np.nan)
        known = np.flatnonzero(centre.notna().to_numpy())
        if len(known):
            stack = lambda c: np.stack(c.iloc[known].to_numpy()).astype(float)
            out[known] = distances(stack(x) / GRID, stack(noise), stack(centre), stack(scatter).reshape(-1, _D, _D))
        return pd.Series(out).where(~np.isnan(out), None)

    return of(F.array(*[F.col(f"x{i}") for i in range(_D)]), F.col("noise"), F.col("centre"), F.col("scatter"))


def _sums(weight: Column) -> list[Column]:
    sums = [F.sum(weight).alias("n"), *[F.sum(F.col(f"x{i}") * weight).alias(f"s{i}") for i in range(_D)]]
    return sums + [F.sum(F.col(f"x{i}") * F.col(f"x{j}") * weight).alias(f"s{i}_{j}") for i, j in _PAIRS]


def fit_groups(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """(grp, centre, scatter) for each ``grp`` of rows (grp, x0.., noise): the reweighted minimum-covariance-determinant
    estimate. Only the starts are taken on a sample, of about ``SAMPLE`` distinct vectors a group, chosen by their hash."""
    names = [f"x{i}" for i in range(_D)]
    vectors = materialize(rows.groupBy("grp", *names).agg(F.count("*").alias("n")), "distinct")
    drawn = F.pmod(F.xxhash64(*names), F.lit(1 << 20)) < F.ceil(F.lit(float(SAMPLE << 20)) / F.col("m"))
    sample = vectors.join(vectors.groupBy("grp").agg(F.count("*").alias("m")), "grp").where(drawn | (F.col("m") <= SAMPLE))
    fit = materialize(sample.select("grp", *names, "n").groupBy("grp").applyInPandas(start_fits, _FIT), "fit")
    for _ in range(steps):
        near = vectors.join(fit.select("grp", "start", "centre", "inverse"), "grp")
        near = near.withColumn("bin", F.floor(F.log2(_raw_distance() + F.lit(2.0**-20)) * BINS).cast("int"))
        fit = materialize(near.groupBy("grp", "start", "bin").agg(*_sums(F.col("n"))).groupBy("grp", "start").applyInPandas(next_fit, _FIT), "fit")
    best = fit.groupBy("grp").agg(F.min(F.struct("logdet", "start", "centre", "scatter")).alias("b")).select("grp", "b.centre", "b.scatter")
    near = rows.join(best, "grp").where(distance() <= chi2_quantile(NEAR, _D))
    last = near.groupBy("grp").agg(*_sums(F.lit(1))).groupBy("grp").applyInPandas(last_fit, "grp string, centre array<double>, scatter array<double>")
    return materialize(last, "fit")


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` (with lang, source, text) with the names of their groups in place of lang and source."""
    batches.bound(rows.sparkSession)
    given = [c for c in rows.columns if c not in ("lang", "source")]
    named = lambda c: F.coalesce(F.concat(F.lit("+"), F.col(c)), F.lit("-"))
    return rows.select(*given, named("lang").alias("by_lang"), F.concat(named("lang"), F.lit("\x1f"), named("source")).alias("by_both"))


def _described(rows: DataFrame) -> DataFrame:
    """``rows`` (with lang, source, text) with the statistics, the base rules' verdict and the group's names."""
    given = [c for c in rows.columns if c not in ("lang", "source", "text")]
    rows = _named(rows).select(*given, "by_lang", "by_both", _statistics(F.col("text")).alias("s"))
    failed = (F.col("s.n_words") < 50) | (100 * F.col("s.n_repeat_words") > 50 * F.col("s.n_words"))
    return rows.select(*given, "by_lang", "by_both", "s.*", failed.alias("base_failed"))


def _judges(rows: DataFrame, least_rows: int) -> DataFrame:
    """(by_both, centre, scatter) from described rows: the estimate that each group is held against."""
    good = rows.where("not base_failed")
    sizes = good.groupBy("by_lang", "by_both").agg(F.count("*").alias("n"))
    few = F.col("n") < least_rows
    rest = sizes.where(few).groupBy("by_lang").agg(F.sum("n").alias("m"))
    name = F.when(~few, F.col("by_both")).when(F.col("m") >= least_rows, F.col("by_lang")).otherwise(F.lit("*"))
    levels = sizes.join(rest, "by_lang", "left").select("by_both", name.alias("grp"), "n")
    enough = levels.groupBy("grp").agg(F.sum("n").alias("m")).where(F.col("m") >= least_rows).select("grp")
    levels = materialize(levels.join(enough, "grp").select("by_both", "grp"), "levels")
    vectors = materialize(good.join(levels, "by_both").select("grp", *[f"x{i}" for i in range(_D)], "noise"), "vectors")
    return levels.join(fit_groups(vectors), "grp").drop("grp")


def _kept(cut: float) -> Column:
    return ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))


def assess(docs: DataFrame, least_rows: int = LEAST_ROWS, cut: float = CUT) -> DataFrame:
    """(doc_id, base statistics, base_failed, distance, kept) for every row of ``docs``.

    Base rules: under 50 words, or over half of the words in repeated three-word windows. The others are judged within
    their (lang, source), where null is a value; groups with fewer than ``least_rows`` of them are judged together within
    their language, and where that is still too few, all such rows together; if those are too few, they are kept and their
    distance is null. A row is rejected when its squared distance is over ``cut`` (a chance of one in a million for normal
    data); see ``distances``. Null and empty texts fail the base rules. Repeated rows each come back; an empty table gives no rows.
    """
    rows = materialize(_described(docs.select("doc_id", "lang", "source", "text")), "statistics")
    judged = rows.join(_judges(rows, least_rows), "by_both", "left").withColumn("distance", distance())
    return judged.select("doc_id", *[x.split()[0] for x in BASE.split(", ")], "base_failed", "distance", _kept(cut).alias("kept"))


def _keeps(cut: float) -> Column:
    """Whether base rules and distance keep ``text``, held against ``centre`` and ``scatter``: one pass over the text."""

    @F.pandas_udf("boolean")
    def of(texts: pd.Series, centre: pd.Series, scatter: pd.Series) -> pd.Series:
        out = []
        for text, mean, whole in zip(texts, centre, scatter, strict=True):
            n, _, _, _, repeated, *x, noise = statistics(text)
            good = n >= 50 and 100 * repeated <= 50 * n
            if good and mean is not None:
                good = distances(np.array([x]) / GRID, np.array([noise]), np.asarray(mean, float), np.asarray(whole, float).reshape(_D, _D))[0] <= cut
            out.append(bool(good))
        return pd.Series(out, dtype=bool)

    return of(F.col("text").cast("binary"), F.col("centre"), F.col("scatter"))


def filter_kept(docs: DataFrame, least_rows: int = LEAST_ROWS, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with all their columns.

    The statistics are taken twice, once for the estimates and once beside the rows, so that no text is shuffled: only the
    estimates, a row a group, are joined to the rows.
    """
    rows = materialize(_described(docs.select("lang", "source", "text")), "statistics")
    judges = materialize(_judges(rows, least_rows), "judges")
    whole = _named(docs.select(F.struct(*docs.columns).alias("row"), "lang", "source", "text")).drop("by_lang")
    return whole.join(judges, "by_both", "left").where(_keeps(cut)).select("row.*")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assess(docs).drop("distance")


def quality_base(spark, sf_dir: str) -> DataFrame:
    """The base columns alone, as op6_quality has them."""
    return op6_quality(spark, sf_dir).drop("kept")


#: The base columns; the estimates have no SQL.
BASE_ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
t AS (SELECT r, i, word, lead(word) OVER s AS b, lead(word, 2) OVER s AS c FROM w WINDOW s AS (PARTITION BY r ORDER BY i)),
n AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, b, c) AS n FROM t WHERE c IS NOT NULL),
p AS (SELECT DISTINCT r, i + k.k AS i FROM n, (VALUES (0), (1), (2)) k(k) WHERE n >= 2),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY r),
q AS (SELECT r, count(*) AS n_repeat_words FROM p GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  coalesce(n_words, 0) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
FROM d LEFT JOIN c USING (r) LEFT JOIN l USING (r) LEFT JOIN q USING (r)
"""
