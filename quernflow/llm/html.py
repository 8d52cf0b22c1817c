"""The main text of web pages by the maximum-scoring subsequence of their words and tags.

A page is a sequence of words and tags. A word's score is the log-odds that it is article text, given the elements that are
open around it (their names, the words of their class, id and role); a tag's is negative, by its name. Both are fitted on labelled pages: a small labelled file, and a bounded sample of the table's pages in which an
article or main element tells the text from the rest (that element itself is hidden from the fit). A linear scan finds the
contiguous run with the largest sum; inside it, words of negative score are cut.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from math import log
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches as arrow

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label|data-role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)


# Element names by how they nest and break lines.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr x-in x-out".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr x-in x-out".split())
ROOTS = frozenset("article main".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ALIKE = frozenset("li dt dd tr td th option".split())

#: Scores are whole numbers of 1/UNIT, so that sums of them are exact.
UNIT = 1024
#: What a tag costs at least and at most, and one that no labelled page has.
LEAST_TAG, MOST_TAG, OTHER_TAG = 0.05, 1.0, 0.3
#: Inside the run, words are cut whose log-odds are below the negative of this.
CUT = UNIT
#: What a piece of text that is none of the article costs the run at most: a long advert must not part an article in two.
PIECE = 2 * UNIT
#: Pages of the table that are labelled by their structure, at most, and the characters of one that are looked at.
SAMPLE_PAGES, SAMPLE_CHARS = 200, 100_000
LABELLED = Path(__file__).with_name("labelled_pages.html")


def features(name: str, attrs: str) -> list[str]:
    """What an element says of the words in it: its name, the words of its class, id and role, and whether it is hidden."""
    if name in ("html", "body"):
        return []
    found = [f"in {name}"]
    if attrs:
        if _HIDDEN.search(attrs):
            found.append("hidden")
        for match in _CLASS.finditer(attrs):
            for token in re.sub(r"([a-z])([A-Z])", r"\1-\2", match[1] or match[2] or match[3] or "").lower().split():
                found += [f"as {part}" for part in re.split(r"[-_\d]+", token) if part]
    return found


def tokens(html: str, weigh=None) -> Iterator[tuple[str, str, object, int]]:
    """(kind, tag or piece of text, open features, score) in page order: kind is ``tag`` or ``text``.

    With ``weigh`` (feature to score) a text's score is the sum over its open features, each counted once; without, the
    features are given as a tuple. Unclosed elements end with their parents; a paragraph ends where a block begins; an
    article or main element ends open elements that weigh against text, since those were left unclosed. The work is linear
    in the page, however deep it nests.
    """
    stack: list[tuple[str, list[str]]] = []
    names: Counter = Counter()
    active: Counter = Counter()
    total, at = 0, 0

    def push(name, attrs):
        nonlocal total
        own = features(name, attrs)
        stack.append((name, own))
        names[name] += 1
        for f in own:
            active[f] += 1
            if weigh and active[f] == 1:
                total += weigh.get(f, 0)

    def pop():
        nonlocal total
        name, own = stack.pop()
        names[name] -= 1
        for f in own:
            active[f] -= 1
            if not active[f]:
                del active[f]
                if weigh:
                    total -= weigh.get(f, 0)
        return name

    def text(piece):
        if piece and not piece.isspace():
            yield "text", piece, None if weigh else tuple(active), total
        elif piece:
            yield "text", " ", None if weigh else (), 0

    for found in _TOKEN.finditer(html):
        yield from text(html[at : found.start()])
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        if not found[0].endswith(">"):
            break  # the page ends within a tag
        name, end, attrs = name.lower(), found["end"] or found["end2"] or "", found["attrs"] or found["attrs2"] or ""
        if end:
            if names[name]:
                while pop() != name:
                    pass
        elif name not in VOID:
            if name in ROOTS and weigh:
                while stack and sum(weigh.get(f, 0) for f in stack[-1][1]) < 0 and stack[-1][0] not in ROOTS and stack[-1][0] != "body":
                    pop()
            if name in CLOSES_P and names["p"]:
                while pop() != "p":
                    pass
            if name in ALIKE and stack and stack[-1][0] == name:
                pop()
            push(name, attrs)
        yield "tag", end + name, None, 0
    else:
        yield from text(html[at:])


# ---------------------------------------------------------------- weights


def labelled_words(page: str, hide: frozenset = frozenset()) -> tuple[Counter, Counter]:
    """Counts of (features, whether article text) of the words and of (name, whether inside) of the tags of a labelled page:
    ``[[`` and ``]]`` bound the article, ``{{`` and ``}}`` what is none of it inside."""
    words, tags = Counter(), Counter()
    inside = cut = False
    for kind, piece, open_, _ in tokens(re.sub(r"\[\[|\{\{", lambda m: f"<x-in id={m[0]}>", re.sub(r"\]\]|\}\}", lambda m: f"<x-out id={m[0]}>", page))):
        if kind == "tag" and piece in ("x-in", "x-out"):
            # marks come as [[ {{ }} ]]: the outer pair opens first and closes last
            if piece == "x-in":
                inside, cut = True, inside
            elif cut:
                cut = False
            else:
                inside = False
        elif kind == "tag":
            if piece.lstrip("/") not in hide:
                tags[piece, inside and not cut] += 1
        elif piece != " ":
            n = len(piece.split())
            kept = tuple(f for f in open_ if f[3:] not in hide)
            words[kept, inside and not cut] += n
    return words, tags


def by_structure(page: str) -> str | None:
    """A page marked by its one article or main element; None for any other page, or one whose markup ends inside it."""
    found = list(re.finditer(r"<(/?)(article|main)\b[^>]*>", page, re.I))
    if len(found) != 2 or found[0][1] or not found[1][1] or found[0][2].lower() != found[1][2].lower():
        return None
    if re.search(r"\[\[|\]\]|\{\{|\}\}", page):
        return None
    return page[: found[0].end()] + "[[" + page[found[0].end() : found[1].start()] + "]]" + page[found[1].start() :]


def fit(pages: list[tuple[Counter, Counter]], rounds: int = 400, decay: float = 1e-3) -> dict[str, int]:
    """Scores of features and tags: a logistic regression of words on their features (each page's article and rest weigh
    alike), and tags' log-odds of standing inside, held below zero."""
    patterns: dict[tuple, np.ndarray] = defaultdict(lambda: np.zeros(2))
    inside, outside = Counter(), Counter()
    for words, tags in pages:
        for side in (False, True):
            total = sum(n for (_, s), n in words.items() if s == side)
            for (open_, s), n in words.items():
                if s == side:
                    patterns[open_][int(side)] += n / total
        for (name, s), n in tags.items():
            (inside if s else outside)[name] += n
    known = sorted({f for open_ in patterns for f in open_})
    place = {f: i for i, f in enumerate(known)}
    x = np.zeros((len(patterns), len(known) + 1))
    x[:, -1] = 1
    for i, open_ in enumerate(patterns):
        x[i, [place[f] for f in open_]] = 1
    y = np.array(list(patterns.values())).reshape(-1, 2)
    y /= max(1, len(pages))
    w = np.zeros(len(known) + 1)
    for _ in range(rounds):  # Newton's steps; the decay keeps them finite
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y[:, 1] - (y[:, 0] + y[:, 1]) * p) - decay * w
        bend = (x * ((y[:, 0] + y[:, 1]) * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    table = {f: round(UNIT * w[i]) for f, i in place.items()}
    table["bias"] = round(UNIT * w[-1])
    all_in, all_out = sum(inside.values()), sum(outside.values())
    for name in {*inside, *outside}:
        odds = log((inside[name] + 0.5) / (all_in + 1)) - log((outside[name] + 0.5) / (all_out + 1))
        table[f"<{name}"] = round(UNIT * (-LEAST_TAG if name.lstrip("/") in INLINE else max(min(odds, -LEAST_TAG), -MOST_TAG)))
    return table


@lru_cache(1)
def labelled_pages() -> tuple[str, ...]:
    return tuple(LABELLED.read_text("utf-8").split("\n====\n"))


def learn(sample: list[str]) -> dict[str, int]:
    """Scores from the labelled file and from those of ``sample`` that their structure labels."""
    marked = [page for page in map(by_structure, sample) if page]
    own = [labelled_words(page) for page in labelled_pages()]
    theirs = [labelled_words(page, ROOTS) for page in marked]
    # the file weighs as much as the sample, so that what only one of them has counts
    return fit(own * max(1, len(theirs) // len(own)) + theirs)


@lru_cache(1)
def _of_file() -> dict[str, int]:
    return learn([])


# ---------------------------------------------------------------- extraction


def best_run(scores: list[int]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum, by one scan; (0, 0) when no sum is above zero."""
    best, best_at, total, start = 0, (0, 0), 0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0, i
        total += score
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def scored(html: str, weights: dict[str, int]) -> list[tuple[str, str, int]]:
    """(kind, tag or piece, score) of a page: a piece's is that of each of its words, a tag's its own."""
    out = []
    for kind, piece, _, score in tokens(html, weights):
        if kind == "tag":
            out.append((kind, piece, weights.get(f"<{piece}", -round(UNIT * (LEAST_TAG if piece.lstrip("/") in INLINE else OTHER_TAG)))))
        elif piece == " ":
            out.append((kind, piece, 0))
        else:
            out.append((kind, piece, weights["bias"] + score))
    return out


def main_text(html: str | None, weights: dict[str, int] | None = None, scan=best_run) -> str:
    """The article's text: blocks joined by one space, character references decoded, white space runs as one space. Without
    ``weights`` those of the labelled file alone."""
    if not html:
        return ""
    weights = weights or _of_file()
    known = scored(html, weights)
    start, end = scan([score if kind == "tag" else max(score * len(piece.split()), -PIECE) for kind, piece, score in known])
    out = []
    for kind, piece, score in known[start:end]:
        if kind == "tag":
            if piece.lstrip("/") not in INLINE:
                out.append(" ")
        elif score >= -CUT:
            out.append(piece)
    return " ".join(unescape("".join(out)).split())


def _extract(weights: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), weights) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def sample_pages(pages: DataFrame, most: int = SAMPLE_PAGES) -> list[str]:
    """The html of ``most`` pages, those with the least hashes of their page_id; longer ones than ``SAMPLE_CHARS`` not."""
    ids = pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(most)
    ids = [r["page_id"] for r in ids.collect()]
    found = pages.where(F.col("page_id").isin(ids) & (F.length("html") <= SAMPLE_CHARS)).select("html")
    return sorted(r["html"] for r in found.limit(2 * most).collect()) if ids else []


def extract_main_text(pages: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Without ``weights`` they are fitted on the labelled file and ``sample_pages``; whole pages are read and nothing is
    capped. A null or empty page, or one without article text, gives an empty text. Null page_id and url stay null; repeated
    rows each come back; other columns are not read; no rows for an empty table. Equal runs: the first.
    """
    arrow.bound(pages.sparkSession)
    table = learn(sample_pages(pages)) if weights is None else weights
    rows = pages.select("page_id", "url", "html").mapInArrow(_extract(table), "page_id long, url string, text string")
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def op7_html(spark, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
