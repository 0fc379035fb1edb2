"""Main text of HTML pages: the best-scoring run of words and tags.

A page is a sequence of words and tags. Words score above zero and tags below, by
how much more often they occur inside than outside the article of labelled
pages, and what stands in menus, adverts and the like scores against the run.
One scan finds the run with the largest sum; if an article element holds most of
it, the element gives its exact ends.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 5000  # labelled pages, about, that the weights are learned from
DEFAULTS = {"word": 1.0, "boiler": -1.0, "tag": -2.0}

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S)
_ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: What opens inside which element closes which one that was left open.
IMPLIED = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)),
           "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td th", ("tr", "table")),
           "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}

#: Elements that are never part of an article.
BOILER_TAGS = frozenset(
    "head script style noscript template nav footer aside form button select textarea input "
    "iframe svg canvas audio video object dialog menu search title".split())
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu "
    "menubar".split())
#: Parts of class names and ids that mark them.
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup promo promotion recommended related replies reply "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget".split())
CONTENT_TAGS = frozenset(["article", "main"])


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(raw)}


def _is_boiler(name: str, raw: str, in_content: bool) -> bool:
    """Whether an element and all in it is no part of the article."""
    if name in BOILER_TAGS or name == "header" and not in_content:
        return True
    if not raw.strip() or name in ("html", "body"):
        return False
    attributes = _attributes(raw)
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in BOILER_ROLES:
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    parts = {p.lower() for key in ("class", "id")
             for p in _NAME_PART.findall(attributes.get(key, ""))}
    marks = parts & BOILER_NAMES or ("header" in parts and not in_content)
    return bool(marks) and not (name == "main" or name == "article"
                                and not parts & {"comment", "comments", "reply", "related",
                                                 "ad", "advert", "promo", "sponsored"})


def tokens(page: str) -> list[tuple]:
    """``(kind, value, boiler, content, block)`` in page order.

    Kinds are ``tag`` (value: name) and ``text`` (value: decoded text). ``content``
    numbers the outermost article or main element around (0: none), ``block``
    the block that a text belongs to.
    """
    out: list[tuple] = []
    stack: list[tuple[str, bool, int]] = []  # name, boiler, content
    open_names: Counter = Counter()
    boiler, content, block, contents, at = False, 0, 0, 0, 0

    def pop() -> None:
        nonlocal boiler, content
        name, _, _ = stack.pop()
        open_names[name] -= 1
        boiler, content = (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def close_open(names: tuple, within: tuple) -> None:
        """Pop up to an open element of ``names`` unless one of ``within`` comes first."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    pop()
                return
            if stack[k][0] in within:
                return

    def text(piece: str) -> None:
        if piece:
            out.append(("text", _html.unescape(piece), boiler, content, block))

    for start, end, closing, name, raw in _tags(page):
        text(page[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            out.append(("text", " ", boiler, content, block))
        if name in BLOCK:
            block += 1
        if closing:
            out.append(("tag", name, boiler, content, block))
            if open_names[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in BLOCK and open_names["p"]:
            close_open(("p",), ("button", "table", "td", "th", "caption", "article", "div"))
        if name in IMPLIED:
            names, within = IMPLIED[name]
            if any(open_names[n] for n in names.split()):
                close_open(tuple(names.split()), within)
        if name not in VOID:
            bad = boiler or _is_boiler(name, raw, content > 0)
            if name in CONTENT_TAGS and not bad and not content:
                contents += 1
                content = contents
            boiler = bad
            stack.append((name, boiler, content))
            open_names[name] += 1
        out.append(("tag", name, boiler, content, block))
    text(page[at:])
    return out


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, end, closing, name and attributes of tags; comments have no name."""
    at = 0
    while m := _TAG.search(page, at):
        name = (m[2] or "").lower()
        yield m.start(), m.end(), bool(m[1]), name, m[3] or ""
        at = m.end()
        if name in RAW and not m[1] and not (m[3] or "").endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if stop > at:  # what is inside is no text
                yield at, stop, False, "", ""
            at = stop


def _kinds(found: list[tuple]) -> Iterator[tuple[str, int]]:
    """The kind that each token is scored as, and how many words it has (tags: 1)."""
    for kind, value, boiler, _, _ in found:
        if kind == "tag":
            yield ("boiler" if boiler else f"<{value}>"), 1
        else:
            yield ("boiler" if boiler else "word"), len(value.split())


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per kind, how many tokens lie inside and outside of the marked articles."""
    inside, outside = Counter(), Counter()
    for batch in batches:
        for page in batch.column("html").to_pylist():
            found = tokens(page)
            if any(t[3] for t in found):
                for t, (kind, n) in zip(found, _kinds(found), strict=True):
                    (inside if t[3] and not t[2] else outside)[kind] += n
    kinds = sorted(inside.keys() | outside.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
         pa.array([outside[k] for k in kinds], pa.int64())], ["kind", "inside", "outside"])


def learn_weights(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights from pages that mark their article by an article or main element.

    A weight is the log of how much more often a kind of token occurs inside
    than outside, words held above zero and tags below. About ``sample`` such
    pages are used, chosen by a hash of the page. Without any, ``DEFAULTS``.
    """
    labelled = pages.where(F.col("html").rlike("(?i)<(article|main)\\b")).select("html")
    n = labelled.count()
    draw = F.pmod(F.xxhash64("html"), F.lit(1 << 30)) / float(1 << 30)
    counted = (labelled.where(draw < (min(1.0, sample / n) if n else 0.0))
               .mapInArrow(_count_batches, "kind string, inside long, outside long")
               .groupBy("kind").agg(F.sum("inside").alias("inside"),
                                    F.sum("outside").alias("outside"))).collect()
    total_in = sum(r["inside"] for r in counted)
    total_out = sum(r["outside"] for r in counted)
    if not total_in:
        return dict(DEFAULTS)
    weights = dict(DEFAULTS)
    for r in counted:
        odds = (math.log((r["inside"] + 0.5) / (total_in + 1))
                - math.log((r["outside"] + 0.5) / (total_out + 1)))
        if r["kind"] == "word":
            weights["word"] = min(max(odds, 0.2), 3.0)
        elif r["kind"] != "boiler":
            weights[r["kind"]] = min(max(odds, -4.0), -0.1)
    weights["boiler"] = -weights["word"]
    return weights


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum; the first on ties."""
    best, lo, hi = 0.0, 0, 0
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, lo, hi = total, start, i + 1
    return lo, hi


def main_text(page: str, weights: dict[str, float]) -> str:
    """The article's blocks, joined by an empty line."""
    found = tokens(page)
    scores, sizes = [], []
    for kind, n in _kinds(found):
        scores.append(n * weights.get(kind, weights["tag"]))
        sizes.append(n)
    lo, hi = best_run(scores)
    # If one marked element holds most of the run's words, it gives the ends.
    held: Counter = Counter()
    for t, n in zip(found[lo:hi], sizes[lo:hi], strict=True):
        if t[0] == "text" and not t[2]:
            held[t[3]] += n
    if held:
        element, n = max(held.items(), key=lambda x: (x[1], -x[0]))
        if element and 2 * n > sum(held.values()):
            at = [i for i, t in enumerate(found) if t[3] == element]
            lo, hi = at[0], at[-1] + 1
    blocks: list[list[str]] = []
    last = None
    for kind, value, boiler, _, block in found[lo:hi]:
        if kind == "text" and not boiler:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(value)
    texts = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def _extract_batches(batches: Iterator[pa.RecordBatch], weights: dict[str, float]
                     ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p or "", weights) for p in batch.column("html").to_pylist()]
        rest = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in rest), pa.array(texts, pa.string()),
             pa.array(list(map(len, texts)), pa.int64())], [*rest, "text", "n_chars"])


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) instead of ``html``.

    ``weights`` are learned from the pages themselves unless given. Character
    references are decoded, white space within a block becomes one space, blocks
    are joined by an empty line. A null, empty or tagless-and-empty page gives an
    empty text; a page without markup is one block. Columns ``text`` and
    ``n_chars`` of the input are replaced, others carried along; repeated rows
    give repeated rows; an empty table gives an empty one.
    """
    kept = pages.select(*(F.col(f"`{c}`") for c in pages.columns
                          if c.lower() not in ("text", "n_chars")))
    if weights is None:
        weights = learn_weights(kept)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields
                        if f.name != "html"] + ["text string", "n_chars long"])
    return kept.mapInArrow(partial(_extract_batches, weights=weights), schema)
