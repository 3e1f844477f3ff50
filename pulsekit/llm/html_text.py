"""Main text of web pages by the maximum-scoring subsequence (operator 8).

A page is read as one sequence of tags and words. Words score positive, tags
negative, and the contiguous run with the largest sum is the content region,
found by one linear scan. The weights come from labelled pages: those that
mark their article themselves (``article`` or ``main`` element) tell for every
kind of element how often its words, and its tags, are inside or outside. An
element that is boilerplate by its name, by its role, or by a class or id that
is the name of page furniture as it stands (``comments``, ``sidebar``; not
``with-sidebar``) counts as one tag, wherever it stands, and yields no text;
what other classes mean is left to the learned weights. Where nothing scores
that way, class names are left out of account altogether. Learning uses a bounded sample (``SAMPLE``) of the pages that mark their article.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import need, workers_ready

SAMPLE = 2000
WORD, TAG = 1.0, 1.0  # weights of kinds that no labelled page has

#: Fixed values of HTML and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object")
FURNITURE = frozenset("head nav footer aside button select menu dialog script style noscript template textarea title iframe svg math object".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead ad ads adv advert adverts advertisement advertising banner "
    "promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social comment comments disqus replies respond related recommended recommendations widget toolbar pagination pager "
    "search skip copyright".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LANDMARKS = ("article", "main")
COMMENTS = frozenset("comment comments reply replies".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MARK = re.compile("<(?:article|main)", re.I)  # LANDMARKS
_RAW_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in RAW}


def _furniture(name: str, attrs: str, inside: bool, names: bool) -> tuple[bool, str]:
    """(is it boilerplate, kind of the element: name and classes)."""
    got = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)} if attrs.strip() else {}
    classes = got.get("class", "").lower().split()
    kind = ".".join([name, *sorted(classes)[:2]])
    if name in FURNITURE or name == "header" and not inside or name == "form" and not inside and got.get("role", "").lower() == "search":
        return True, kind
    if name in ("html", "body", "main"):
        return False, kind
    words = {*classes, got.get("id", "").lower()}
    if name == "article":  # a reader's comment may be marked so
        return names and bool(words & COMMENTS), kind
    return got.get("role", "").lower() in ROLES or names and bool(words & NAMES), kind


def read_page(page: str | None, names: bool = True) -> list[tuple[str, str, bool, object]]:
    """The whole page as a list, see :func:`_read`."""
    return list(_read(page, names))


def _read(page: str | None, names: bool = True) -> Iterator[tuple[str, str, bool, object]]:
    """The page as a sequence of (what, kind, in a landmark, value).

    what: ``text`` (value: its words; kind: the element around), ``tag`` (value:
    whether it ends a block) or ``skip`` (a whole boilerplate element).
    """
    page, out, at = page or "", [], 0
    open_: list[str] = []
    kinds: list[str] = []
    blocks: list[int] = []  # places in open_ that are not inline
    count: Counter = Counter()  # how often a name is open
    skip_from, marks = None, 0

    def text(raw: str) -> None:
        if skip_from is None and raw:
            block = kinds[blocks[-1]] if blocks else ""
            out.append(("text", block, marks > 0, html.unescape(raw)))

    def close(k: int) -> None:
        nonlocal skip_from, marks
        marks -= sum(n in LANDMARKS for n in open_[k:])
        count.subtract(open_[k:])
        del open_[k:], kinds[k:]
        while blocks and blocks[-1] >= k:
            blocks.pop()
        if skip_from is not None and k <= skip_from:
            skip_from = None

    while True:
        m = _TOKEN.search(page, at)
        text(page[at : m.start() if m else len(page)])
        yield from out
        out.clear()
        if not m:
            return
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m.group().startswith("<![CDATA["):
                text(html.escape(m.group()[9:].removesuffix("]]>")))
            continue
        ends, attrs, was_skip = bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or "", skip_from is not None
        block = name not in INLINE
        if ends:
            if count[name]:
                k = len(open_) - 1
                while open_[k] != name:
                    k -= 1
                kind = kinds[k]
                close(k)
                if not was_skip:
                    out.append(("tag", "/" + kind, marks > 0, block))
            elif name == "p" and not was_skip:
                out.append(("tag", "/p", marks > 0, True))
            continue
        if block and not was_skip or name in CLOSES:
            # a block ends an open paragraph, an item its predecessor; not beyond the nearest container
            ended = CLOSES.get(name, {"p"})
            for k in reversed(blocks):
                if open_[k] in ended:
                    close(k)
                    break
                if open_[k] not in ("td", "th", "tr"):
                    break
            was_skip = skip_from is not None
        bad, kind = _furniture(name, attrs, marks > 0, names)
        if not was_skip:
            out.append(("skip" if bad and name not in VOID else "tag", kind, marks > 0, block))
        if name in VOID or attrs.rstrip().endswith("/"):
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            if not bad and not was_skip:
                out.append(("tag", "/" + kind, marks > 0, block))
            continue
        if name in LANDMARKS:
            marks += 1
        if bad and skip_from is None:
            skip_from = len(open_)
        if block:
            blocks.append(len(open_))
        count[name] += 1
        open_.append(name)
        kinds.append(kind)


def marks_article(page: str | None) -> bool:
    """Whether :func:`count_kinds` counts the page; read up to its first landmark."""
    return bool(_MARK.search(page or "")) and any(inside for _, _, inside, _ in _read(page))


def count_kinds(page: str | None) -> Counter | None:
    """How often words and tags of each kind are inside (1) or outside (0) the marked article; None if none is marked."""
    seq = read_page(page)
    if not any(inside for _, _, inside, _ in seq):
        return None
    got: Counter = Counter()
    for what, kind, inside, value in seq:
        got["w" if what == "text" else "t", kind, int(inside)] += len(value.split()) if what == "text" else 1
    return got


def weights_of(counts: dict) -> dict[str, float]:
    """Log odds of lying inside: words between 0.05 and 2, tags between -6 and -0.3."""
    out = {}
    for what, kind in {(w, k) for w, k, _ in counts}:
        odds = float(np.log((counts.get((what, kind, 1), 0) + 0.5) / (counts.get((what, kind, 0), 0) + 0.5)))
        out[f"{what} {kind}"] = min(max(odds, 0.05), 2.0) if what == "w" else -min(max(TAG - odds, 0.3), 6.0)
    return out


def best_run(scores: np.ndarray) -> tuple[int, int]:
    """[start, end) of the first contiguous run with the largest positive sum; (0, 0) if there is none."""
    if not len(scores):
        return 0, 0
    total = np.concatenate([[0.0], np.cumsum(scores)])
    low = np.minimum.accumulate(total)[:-1]
    end = int(np.argmax(total[1:] - low)) + 1
    if total[end] - low[end - 1] <= 0:
        return 0, 0
    return int(np.flatnonzero(total[:end] == low[end - 1])[-1]), end


def extract(page: str | None, weights: dict[str, float]) -> list[str]:
    """The blocks of the main text in page order; none if no run scores above zero."""
    return _extract_page(page, weights, True) or _extract_page(page, weights, False)


def _extract_page(page: str | None, weights: dict[str, float], names: bool) -> list[str]:
    seq = read_page(page, names)
    scores = np.array([
        len(v.split()) * weights.get(f"w {k}", WORD) if what == "text" else weights.get(f"t {k}", -TAG) for what, k, _, v in seq])
    start, end = best_run(scores)
    blocks, now = [], []
    for what, kind, _, value in seq[start:end]:
        if what == "text":
            now.append(value)
        elif value:
            blocks.append("".join(now))
            now = []
        elif kind.split(".")[0] == "br":
            now.append(" ")
    blocks.append("".join(now))
    return [b for b in (" ".join(x.split()) for x in blocks) if b]


def learn_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from up to ``sample`` pages that mark their article (in the order of a hash of the id); {} if none does."""
    rows = need(pages, id_col, html_col).toDF("page_id", "html").filter("html is not null and page_id is not null")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select([0]).filter(pa.array([marks_article(p.as_py()) for p in batch.column(1)], pa.bool_()))

    # at most `sample` ids of 8 bytes are gathered and broadcast, not their pages
    ids = rows.mapInArrow(marked, rows.select("page_id").schema).distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    rows = rows.join(F.broadcast(ids), "page_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: Counter = Counter()
            for page in batch.column(0).to_pylist():
                got.update(count_kinds(page) or {})
            keys = list(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([k[2] for k in keys], pa.int32()), pa.array([got[k] for k in keys], pa.int64())],
                names=["what", "kind", "inside", "n"])

    found = rows.select("html").mapInArrow(count, "what string, kind string, inside int, n long")
    return weights_of({(r[0], r[1], r[2]): r[3] for r in found.groupBy("what", "kind", "inside").agg(F.sum("n")).collect()})


def _extract(weights: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = json.loads(weights)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                blocks = [extract(p, w) for p in part.column("__html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(blocks, pa.list_(pa.string()))],
                                                 names=[*part.schema.names[:-1], "__blocks"])

    return run


def extract_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html", blocks_col: str = "blocks", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of every row (all, if None) with the blocks of its main text.

    A null or empty page, and one without any text that scores, has no blocks.
    A name that the kept columns have already is refused.
    """
    workers_ready(pages.sparkSession)
    keep = list(pages.columns if keep is None else keep)
    if blocks_col in keep:
        raise ValueError(f"{blocks_col} clashes with a column of the input; name another")
    src = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").cast("string").alias("__html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    out = src.mapInArrow(_extract(json.dumps(weights)), f"{kinds}{', ' if keep else ''}__blocks array<string>")
    return out.withColumnRenamed("__blocks", blocks_col)
