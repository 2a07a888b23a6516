"""Main-text extraction from HTML.

The standard library's parser streams over a page once. Its events are cut
into lines at block-level tags; every line has its text, its count of tags
and the elements it lies in. The text-to-tag ratios of the lines are smoothed
with a Gaussian and clustered by a threshold: lines above the smoothed mean
are content. The content region is the article element (or main element, or
failing these the innermost container) that holds most of the clustered
text; every line in it is kept, short ones too, unless it lies in an element
that is by its tag, role, class or id a menu, header, footer, sidebar,
notice, advert, form or reader comment. White space inside a line becomes one
space, and the lines are joined by one space.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.base import in_arrow

SIGMA = 1.0          # of the Gaussian, in lines
COVERED = 0.7        # share of the clustered text a container must hold
#: Element names (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
SILENT = frozenset("script style head title noscript template iframe object svg math canvas audio video map".split())
ASIDE = frozenset("nav footer aside form button select option textarea dialog menu fieldset input".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
#: Words of a class, id or role that mark what is not the article.
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                  "notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu menus breadcrumb "
                  "breadcrumbs sidebar sidenav footer masthead topbar toolbar share sharing social related recommended trending widget comment "
                  "comments respond reply replies disqus discussion pagination pager skip complementary contentinfo search paywall".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def marked(attrs) -> bool:
    for name, value in attrs:
        if value and name in ("class", "id", "role", "aria-label"):
            if any(w.lower() in MARKS for w in WORD.findall(value)):
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and value and "display:none" in value.replace(" ", "").lower()):
            return True
    return False


class Lines(HTMLParser):
    """Lines of a page: (text, tags, path of open elements, set aside)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, number, silent, aside
        self.lines: list[tuple[str, int, tuple, bool]] = []
        self.text: list[str] = []
        self.tags = 0
        self.count = 0

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, tuple((t, n) for t, n, _, _ in self.open), self.open[-1][3] if self.open else False))
            self.tags = 0
        self.text.clear()

    def drop_to(self, at: int):
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        names = [x[0] for x in self.open]
        if tag in CLOSES_P and "p" in names:
            at = len(names) - 1 - names[::-1].index("p")
            if not any(n in ("td", "th", "button", "object") for n in names[at:]):
                self.drop_to(at)
        elif tag in SAME and tag in names:
            at = len(names) - 1 - names[::-1].index(tag)
            if not any(n in SAME[tag] for n in names[at:]):
                self.drop_to(at)
        if tag in VOID:
            return
        silent, aside = (self.open[-1][2], self.open[-1][3]) if self.open else (False, False)
        if tag in SILENT:
            silent = True
        within = any(x[0] in ("article", "main") for x in self.open)
        body = tag in ("html", "body", "article", "main")
        if not aside and not body:
            aside = tag in ASIDE or (tag == "header" and not within) or marked(attrs)
        # an article inside comments stays set aside with them
        self.count += 1
        self.open.append((tag, self.count, silent, aside))

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self.flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.drop_to(at)
                break

    def handle_data(self, data):
        if not (self.open and self.open[-1][2]):
            self.text.append(data)

    def finish(self):
        self.close()
        self.flush()
        return self.lines


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    r = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    padded = np.pad(ratios, r, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def main_text(html: str | None) -> str:
    """The main text of one page ('' if there is none)."""
    if not html:
        return ""
    p = Lines()
    p.feed(html)
    lines = p.finish()
    free = [x for x in lines if not x[3]]
    if not free:
        return ""
    sizes = np.array([len(x[0]) for x in free], float)
    soft = smooth(sizes / np.array([max(1, x[1]) for x in free]))
    content = np.where(soft >= soft.mean() * 0.999, sizes, 0)
    held: dict[tuple, float] = {}
    for (_, _, path, _), size in zip(free, content):
        for depth, (tag, number) in enumerate(path):
            held[depth, tag, number] = held.get((depth, tag, number), 0) + size
    total = content.sum()
    region = None
    for wanted in ("article", "main"):
        own = [(s, -k[0], k) for k, s in held.items() if k[1] == wanted]
        if own:
            region = max(own)[2]
            break
    if region is None:
        wide = [(k[0], s, k) for k, s in held.items() if s >= COVERED * total and k[1] not in INLINE and k[1] != "p"]
        region = max(wide)[2] if wide else None
    kept = free if region is None else [x for x in free if region[1:] in x[2]]
    return " ".join(x[0] for x in kept)


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text, in place of ``html``; a column
    already named ``out`` is replaced. Null or empty html gives ''; rows go
    one by one, so repeated rows give equal results."""
    from pyspark.sql.types import StringType, StructField, StructType

    rest = [c for c in pages.columns if c not in (html, out)]
    src = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(html).alias(html))
    schema = StructType([*[f for f in src.schema.fields if f.name != html], StructField(out, StringType())])

    def run(batches):
        for b in batches:
            texts = pa.array([main_text(x.as_py()) for x in b.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], texts], [*rest, out])

    return in_arrow(src, run, schema)
