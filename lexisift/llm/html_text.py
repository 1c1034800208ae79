"""Main text of web pages by the maximum-scoring subsequence.

A page is a row of tokens, runs of words and tags.  Words score positive (those
outside of the page's article negative) and tags negative, with weights learned
from labelled pages (those with exactly one closed ``article`` element: the log odds of
a token's being inside it); the contiguous run of tokens with
the largest sum, found in one scan, is the content.

* A token's weight is that of its kind (tag, whether most words of the block are
  linked, place inside or outside of the page's articles); a kind the labelled
  pages do not show backs off to coarser kinds, at last to a small weight for
  tags of running content (tables, lists, captions, code) and a larger one for
  containers, which may be boxes of their own.
* Scripts, styles, forms and named page parts (``nav``, ``footer``, roles) are
  taken out wherever they stand.  Elements inside or beside the article that hold
  no content are known by their class names: the log odds of a class inside and
  outside of labelled articles, over all elements of all labelled pages, on top of
  a prior for the usual names of such boxes.  An element that holds the page's
  first article or main element is never taken out.

Pages are mapped one by one, so nothing is shuffled but the weights' counts, a
few rows a task.  The scanner is linear in the page, also on unclosed tags,
comments and quotes.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, release, written

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre section "
                   "select summary table tbody td tfoot th thead tr ul").split())
NOISE = frozenset(("head nav footer aside form script style textarea title xmp iframe noembed noframes noscript template button select "
                   "option input svg canvas object audio video dialog menu").split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NOISE_CLASSES = frozenset((
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar widget widgets footer masthead topbar comment comments commentlist discussion respond reply "
    "replies disqus notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations pagination pager copyright toolbar alert announcement").split())
#: Words that may stand beside those in a class name without changing what it names.
GENERIC = frozenset((
    "box area section block container wrapper wrap inner outer list item items links link bar panel content body title group slot unit "
    "left right top bottom main primary secondary site page post posts article articles story stories button buttons icons form thread "
    "global fixed sticky mobile desktop")
    .split())
SITE_HEADER = frozenset("header site page top global main wrap wrapper container".split())
KNOWN = BLOCK | NOISE | VOID | frozenset("a b i em strong span u s small sub sup code kbd q cite abbr time mark font tt".split())
#: Containers; every other known tag belongs to running content.
BOXES = frozenset("article aside body center dir div fieldset footer form header html iframe main menu nav section".split())
DEFAULT_WORD, DEFAULT_TAG = 1.0, -2.0
LEAST_WORD, MOST_WORD, HEADING_WORD = 0.05, 0.2, 1.0     # a heading is short but surely content
FLOW_TAG, BOX_TAG, LEAST_TAG = -0.01, -1.0, -8.0
LISTED, NOISE_ODDS = -4.0, -2.0                          # prior log odds of a listed class; elements below are noise
CLASSES, SEEN = 20_000, 7                                # learned classes (the commonest), and how often they must be seen
MAIN_SHARE = 1 / 3                                       # articles with fewer of a page's words are not its content


def class_names(value: str) -> list[tuple[str, ...]]:
    """The lower-cased words of every name in a class or id attribute."""
    value = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value)
    return [w for x in value.lower().split() if (w := tuple(y for y in re.split(r"[^a-z]+", x) if y))]


def class_odds(words: tuple[str, ...], weights: dict[str, float]) -> float:
    """Log odds that an element of this class is content."""
    listed = not NOISE_CLASSES.isdisjoint(words) and (NOISE_CLASSES | GENERIC).issuperset(words)
    return weights.get("class " + "-".join(words), 0.0) + (LISTED if listed else 0.0)


def is_noise(tag: str, attrs: str, in_article: bool, weights: dict[str, float]) -> bool:
    if tag in NOISE or (tag == "header" and not in_article):
        return True
    if not attrs:
        return False
    for name, a, b, c in ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none", value.lower()):
                return True
        elif name == "role":
            if value.lower() in NOISE_ROLES:
                return True
        elif tag not in ("html", "body", "main"):
            names = class_names(value)
            if any(class_odds(w, weights) < NOISE_ODDS for w in names):
                return True
            flat = {x for w in names for x in w}
            if "header" in flat and flat <= SITE_HEADER and not in_article:
                return True
    return False


def scan(page: str):
    """Tokens (kind, tag, attrs or text): ``t`` text, ``o`` open, ``c`` close, in page order."""
    pos, n = 0, len(page)
    while pos < n:
        at = page.find("<", pos)
        if at < 0:
            yield "t", "", page[pos:]
            return
        if at > pos:
            yield "t", "", page[pos:at]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            pos = end + 3
            if end < 0:
                return
            continue
        nxt = page[at + 1:at + 2]
        if nxt in ("!", "?") or (nxt == "/" and not page[at + 2:at + 3].isalpha()):
            end = page.find(">", at)
            pos = end + 1
            if end < 0:
                return
            continue
        m = TAG.match(page, at)
        if m:
            close, tag, attrs, pos = m[1], m[2].lower(), m[3], m.end()
        elif (nxt.isalpha() and nxt.isascii()) or nxt == "/":
            end = page.find(">", at)
            if end < 0:
                return
            body = page[at + 1:end].lstrip("/").split(None, 1)
            close, tag, attrs, pos = nxt == "/", body[0].lower() if body else "", "", end + 1
        else:
            yield "t", "", "<"
            pos = at + 1
            continue
        if close:
            yield "c", tag, ""
            continue
        yield "o", tag, attrs
        if tag in RAW and not attrs.endswith("/"):
            m = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, pos)
            if not m:
                return
            pos = m.start()


class Page:
    """Tokens of a page with what is noise and which block each belongs to."""

    def __init__(self, page: str, weights: dict[str, float]):
        self.kind, self.tag, self.text, self.context = [], [], [], []
        self.boxes, self.classes = [], []                         # (start, end) of blocks; (start, class)
        spans, stack, open_tags, articles = [], [], {}, []
        self.main = None                                          # first article or main that is not noise itself
        for kind, tag, body in scan(page):
            i = len(self.kind)
            if kind == "o" and tag in BLOCK and open_tags.get("p"):
                self._leave("p", stack, open_tags, i, spans, articles)
            self.kind.append(kind)
            self.tag.append(tag)
            self.text.append(body if kind == "t" else "")
            self.context.append(stack[-1][1] if stack else "")
            if kind == "o" and tag not in VOID:
                noise = is_noise(tag, body, bool(open_tags.get("article")), weights)
                if body:
                    self.classes += [(i, "-".join(w)) for name, a, b, c in ATTR.findall(body) if name.lower() in ("class", "id")
                                     for w in class_names(a or b or c)]
                if tag in ("article", "main") and not noise and self.main is None:
                    self.main = i
                stack.append((tag, tag if tag in BLOCK or tag == "a" else self.context[-1], i, noise))
                open_tags[tag] = open_tags.get(tag, 0) + 1
            elif kind == "c" and open_tags.get(tag):
                self._leave(tag, stack, open_tags, i, spans, articles)
        n = len(self.kind)
        for tag, _, at, noise in reversed(stack):                 # never closed
            if tag == "article" and not noise:
                articles.append((at, None))
            if noise:
                if tag in ("head", "title") or tag in RAW:
                    end = next((j for j in range(at + 1, n) if self.kind[j] == "o" and self.tag[j] in ("body", "article", "main")), n)
                else:
                    end = next((j for j in range(at + 1, n) if self.kind[j] == "o" and self.tag[j] in BLOCK), n)
                spans.append((at, end))
        self.noise = np.zeros(n + 1, np.int64)
        for a, b in spans:
            if self.main is not None and a < self.main < b and self.tag[a] not in RAW:
                continue                                          # it holds the page's content
            self.noise[a] += 1
            self.noise[b] -= 1
        self.noise = np.cumsum(self.noise[:-1]) > 0 if n else np.zeros(0, bool)
        self.articles = articles
        self._place(n)

    def _place(self, n: int) -> None:
        """Which blocks hold mostly links, and which tokens lie in the page's articles."""
        own = np.array([0 if self.noise[i] or self.kind[i] != "t" else len(self.text[i].split()) for i in range(n)], np.int64)
        self.words = own
        link = np.where([c == "a" for c in self.context], own, 0) if n else own
        total, links = np.concatenate([[0], np.cumsum(own)]), np.concatenate([[0], np.cumsum(link)])
        self.linked = np.zeros(n, bool)
        for a, b in self.boxes:
            if 2 * (links[b] - links[a]) > total[b] - total[a]:
                self.linked[a] = True
                self.linked[min(b, n - 1)] = True
        depth = np.zeros(n + 1, np.int64)
        for a, b in self.articles:
            depth[a + 1] += 1
            depth[n if b is None else b] -= 1
        inside = np.cumsum(depth[:-1]) > 0 if n else np.zeros(0, bool)
        share = own[inside].sum() / max(1, total[-1])
        self.place = np.where(inside, "in", "out") if self.articles and share >= MAIN_SHARE else np.full(n, "none")

    def _leave(self, tag, stack, open_tags, i, spans, articles):
        if tag == "p" and not any(x[0] == "p" for x in stack[-8:]):
            return
        if tag == "p":                                            # a block inside a block that holds the p does not end it
            for x in reversed(stack):
                if x[0] == "p":
                    break
                if x[0] in BLOCK:
                    return
        while stack:
            name, _, at, noise = stack.pop()
            open_tags[name] -= 1
            if name in BLOCK:
                self.boxes.append((at, i))
            if noise:
                spans.append((at, i + 1 if name == tag else i))
            if name == "article" and not noise:
                articles.append((at, i))
            if name == tag:
                return

    def keys(self):
        """Each token that may score: its weight keys from fine to coarse, and its number of words."""
        for i, kind in enumerate(self.kind):
            if self.noise[i]:
                continue
            if kind == "t":
                n, place = int(self.words[i]), self.place[i]
                if n:
                    key = f"word {self.context[i]}"
                    yield i, (f"{key}|{place}", f"word|{place}", key, "word"), n
            else:
                tag = self.tag[i] if self.tag[i] in KNOWN else "other"
                key = f"{kind} {tag}"
                back = "tag" if tag in BOXES else "flow"
                if self.place[i] == "in":                         # containers inside an article are running content
                    yield i, (f"{key}|in", "tag|in", key, back), 1
                elif self.linked[i]:
                    yield i, (f"{key}|linked", "linked", key, back), 1
                else:
                    yield i, (key, back), 1

    def blocks(self, lo: int, hi: int) -> list[str]:
        """Texts of the blocks between two tokens, white space made one space."""
        out, cur = [], []

        def flush():
            text = " ".join(html.unescape("".join(cur)).split())
            if text:
                out.append(text)
            cur.clear()

        for i in range(lo, hi):
            if self.kind[i] == "t":
                if not self.noise[i]:
                    cur.append(self.text[i])
            elif self.tag[i] in BLOCK:
                flush()
            elif self.tag[i] == "br":
                cur.append(" ")
        flush()
        return out


def best_run(scores: np.ndarray) -> tuple[int, int]:
    """Bounds of the contiguous run with the largest positive sum (the longest of
    equal ones that start first); empty if nothing is positive."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    low = np.minimum.accumulate(total[:-1])
    gain = total[1:] - low
    if not len(gain) or gain.max() <= 0:
        return 0, 0
    end = int(gain.argmax())
    return int(np.argmin(total[:end + 1])), end + 1


def weight_of(keys: tuple[str, ...], weights: dict[str, float]) -> float:
    """The weight of the finest key that has one."""
    for k in keys:
        w = weights.get(k)
        if w is not None:
            return w
    return DEFAULT_WORD if keys[0].startswith("word") else weights.get("tag", DEFAULT_TAG)


def main_text(page: str | None, weights: dict[str, float]) -> str:
    p = Page(page or "", weights)
    at, scores = [], []
    for i, keys, n in p.keys():
        at.append(i)
        scores.append(weight_of(keys, weights) * n)
    lo, hi = best_run(np.array(scores, float))
    return "\n\n".join(p.blocks(at[lo], at[hi - 1] + 1)) if hi else ""


def learn(pages: DataFrame, html_col="html") -> dict[str, float]:
    """Weights from all tokens and elements of all labelled pages.

    A kind of token: log odds of its being inside the article; words
    within ``LEAST_WORD`` and ``MOST_WORD`` (headings ``HEADING_WORD``), tags within
    ``LEAST_TAG`` and ``FLOW_TAG``.  A class: log odds of its elements inside
    and outside (those that hold the article are neither)."""
    def count(frames):
        inside, outside = {}, {}

        def rows():
            keys = sorted(inside.keys() | outside.keys())
            return pd.DataFrame({"key": keys, "a": [inside.get(k, 0) for k in keys], "b": [outside.get(k, 0) for k in keys]}
                                ).astype({"key": "object", "a": "int64", "b": "int64"})

        for f in frames:
            for x in f["html"]:
                p = Page(x or "", {})
                if len(p.articles) != 1 or p.articles[0][1] is None:
                    continue
                a, b = p.articles[0]
                for i, keys, n in p.keys():
                    side = inside if a < i < b else outside
                    for k in keys[:-1]:
                        side[k] = side.get(k, 0) + n
                around = {i for i, j in p.boxes if i <= a and j >= b}
                for i, name in p.classes:
                    if i not in around:
                        side, k = (inside if a < i < b else outside), "class " + name
                        side[k] = side.get(k, 0) + 1
            if len(inside) + len(outside) > 100_000:
                yield rows()
                inside.clear()
                outside.clear()
        yield rows()

    got = written(pages.select(F.col(html_col).alias("html")).mapInPandas(count, "key string, a long, b long")
                  .groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "page-weights")
    is_class = F.col("key").startswith("class ")
    # bounded: one row for each known tag, context and place, and the commonest classes
    rows = got.filter(~is_class).collect() + (got.filter(is_class & (F.col("a") + F.col("b") >= SEEN) & (F.octet_length("key") <= 256))
                                              .orderBy(-(F.col("a") + F.col("b")), "key").limit(CLASSES).collect())
    release(got)
    out = {"word|out": -MOST_WORD, "word a": LEAST_WORD, "word": MOST_WORD, "flow": FLOW_TAG, "tag": BOX_TAG, "tag|in": FLOW_TAG, "linked": BOX_TAG}
    for r in rows:
        if r.key in out:
            continue
        w = float(np.log((r.a + 0.5) / (r.b + 0.5)))
        if r.key.startswith("word"):
            most = HEADING_WORD if re.match(r"word h[1-6]\b", r.key) else MOST_WORD
            least = -MOST_WORD if r.key.endswith("|out") else LEAST_WORD
            w = min(max(w, least), most)
        elif not r.key.startswith("class "):
            w = min(max(w, LEAST_TAG), FLOW_TAG)
        out[r.key] = w
    return out


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    Null and empty pages, and pages without words outside of what never is
    content, give an empty text.  Without labelled pages every token backs off to
    the coarsest weights.  Repeated rows give a row each; other columns are not
    read."""
    weights = pages.sparkSession.sparkContext.broadcast(learn(pages, html_col))

    def run(arr):
        out = [main_text(x, weights.value) for x in arr.to_pylist()]
        return [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]

    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_texts(src, run, "text string, n_chars long", "html")
