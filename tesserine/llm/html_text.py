"""Main text of web pages: the contiguous region of a page whose words and tags score highest."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserine.llm.common import release

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of which nothing is text of the page.
SILENT = frozenset("script style title textarea noscript template iframe object svg math canvas audio video select button head datalist".split())
_IN_HEAD = frozenset("title meta link script style base noscript template".split())
RAW = frozenset(("script", "style", "title", "textarea", "noscript", "iframe"))  # no markup inside, up to the end tag
#: Elements that end an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: Elements whose tags part blocks of text; all others, unknown ones too, stand in a line.
BLOCK = _ENDS_P | frozenset("#root html body head br li dt dd tr td th thead tbody tfoot caption figcaption summary legend option optgroup title".split())
#: An open element of the first kind ends with a start tag of the second.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Elements and words of class, id and role that hold something else than the article, before any page has been seen.
OTHER_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog"))
OTHER_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
    notification popup modal overlay newsletter subscribe subscription signup login register paywall sidebar side aside widget widgets nav navbar
    navigation menu menus topbar toolbar breadcrumb breadcrumbs pagination pager footer copyright legal disclaimer header masthead share sharing
    social related recommended recommendations trending popular comment comments commentlist disqus respond reply replies discussion reactions
    feedback skip search searchbox contentinfo complementary banner dialog alert alertdialog""".split()
)
#: An article in one of these is a comment or a teaser.
_NO_PLACE = frozenset(("nav", "aside", "footer"))
_OTHERS = frozenset("comment comments commentlist disqus respond replies related recommended recommendations trending popular".split())
#: Start tags that may head an article: inside of one they are no page header.
_HEADING = frozenset(("header", "banner", "masthead"))
KINDS = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dt", "dd", "pre", "blockquote", "figcaption", "caption", "summary", "a"))
PLACES = ("inside", "outside", "open")  # of the page's one article; open: it has none or several

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TELLING = re.compile(r"class|\bid\b|role|hidden|style|itemprop", re.I)
_NAME = re.compile(r"[a-z]+")
_UNSURE = re.compile(r"(?:no|has|with|without|is|js)[-_]")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _chain(e: Element | None) -> Iterator[Element]:
    while e is not None:
        yield e
        e = e.up


class Element:
    __slots__ = ("tag", "up", "names", "hidden", "holds", "article", "state")

    def __init__(self, tag: str, up: Element | None, attrs: str):
        self.tag, self.up, self.names, self.hidden, self.holds, self.state = tag, up, (), False, False, None
        self.article = tag in ("article", "main")
        if attrs and _TELLING.search(attrs):
            self._read(attrs)
        if self.article:
            self.article = not OTHER_NAMES.intersection(self.names) and not any(a.tag in _NO_PLACE or _OTHERS.intersection(a.names) for a in _chain(up))
        if self.article:
            for a in _chain(up):  # a form or a banner that holds the article is none
                a.holds = True

    def _read(self, attrs: str) -> None:
        names: list[str] = []
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key in ("class", "id", "role"):
                for part in value.lower().split():
                    if not _UNSURE.match(part):
                        names += _NAME.findall(part)
            elif key == "itemprop" and value.lower() == "articlebody":
                self.article = True
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDES.search(value)):
                self.hidden = True
        self.names = tuple(dict.fromkeys(names))


def parse(page: str) -> list[tuple[Element, str, str]]:
    """A page as events (element, kind, text) in order: "text" with a run of text as it stands, "<" a start tag, ">" an end.

    Tags, comments, declarations and raw elements are told apart as browsers do, in one scan; what is left open at the end
    ends there. Paragraphs, list items and cells end with the next one."""
    root = Element("#root", None, "")
    events: list[tuple[Element, str, str]] = []
    now, pos, size, quotes = root, 0, len(page), True
    opened: Counter = Counter()

    def close(e: Element) -> Element:
        """e and all in it end; the element that is open now."""
        x = now
        while x is not e:
            opened[x.tag] -= 1
            x = x.up
        opened[e.tag] -= 1
        events.append((e, ">", ""))
        return e.up

    while pos < size:
        lt = page.find("<", pos)
        if lt < 0:
            lt = size
        if lt > pos:
            events.append((now, "text", page[pos:lt]))
        if lt == size:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            pos = size if end < 0 else end + 3
            continue
        m = _TAG.match(page, lt) if quotes else None
        if m:
            slash, tag, attrs, pos = m[1], m[2].lower(), m[3], m.end()
        else:
            end = page.find(">", lt)
            if not (lt + 1 < size and (page[lt + 1].isalpha() or page[lt + 1] in "/!?")):
                events.append((now, "text", "<"))
                pos = lt + 1
                continue
            if end < 0:
                break  # a tag that the page's end cuts off
            inner = page[lt + 1 : end]
            pos = end + 1
            if page[lt + 1] in "!?":
                continue
            quotes = quotes and not ('"' in inner or "'" in inner)  # a quote that nothing closes: from here on tags end at the next >
            slash, rest = ("/", inner[1:]) if inner[0] == "/" else ("", inner)
            tag, _, attrs = rest.partition(" ")
            tag = tag.strip("/").lower()
            if not tag[:1].isalpha():
                continue
        if slash:
            if opened[tag]:
                now = close(next(e for e in _chain(now) if e.tag == tag))
            continue
        if now.tag == "head" and tag not in _IN_HEAD:
            now = close(now)
        if tag in _ENDS_P or tag in _SIBLINGS:
            stop = _SCOPES.get(tag, ())
            e = now
            while e is not root and e.tag not in stop:
                if (e.tag == "p" and tag in _ENDS_P) or tag in _SIBLINGS.get(e.tag, ()):
                    now = close(e)
                    break
                if e.tag in BLOCK and e.tag not in _SIBLINGS:
                    break
                e = e.up
        e = Element(tag, now, attrs)
        events.append((e, "<", ""))
        if tag in VOID:
            continue
        if tag in RAW:
            shut = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, pos)
            pos = size if shut is None else shut.start()
            end = page.find(">", pos)
            pos = size if end < 0 else end + 1
            continue
        now = e
        opened[tag] += 1
    return events


#: Blocks of text, lists and tables; what these stand in is their frame.
_FRAMED = KINDS | {"ul", "ol", "dl", "menu", "table", "thead", "tbody", "tfoot", "tr", "figure", "#root"}


class State:
    """What is known of an element when its text is judged."""

    __slots__ = ("worst", "source", "silent", "inside", "kind", "link", "frame")


def _states(events: list[tuple[Element, str, str]], weights: dict[str, float]) -> tuple[Element | None, Callable[[Element], State]]:
    """The page's one article, if it has one, and the state of an element by the weights of containers."""
    found = list(dict.fromkeys(e for e, kind, _ in events if kind == "<" and e.article))
    found = [e for e in found if e.tag != "main"] or found
    known = set(found)
    outer = [e for e in found if not any(a in known for a in _chain(e.up))] if len(found) > 1 else found
    article = outer[0] if len(outer) == 1 else None
    if len(outer) > 1:  # among teasers the article has most of the words
        words: Counter = Counter()
        known = set(outer)
        for e, kind, text in events:
            if kind == "text" and (a := next((a for a in _chain(e) if a in known), None)):
                words[a] += len(text.split())
        top, n = words.most_common(1)[0] if words else (None, 0)
        article = top if 2 * n > words.total() else None

    def state(e: Element) -> State:
        if e.state is not None:
            return e.state
        s = State()
        up = state(e.up) if e.up is not None else None
        s.silent = e.hidden or e.tag in SILENT or (up is not None and up.silent)
        s.inside = e is article or (up is not None and up.inside)
        s.link = e.tag == "a" or (up is not None and up.link and e.tag not in BLOCK)
        s.kind = e.tag if e.tag in KINDS and e.tag != "a" else (up.kind if up is not None and (e.tag not in BLOCK or up.kind in KINDS) else "bare")
        s.frame = e if e.tag in BLOCK and e.tag not in _FRAMED else (up.frame if up is not None else None)
        s.worst, s.source = (up.worst, up.source) if up is not None else (0.0, None)
        if not (e.holds or e is article or e.tag in ("html", "body", "#root")):
            for f in containers(e, s.inside):
                if (w := weights.get(f, 0.0)) < min(s.worst, -0.5):
                    s.worst, s.source = w, s.source or e
        e.state = s
        return s

    return article, state


def containers(e: Element, inside: bool) -> list[str]:
    """The features of an element as a container."""
    found = [f".{n}" for n in e.names if not (inside and n in _HEADING)]
    if e.tag in OTHER_TAGS and not (inside and e.tag in _HEADING):
        found.append(e.tag)
    return found


def _place(s: State, article: Element | None) -> str:
    return "open" if article is None else "inside" if s.inside else "outside"


PRIOR = 20  # words that a prior stands for
LEAST, MOST = -3.0, 3.0
_SHARE = {"bare": 0.6, "a": 0.25}  # prior share of article words; 0.85 for blocks of text


def prior_weights() -> dict[str, float]:
    """The weights before any labelled page is seen."""
    return weights_of({})


def _prior(feature: str) -> float:
    if feature in OTHER_TAGS or feature[1:] in OTHER_NAMES:
        return 0.02
    if feature[0] == ".":
        return 0.5
    place, kind, link = feature.split("|")
    share = _SHARE["a"] if link else _SHARE.get(kind, 0.85)
    return min(0.1, share) if place == "outside" else share


def weights_of(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Log-odds of article words by feature, and costs of tags by "<tag" and ">tag": (with, without) counts of labelled pages on
    top of priors, within [LEAST, MOST]. A tag costs the more, the rarer both its sides belong to the article."""
    known = [*OTHER_TAGS, *(f".{n}" for n in OTHER_NAMES), *(f"{p}|{k}|{a}" for p in PLACES for k in (*sorted(KINDS), "bare") for a in ("", "a"))]
    out = {}
    for f in {*known, *counts}:
        yes, no = counts.get(f, (0, 0))
        if f[0] in "<>":
            out[f] = min(12.0, max(0.02, -math.log((yes + 0.74 * PRIOR) / (yes + no + PRIOR))))
        else:
            share = _prior(f)
            out[f] = min(MOST, max(LEAST, math.log((yes + PRIOR * share) / (no + PRIOR * (1 - share)))))
    return out


_TAG_COST = 0.3  # of a block tag that no labelled page has
_DEPTH, _NEAR = 24.0, 3.0  # an element that is something else takes no more than this from the sum, less where text stands in the same frame
def blocks(page: str | None, weights: dict[str, float]) -> list[str]:
    """The text blocks of the region with the highest score: the first such region, white space folded.

    Words score by the kind of their block, links less, and by their place to the page's one article; block tags cost; words
    in a container with a negative weight score that. One linear scan finds the best contiguous region. In it, what such containers
    hold is left out; in an article they don't count against it."""
    events = parse(page or "")
    article, state = _states(events, weights)
    best, best_at, run, start, frame = 0.0, (0, 0), 0.0, 0, None
    spent: dict[int, float] = {}
    for k, (e, kind, text) in enumerate(events):
        s = state(e)
        if s.silent:
            continue
        if s.source is not None and s.inside:
            continue
        if kind == "text":
            n = len(text.split())
            if not n:
                continue
            w = s.worst if s.source is not None else weights.get(f"{_place(s, article)}|{s.kind}|{'a' if s.link else ''}", 0.0)
            gain = w * n
            if s.source is None:
                frame = s.frame
        elif e.tag not in BLOCK:
            continue
        else:
            gain = -weights.get(kind + e.tag, _TAG_COST)
        if s.source is not None:
            near = frame is not None and s.source.up is frame
            left = (_NEAR if near else _DEPTH) + spent.get(id(s.source), 0.0)
            gain = max(gain, min(0.0, -left))
            spent[id(s.source)] = spent.get(id(s.source), 0.0) + gain
        if run <= 0:
            run, start = 0.0, k
        run += gain
        if run > best:
            best, best_at = run, (start, k + 1)
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        if text := " ".join(html.unescape("".join(held)).split()):
            out.append(text)
        held.clear()

    for e, kind, text in events[best_at[0] : best_at[1]]:
        s = state(e)
        if kind != "text":
            if e.tag in BLOCK:
                end()
        elif not s.silent and s.source is None:
            held.append(text)
    end()
    return out


# ---- weights from labelled pages ----


def count_features(page: str | None) -> Counter:
    """Counts of one page that labels itself: with exactly one article, its words against the page's others, by feature.
    Keys are (feature, in the article). Pages without one count nothing."""
    counts: Counter = Counter()
    events = parse(page or "")
    article, state = _states(events, prior_weights())
    if article is None:
        return counts
    before, tags = False, []
    for e, kind, text in events:
        s = state(e)
        if s.silent:
            continue
        if kind != "text":
            if e.tag in BLOCK:
                tags.append(kind + e.tag)
            continue
        if not (n := len(text.split())):
            continue
        good = s.inside and s.source is None
        for t in tags:
            counts[t, good and before] += 1
        before, tags = good, []
        seen = set()
        for up in _chain(e):
            if up.holds or up is article:
                break
            seen.update(containers(up, s.inside))
        for f in seen:
            counts[f, good] += n
        if s.source is None:  # what a container explains says nothing of the kind of block
            link = "a" if s.link else ""
            counts[f"{_place(s, article)}|{s.kind}|{link}", good] += n
            counts[f"open|{s.kind}|{link}", good] += n
    return counts


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    pages: Counter = Counter()
    for b in batches:
        for page in b.column("html"):
            own = count_features(page.as_py())
            total.update(own)
            pages.update({f for f, _ in own})
    rows = [(f, total[f, True], total[f, False], pages[f]) for f in pages]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["feature", "yes", "no", "pages"])
    release()


def fit_weights(pages: DataFrame, *, sample: int = 2000, least_pages: int = 5, most_features: int = 4096) -> dict[str, float]:
    """Weights from about `sample` pages, drawn by a hash of what they hold (copies count once); those with exactly one article label
    themselves. A name counts from `least_pages` of them on, and the `most_features` most frequent features are kept."""
    total = pages.count()
    if not total:
        return prior_weights()
    rows = pages.select(F.col("html").cast("string").alias("html")).withColumn("_at", F.xxhash64("html"))
    drawn = rows.where(F.pmod("_at", F.lit(1 << 20)) < F.lit(math.ceil((1 << 20) * min(1.0, sample / total))))
    once = drawn.groupBy("_at").agg(F.first("html").alias("html")).select("html")
    counts = once.mapInArrow(_count, "feature string, yes long, no long, pages long")
    counts = counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("yes", "no", "pages")]).where(F.col("pages") >= least_pages)
    kept = counts.orderBy(F.col("pages").desc(), "feature").limit(most_features).collect()
    return weights_of({r.feature: (r.yes, r.no) for r in kept})


def _extract(weights: dict[str, float]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [" ".join(blocks(page.as_py(), weights)) for page in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])
        release()

    return run


def main_text(pages: DataFrame, weights: dict[str, float] | None = None, **fit) -> DataFrame:
    """One row a page: page_id, url, text (the article's blocks in page order, joined by one space), n_chars.

    Character references are decoded, white space inside a block becomes one space. A null or empty page, or one without text that
    scores, has an empty text. Each row is judged by itself: repeated rows give repeated rows, a null page_id or url stays. Columns
    other than page_id, url and html are ignored. Without weights they are fitted on these pages, see fit_weights. A page
    must fit in memory a few times.
    """
    weights = fit_weights(pages, **fit) if weights is None else weights
    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    found = rows.mapInArrow(_extract(weights), f"{kinds[0]}, {kinds[1]}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
