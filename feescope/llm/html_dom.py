"""A small tolerant HTML reader: block elements, text runs and the features of both."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

# ---- fixed values of the HTML language
TO_THE_END = frozenset("script style title textarea xmp".split())  # unclosed ones take the rest of the page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe svg select canvas noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br input noscript object math semantics mrow mi mn mo ms mtext mspace msup msub "
    "msubsup mmultiscripts mprescripts none mfrac msqrt mroot mover munder munderover mfenced menclose mstyle mpadded mphantom "
    "merror maction mtable mtr mtd".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul xmp".split())
CLOSED_BY_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                  "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div body td th".split())  # an implied end tag doesn't leave these

# ---- words in class, id, role and aria-label that tell what an element is for
TOKEN_GROUPS = {
    "content": "article content main post entry story text body prose page",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topnav sitemap dropdown",
    "header": "header masthead topbar logo head branding",
    "footer": "footer copyright legal colophon bottom foot contentinfo",
    "sidebar": "sidebar side rail widget secondary aside complementary",
    "notice": "cookie cookies consent notice gdpr popup modal alert overlay banner privacy warning",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense dfp",
    "form": "form search searchbox login signup subscribe newsletter register contact",
    "comments": "comment comments reply replies respond disqus discussion thread reader responses",
    "related": "related recommended recommendations more popular trending share sharing social tags pagination pager links",
    "hidden": "hidden none invisible sr visually offscreen",
}
GROUP_NAMES = list(TOKEN_GROUPS)
GROUP_OF = {w: 1 << i for i, ws in enumerate(TOKEN_GROUPS.values()) for w in ws.split()}
TAG_GROUPS = ("p", "h1 h2 h3 h4 h5 h6", "div", "section", "article main", "nav menu", "header hgroup", "footer", "aside",
              "form fieldset button legend details summary dialog", "ul ol dl", "li dt dd",
              "table tbody thead tfoot tr td th caption", "figure figcaption", "blockquote pre address", "body html", "#run")
TAG_OF = {t: i for i, ts in enumerate(TAG_GROUPS) for t in ts.split()}
OTHER_TAG = len(TAG_GROUPS)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)|([^<]+|<)", re.S)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I | re.A) for t in RAW | {"xmp"}}
TAG_STOP = re.compile(r">|=\s*+([\"'])")
ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role|aria-label|aria-hidden|style|hidden|data-main)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"[a-zA-Z][a-z]*|[A-Z]+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Dom:
    """Block elements and text runs in page order; a parent comes before its children."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    groups: list[int] = field(default_factory=list)   # bits of TOKEN_GROUPS
    main: list[bool] = field(default_factory=list)     # marked as main text (training pages only)
    text: list[str] = field(default_factory=list)      # of runs, white space as single blanks
    linked: list[int] = field(default_factory=list)    # characters of a run inside links
    tags: list[int] = field(default_factory=list)      # tags opened in the element itself, inline ones included
    controls: list[int] = field(default_factory=list)  # input fields and buttons

    def add(self, parent: int, tag: str, groups: int = 0, main: bool = False) -> int:
        for column, value in ((self.parent, parent), (self.tag, tag), (self.groups, groups), (self.main, main),
                              (self.text, ""), (self.linked, 0), (self.tags, 0), (self.controls, 0)):
            column.append(value)
        return len(self.tag) - 1


def attribute_groups(attrs: str) -> tuple[int, bool]:
    """(token group bits, data-main mark) of a start tag's attributes."""
    bits, main = 0, False
    for name, value in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "data-main":
            main = True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDING.search(value):
            bits |= GROUP_OF["hidden"]
        elif name in ("class", "id", "role", "aria-label"):
            for w in WORD.findall(value):
                bits |= GROUP_OF.get(w.lower(), 0)
    return bits, main


class TagEnds:
    """Finds the ``>`` of tags: past quoted attribute values of any length, or the first one if a
    quote or the tag isn't closed.  What was found to lead nowhere is not searched again."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.unclosed = {'"': len(page), "'": len(page)}
        self.dead: set[int] = set()

    def find(self, at: int) -> int:
        """Place of the ``>`` of the tag whose name ends at ``at``, or -1."""
        if at > self.last:
            return -1
        i, passed = at, []
        while i <= self.last and i not in self.dead:
            m = TAG_STOP.search(self.page, i)
            if m[1] is None:
                return m.start()
            k = self.page.find(m[1], m.end()) if m.end() < self.unclosed[m[1]] else -1
            if k < 0:
                self.unclosed[m[1]] = min(self.unclosed[m[1]], m.end())
                break
            i = k + 1
            passed.append(i)
        self.dead.update(passed)
        return self.page.find(">", at)


def parse(page: str) -> Dom:
    """The page's blocks.  Unclosed, misnested and missing tags are tolerated; markup in comments,
    scripts, styles and other raw elements is left out.  Formulas, objects and noscript parts are read like
other elements; the content of xmp is plain text."""
    dom = Dom()
    root = dom.add(-1, "body")
    stack: list[tuple[str, int]] = [("body", root)]  # (tag, node); inline elements share their block's node
    run: list[str] = []
    linked = links = 0
    at, end, tag_ends = 0, len(page), TagEnds(page)
    never_closed: set[str] = set()
    is_open: Counter[str] = Counter()  # elements on the stack by tag: what isn't there is not searched for

    def close_run() -> None:
        nonlocal linked
        if run:
            t = " ".join("".join(run).split())
            run.clear()
            if t:
                i = dom.add(stack[-1][1], "#run")
                dom.text[i], dom.linked[i] = t, min(linked, len(t))
        linked = 0

    def raw_end(tag: str) -> tuple[int, int]:
        """(end of a raw element's content, place after its end tag); (-1, -1) if there is no end tag."""
        m = None if tag in never_closed else RAW_END[tag].search(page, at)
        if not m:
            never_closed.add(tag)
            return -1, -1
        stop = page.find(">", m.end())
        return m.start(), end if stop < 0 else stop + 1

    def pop_to(k: int) -> None:
        nonlocal links
        if any(t not in INLINE for t, _ in stack[k:]):
            close_run()
        for t, _ in stack[k:]:
            is_open[t] -= 1
        links -= sum(t == "a" for t, _ in stack[k:])
        del stack[k:]

    def push(tag: str, node: int) -> None:
        stack.append((tag, node))
        is_open[tag] += 1

    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        if m[2]:
            stop = tag_ends.find(at)
            at = m.start() + 1 if stop < 0 else stop + 1
        if m[3] is not None or m[2] and stop < 0:
            t = m[3] or "<"
            t = html.unescape(t) if "&" in t else t
            run.append(t)
            if links:
                linked += len(t.strip())
            continue
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), page[m.end():stop]
        if m[1]:  # an end tag closes its element if that is open
            for k in range(len(stack) - 1, 0, -1) if is_open[tag] else ():
                if stack[k][0] == tag:
                    pop_to(k)
                    break
                if tag in INLINE and tag != "a" and stack[k][0] not in INLINE:
                    break  # a misplaced inline end tag leaves blocks open
            continue
        if tag in RAW:
            k, after = raw_end(tag)
            if k >= 0:
                at = after
            elif tag in TO_THE_END:
                at = end
            dom.tags[stack[-1][1]] += 1
            if tag in ("select", "textarea"):
                dom.controls[stack[-1][1]] += 1
            continue
        if tag == "html" or tag == "body" or tag == "head":
            bits, _ = attribute_groups(attrs)
            dom.groups[root] |= bits
            continue
        if tag in CLOSES_P and is_open["p"]:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == "p" or stack[k][0] in SCOPE), 0)
            if k and stack[k][0] == "p":
                pop_to(k)
        if tag in CLOSED_BY_LIKE:
            like = CLOSED_BY_LIKE[tag]
            for k in range(len(stack) - 1, 0, -1) if any(is_open[t] for t in like) else ():
                if stack[k][0] in like:
                    pop_to(k)
                    if tag != "tr":
                        break
                elif stack[k][0] in SCOPE:
                    break
        here = stack[-1][1]
        dom.tags[here] += 1
        if tag in ("input", "button"):
            dom.controls[here] += 1
        if tag == "br":
            run.append("\n")
        if tag in VOID:
            if tag == "hr":
                close_run()
            continue
        if tag in INLINE:
            if tag == "a":
                links += 1
            push(tag, here)
            continue
        close_run()
        bits, main = attribute_groups(attrs)
        push(tag, dom.add(here, tag, bits, main))
        if tag == "xmp":
            k, after = raw_end(tag)
            t = page[at:k] if k >= 0 else page[at:]
            run.append(t)
            if links:
                linked += len(t.strip())
            at = after if k >= 0 else end
            close_run()
            pop_to(len(stack) - 1)
    close_run()
    return dom


# ---------------------------------------------------------------- features

FEATURES = (
    ["depth", "position", "children", "log_text", "text_share", "link_density", "text_per_tag", "runs", "mean_run", "longest_run",
     "punctuation", "sentence_ends", "digits", "controls", "sibling_place", "siblings", "siblings_text", "siblings_links",
     "like_siblings", "before_text", "after_text", "parent_text", "parent_share", "parent_links", "parent_runs", "parent_mean_run",
     "prose_share", "prose_below", "headings_below", "prose_siblings"]
    + [f"tag_{i}" for i in range(OTHER_TAG + 1)] + [f"own_{g}" for g in GROUP_NAMES]
    + [f"above_{g}" for g in GROUP_NAMES] + [f"above_tag_{i}" for i in range(OTHER_TAG + 1)] + [f"parent_{g}" for g in GROUP_NAMES])


def features(doms: list[Dom]) -> np.ndarray:
    """(nodes of all pages, features): subtree density, attribute tokens, depth and sibling statistics.

    The pages are handled as one forest; no value depends on the other pages.
    """
    sizes = [len(d.tag) for d in doms]
    start = np.cumsum([0, *sizes])
    n = int(start[-1])
    page = np.repeat(np.arange(len(doms)), sizes)
    root = start[page]
    local = np.concatenate([np.array(d.parent) for d in doms])
    is_root = local < 0
    up = np.where(is_root, root, local + root)  # a root is its own parent
    texts = [t for d in doms for t in d.text]
    chars = np.fromiter(map(len, texts), float, n)
    tag = np.fromiter((TAG_OF.get(t, OTHER_TAG) for d in doms for t in d.tag), np.int64, n)
    groups = np.concatenate([np.array(d.groups) for d in doms])
    depths: list[int] = []
    for d in doms:
        mine: list[int] = []
        for j in d.parent:
            mine.append(mine[j] + 1 if j >= 0 else 0)
        depths += mine
    depth = np.array(depths)
    run = chars > 0
    prose = run & (chars >= 80)
    marks = np.zeros((n, 3))
    for i in np.nonzero(run)[0].tolist():
        t = texts[i]
        marks[i] = t.count(",") + t.count(";") + t.count(":"), t[-1] in ".!?\"'\u00bb\u201d", len(DIGITS.findall(t))
    total = np.stack([chars, np.concatenate([np.array(d.linked, float) for d in doms]),
                      np.concatenate([np.array(d.tags, float) for d in doms]), run.astype(float), *marks.T,
                      np.concatenate([np.array(d.controls, float) for d in doms]), prose * chars, (tag == 0).astype(float),
                      (tag == 1).astype(float)], 1)
    longest = chars.copy()
    levels = [np.nonzero(depth == k)[0] for k in range(int(depth.max(initial=0)) + 1)]
    for at in reversed(levels[1:]):
        np.add.at(total, up[at], total[at])
        np.maximum.at(longest, up[at], longest[at])
    above_groups, above_tags, bit = np.zeros(n, np.int64), np.zeros(n, np.int64), 1 << tag
    for at in levels[1:]:
        above_groups[at] = above_groups[up[at]] | groups[up[at]]
        above_tags[at] = above_tags[up[at]] | bit[up[at]]
    text, link, tags, runs = total[:, 0], total[:, 1], total[:, 2] + 1, np.maximum(total[:, 3], 1)
    whole = np.maximum(text[root], 1.0)
    cum = np.concatenate(([0.0], np.cumsum(chars)[:-1]))
    before = cum - cum[root]
    # siblings: children of one parent, in page order
    parent = np.where(is_root, -1 - page, up)
    order = np.lexsort((np.arange(n), parent))
    sp = parent[order]
    first = np.concatenate(([True], sp[1:] != sp[:-1]))
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    place, left, right = np.zeros(n), np.zeros(n), np.zeros(n)
    place[order] = np.arange(n) - head
    inner = ~is_root
    count = np.bincount(up[inner], minlength=n).astype(float)
    size = np.where(is_root, 0, count[up])
    t = text[order]
    left[order] = np.where(first, 0, np.concatenate(([0], t[:-1])))
    right[order] = np.where(np.concatenate((first[1:], [True])), 0, np.concatenate((t[1:], [0])))
    _, which, times = np.unique(parent * (OTHER_TAG + 1) + tag, return_inverse=True, return_counts=True)
    alike = times[which.ravel()]
    below_p = np.bincount(up[inner], (tag == 0)[inner], n)
    logs = np.log1p
    base = np.stack([
        depth, before / whole, count, logs(text), text / whole, link / np.maximum(text, 1), text / tags, logs(runs), logs(text / runs),
        logs(longest), total[:, 4] / np.maximum(text, 1) * 100, total[:, 5] / runs, total[:, 6] / np.maximum(text, 1), total[:, 7],
        place / np.maximum(size, 1), logs(size), logs(np.maximum(text[up] - text, 0) / np.maximum(size - 1, 1)),
        link[up] / np.maximum(text[up], 1), alike, logs(left), logs(right), logs(text[up]), text[up] / whole,
        link[up] / np.maximum(text[up], 1), logs(runs[up]), logs(text[up] / runs[up]), total[:, 8] / np.maximum(text, 1),
        logs(total[:, 9]), total[:, 10], below_p[up]], 1)
    onehot = np.zeros((n, OTHER_TAG + 1))
    onehot[np.arange(n), tag] = 1
    k = np.arange(len(GROUP_NAMES))
    bits = lambda v, k: ((v[:, None] >> k) & 1).astype(float)
    return np.concatenate([base, onehot, bits(groups, k), bits(above_groups, k),
                           bits(above_tags, np.arange(OTHER_TAG + 1)), bits(groups[up], k)], 1)


def decode(dom: Dom, probability: np.ndarray) -> np.ndarray:
    """Mask of kept nodes of the likeliest consistent choice.

    A node that is left out takes all below it along, and an element is only
    kept with at least one kept run below.  Two sums per node (kept, left out)
    are added from the leaves up; the choice is read from the root down.
    """
    n = len(dom.tag)
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = np.log(p).tolist(), np.log1p(-p).tolist()
    best = [0.0] * n               # sum over children of the better of kept and left out
    least = [float("inf")] * n     # what keeping one child costs if none would be kept
    some = [False] * n
    parent, run = dom.parent, [bool(t) for t in dom.text]
    inf = float("inf")
    for i in range(n - 1, -1, -1):
        if run[i]:
            k = keep[i]
        elif some[i]:
            k = keep[i] + best[i]
        else:
            k = keep[i] + best[i] - least[i] if least[i] < inf else -inf
        keep[i] = k
        j = parent[i]
        if j >= 0:
            drop[j] += drop[i]
            if k > drop[i]:
                best[j] += k
                some[j] = True
            else:
                best[j] += drop[i]
                least[j] = min(least[j], drop[i] - k)
    out = np.zeros(n, bool)
    forced = {}
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        kids[parent[i]].append(i)
    for i in range(n):
        j = parent[i]
        if j >= 0 and not out[j]:
            continue
        out[i] = keep[i] > drop[i] or forced.get(j) == i
        if out[i] and not run[i] and not some[i]:
            forced[i] = min(kids[i], key=lambda c: drop[c] - keep[c])
    return out


def main_text(dom: Dom, kept: np.ndarray) -> str:
    return "\n".join(t for t, k in zip(dom.text, kept) if k and t)
