"""Training pages: blocks of given text laid out in varied page designs, main text marked.

Elements of the main text carry ``data-main``; the classifier never sees that mark.
"""

from __future__ import annotations

import html
import random

from feescope.llm.html_dom import TOKEN_GROUPS

TAGS = {"menu": ("nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"), "sidebar": ("aside", "div"),
        "notice": ("div", "section"), "advert": ("div", "aside", "section"), "form": ("form", "div"),
        "comments": ("section", "div", "ol"), "related": ("div", "section", "ul")}
PLAIN = ("box", "row", "col", "wrap", "inner", "grid", "block", "module", "c1", "css-x7", "region", "item")


class Layout:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.named = rng.random() < 0.8     # classes say what things are
        self.semantic = rng.random() < 0.6  # HTML5 elements do
        self.unclosed = rng.random() < 0.4

    def attrs(self, kind: str | None) -> str:
        r = self.rng
        if kind and self.named and r.random() < 0.9:
            word = r.choice(TOKEN_GROUPS[kind].split())
            value = r.choice((word, f"{word}-{r.choice(PLAIN)}", f"site-{word}", f"{r.choice(PLAIN)} {word}", word.capitalize() + "Box"))
            return f' {r.choice(("class", "class", "id"))}="{value}"'
        return f' class="{r.choice(PLAIN)}"' if r.random() < 0.4 else ""

    def element(self, kind: str, inner: str) -> str:
        tags = TAGS[kind]
        tag = tags[0] if self.semantic and self.rng.random() < 0.8 else "div"
        if tag == "div" or self.rng.random() < 0.6:
            return f"<{tag}{self.attrs(kind)}>{inner}</{tag}>"
        return f"<{tag}>{inner}</{tag}>"

    def words(self, text: str, n: int) -> str:
        w = text.split()
        k = self.rng.randrange(max(1, len(w) - n + 1))
        return html.escape(" ".join(w[k:k + n]), quote=False)

    def links(self, blocks: list[str]) -> str:
        r = self.rng
        items = [f'<a href="/{i}">{self.words(r.choice(blocks), r.randint(1, 4))}</a>' for i in range(r.randint(3, 12))]
        form = r.random()
        if form < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return r.choice((" | ", " ", " &middot; ")).join(items) if form < 0.85 else "".join(f"<div>{x}</div>" for x in items)

    def prose(self, blocks: list[str], n: int) -> str:
        return "".join(f"<p>{html.escape(self.rng.choice(blocks), quote=False)}</p>" for _ in range(n))

    def boilerplate(self, kind: str, blocks: list[str]) -> str:
        r = self.rng
        some = lambda a, b: self.words(r.choice(blocks), r.randint(a, b))
        if kind == "menu":
            inner = self.links(blocks)
        elif kind == "header":
            inner = r.choice((f"<div>{some(1, 4)}</div>", f'<a href="/">{some(1, 3)}</a>', f"<p>{some(2, 8)}</p>"))
            inner += self.links(blocks) if r.random() < 0.3 else ""
        elif kind == "footer":
            inner = r.choice((f"&copy; {some(1, 4)} &middot; {some(2, 30)}", f"<p>&copy; 2024 {some(2, 9)}</p>" + self.links(blocks),
                              some(3, 30), f"<p>{some(4, 40)}</p>"))
        elif kind == "notice":
            inner = f"<p>{some(5, 40)}</p><button>{some(1, 2)}</button>" if r.random() < 0.6 else some(5, 40)
        elif kind == "advert":
            inner = r.choice((some(3, 40), f"<p>{some(5, 40)}</p>", f'<a href="/x">{some(3, 20)}</a>',
                              html.escape(r.choice(blocks), quote=False)))
        elif kind == "form":
            inner = f"<label>{some(1, 4)}</label><input><button>{some(1, 2)}</button>"
        elif kind == "comments":
            each = [f"<div{self.attrs('comments')}><b>{some(1, 2)}</b>{self.prose(blocks, r.randint(1, 2))}</div>" for _ in range(r.randint(1, 5))]
            inner = (f"<h3>{some(1, 3)}</h3>" if r.random() < 0.6 else "") + "".join(each)
        else:
            inner = f"<h3>{some(1, 4)}</h3>" * (r.random() < 0.5) + self.links(blocks)
            if kind == "sidebar" and r.random() < 0.5:
                inner += f"<p>{some(4, 40)}</p>"
        return self.element(kind, inner)

    def article(self, main: list[str], blocks: list[str]) -> str:
        r = self.rng
        out = []
        if r.random() < 0.8:
            title = main[0] if r.random() < 0.3 else " ".join(main[0].split()[:r.randint(3, 12)])
            out.append(f'<h1 data-main>{html.escape(title, quote=False)}</h1>')
        for t in main:
            e, form = html.escape(t, quote=False), r.random()
            if form < 0.06:
                out.append(f'<h2 data-main>{self.words(t, r.randint(1, 6))}</h2>')
            if form < 0.10:
                parts = t.split(". ")
                out.append("<ul data-main>" + "".join(f"<li data-main>{html.escape(x, quote=False)}</li>" for x in parts if x.strip()) + "</ul>")
            elif form < 0.14:
                out.append(f"<blockquote data-main>{e}</blockquote>")
            elif form < 0.24 and self.unclosed:
                out.append(f"<p data-main><b>{e}<br>")
            elif form < 0.30 and len(t.split()) > 3:
                w = e.split()
                out.append(f'<p data-main>{" ".join(w[:2])} <a href="/y">{w[2]}</a> {" ".join(w[3:])}</p>')
            else:
                out.append(f"<p data-main>{e}</p>")
            if r.random() < 0.05:
                out.append(self.boilerplate(r.choice(("advert", "related", "form", "notice")), blocks))
        tag = "article" if self.semantic and r.random() < 0.7 else r.choice(("div", "div", "section", "main"))
        tail = self.boilerplate("related", blocks) if r.random() < 0.2 else ""
        return f'<{tag}{self.attrs("content")} data-main>{"".join(out)}{tail}</{tag}>'

    def page(self, main: list[str], blocks: list[str]) -> str:
        r = self.rng
        part = lambda kind, p: self.boilerplate(kind, blocks) if r.random() < p else ""
        middle = part("menu", 0.1) + part("advert", 0.3) + self.article(main, blocks) + part("comments", 0.35) + part("advert", 0.2)
        middle = part("sidebar", 0.2) + middle + part("sidebar", 0.3)
        for _ in range(r.randrange(3)):
            middle = f"<div{self.attrs(None)}>{middle}</div>"
        body = (part("notice", 0.2) + part("header", 0.5) + part("menu", 0.75) + part("form", 0.15) + middle
                + part("related", 0.3) + part("form", 0.15) + part("footer", 0.85) + part("notice", 0.15))
        end = "</body></html>" if r.random() < 0.8 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(main[0], 6)}</title></head><body>{body}{end}"
