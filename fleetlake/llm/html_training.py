"""Generated pages with labelled elements, to fit the extractor on.

An element is written with a label: part of the article or not. Labels follow the page's
elements in order, as the reader numbers them.
"""

from __future__ import annotations

import random

import numpy as np

_ARTICLE = ("article", "post-content", "entry", "content", "story-body", "main-text", "c12", "wrap", "")
_PARTS = {
    "menu": ("nav", "menu", "navbar", "topnav", "links", "x3", ""),
    "ad": ("ad", "ads", "advert", "sponsored", "banner", "promo", "box7", ""),
    "notice": ("notice", "cookie-notice", "alert", "consent", "message", "bar"),
    "sidebar": ("sidebar", "side", "widget", "related", "popular", "col2"),
    "comments": ("comments", "discussion", "replies", "responses", "comment-list"),
    "share": ("share", "social", "tags", "subscribe", "pager"),
}


class _Writer:
    def __init__(self, rng: random.Random) -> None:
        self.rng, self.out, self.labels = rng, [], [1]  # the page itself

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        n = rng.randint(low, high)
        text = []
        for i in range(n):
            word = "".join(rng.choice("aeioustrnlmdkpé") for _ in range(rng.randint(1, 9)))
            text.append(word + (rng.choice(".,") if rng.random() < 0.12 else ""))
        return " ".join(text).capitalize() + (rng.choice(".?!.") if n > 6 else "")

    def open(self, tag: str, label: int, attributes: str = "") -> None:
        self.labels.append(label)
        self.out.append(f"<{tag}{' ' + attributes if attributes else ''}>")

    def leaf(self, tag: str, label: int, text: str, attributes: str = "") -> None:
        self.open(tag, label, attributes)
        self.out.append(f"{text}</{tag}>")

    def named(self, part: str) -> str:
        name = self.rng.choice(_PARTS[part])
        return f'{self.rng.choice(("class", "id"))}="{name}"' if name else ""

    def menu(self) -> None:
        rng = self.rng
        tag = rng.choice(("nav", "nav", "div", "ul"))
        self.open(tag, 0, self.named("menu"))
        listed = tag != "ul" and rng.random() < 0.7
        if listed:
            self.open("ul", 0)
        for _ in range(rng.randint(3, 12)):
            if listed or tag == "ul":
                self.open("li", 0)
            self.leaf("a", 0, self.words(1, 3), 'href="/x"')
            if listed or tag == "ul":
                self.out.append("</li>")
        self.out.append(("</ul>" if listed else "") + f"</{tag}>")

    def box(self, part: str) -> None:
        rng = self.rng
        tag = {"sidebar": rng.choice(("aside", "div")), "comments": rng.choice(("section", "div"))}.get(part, "div")
        self.open(tag, 0, self.named(part) or ('class="ad"' if part == "ad" else ""))
        if part == "ad" and rng.random() < 0.6 or part == "notice" and rng.random() < 0.5:
            self.out.append(self.words(3, 25))
        else:
            if rng.random() < 0.5:
                self.leaf(rng.choice(("h3", "h4", "b")), 0, self.words(1, 4))
            for _ in range(rng.randint(1, 5)):
                if part in ("comments", "notice", "ad"):
                    self.open("div", 0, 'class="reply"' if part == "comments" and rng.random() < 0.5 else "")
                    self.leaf("p", 0, self.words(4, 40))
                    if rng.random() < 0.4:
                        self.leaf("a", 0, self.words(1, 2), 'href="#"')
                    self.out.append("</div>")
                else:
                    self.leaf("a", 0, self.words(2, 8), 'href="/y"')
                    if rng.random() < 0.3:
                        self.leaf("p", 0, self.words(4, 15))
        self.out.append(f"</{tag}>")

    def form(self) -> None:
        self.open("form", 0, 'action="/s"')
        if self.rng.random() < 0.6:
            self.leaf("label", 0, self.words(1, 5))
        self.open("input", 0, 'type="text"')
        self.leaf("button", 0, self.words(1, 2))
        self.out.append("</form>")

    def header(self) -> None:
        tag = self.rng.choice(("header", "div"))
        self.open(tag, 0, 'class="header"' if tag == "div" else "")
        self.leaf(self.rng.choice(("a", "div", "h2", "p")), 0, self.words(1, 6))
        if self.rng.random() < 0.6:
            self.menu()
        self.out.append(f"</{tag}>")

    def footer(self) -> None:
        tag = self.rng.choice(("footer", "footer", "div"))
        self.open(tag, 0, 'class="footer"' if tag == "div" else "")
        if self.rng.random() < 0.5:
            self.leaf("p", 0, "&copy; " + self.words(3, 20))
        else:
            self.out.append("&copy; host.example &middot; " + self.words(3, 20))
        self.out.append(f"</{tag}>")

    def article(self) -> None:
        rng = self.rng
        tag = rng.choice(("article", "article", "main", "div", "div", "section"))
        name = rng.choice(_ARTICLE)
        self.open(tag, 1, f'class="{name}"' if name else "")
        if rng.random() < 0.9:
            wrapped = rng.random() < 0.15
            if wrapped:
                self.open("header", 1)
            self.leaf(rng.choice(("h1", "h1", "h2")), 1, self.words(2, 14))
            if wrapped:
                self.out.append("</header>")
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.6:
                self.open("p", 1)
                self.out.append(self.words(1, 120) if rng.random() < 0.8 else self.words(1, 3))
                for inline in ("a", "b", "em"):
                    if rng.random() < 0.15:
                        self.leaf(inline, 1, self.words(1, 4), 'href="/z"' if inline == "a" else "")
                        self.out.append(" " + self.words(1, 20))
                self.out.append("</p>")
            elif kind < 0.7:
                self.open("p", 1)
                self.open("b", 1)
                self.out.append(self.words(3, 60))
                self.open("br", 1)
            elif kind < 0.78:
                self.leaf(rng.choice(("h2", "h3")), 1, self.words(1, 8))
            elif kind < 0.84:
                self.open(rng.choice(("ul", "ol")), 1)
                for _ in range(rng.randint(2, 6)):
                    self.leaf("li", 1, self.words(2, 25))
                self.out.append("</ul></ol>")
            elif kind < 0.88:
                self.leaf("blockquote", 1, self.words(8, 50))
            elif kind < 0.91:
                self.open("table", 1)
                for _ in range(rng.randint(1, 4)):
                    self.open("tr", 1)
                    for _ in range(3):
                        self.leaf("td", 1, self.words(1, 6))
                    self.out.append("</tr>")
                self.out.append("</table>")
            elif kind < 0.94:
                self.box("ad")
            elif kind < 0.96:
                self.box("share")
            elif kind < 0.98:
                self.leaf("script", 0, "var x = 1;")
            else:
                self.form()
        if rng.random() < 0.1:
            self.box("comments")
        self.out.append(f"</{tag}>")

    def page(self) -> str:
        rng = self.rng
        self.out.append("<!DOCTYPE html>")
        self.open("html", 1)
        self.open("head", 0)
        self.leaf("title", 0, self.words(2, 10))
        if rng.random() < 0.7:
            self.leaf("style", 0, "p{margin:0}")
        if rng.random() < 0.7:
            self.leaf("script", 0, "track(0);")
        self.out.append("</head>")
        self.open("body", 1)
        depth = rng.choice((0, 0, 1, 2))
        if rng.random() < 0.6:
            self.header()
        for _ in range(depth):
            self.open("div", 1, rng.choice(("", 'class="page"', 'id="wrap"')))
        before = [lambda: self.menu(), lambda: self.box("ad"), lambda: self.box("notice"), self.form, lambda: self.box("sidebar")]
        after = [lambda: self.box("sidebar"), lambda: self.box("comments"), lambda: self.box("share"), lambda: self.box("ad"), self.form]
        for make in rng.sample(before, rng.randint(0, 3)):
            make()
        self.article()
        for make in rng.sample(after, rng.randint(0, 3)):
            make()
        self.out.append("</div>" * depth)
        if rng.random() < 0.8:
            self.footer()
        self.out.append("</body></html>")
        return "".join(self.out)


def labelled_pages(n: int, seed: int = 11) -> tuple[list[str], list[np.ndarray]]:
    rng = random.Random(seed)
    pages, labels = [], []
    for _ in range(n):
        writer = _Writer(rng)
        pages.append(writer.page())
        labels.append(np.array(writer.labels))
    return pages, labels
