"""Labelled pages for fitting the extraction model.

A page is put together from parts in many layouts; the root of the article
carries ``data-y="1"``, parts inside it that don't belong to it ``data-y="0"``.
The mark is no feature. How many pages are made is the parameter that bounds
the sample.
"""

from __future__ import annotations

import random

_SYLLABLES = "an be ca do el fi go ha in jo ka lu mi no or pe qui ra so tu un ve wo xi ya zo ment tion ing er ist".split()


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        ws = ["".join(r.choices(_SYLLABLES, k=r.choice((1, 1, 2, 2, 3)))) for _ in range(r.randint(lo, hi))]
        return " ".join(w + (r.choice((".", ",")) if r.random() < 0.15 else "") for w in ws).capitalize()

    def pick(self, *options: str) -> str:
        return self.r.choice(options)

    def link(self, lo=1, hi=3) -> str:
        return f'<a href="/x">{self.words(lo, hi)}</a>'

    def menu(self) -> str:
        items = "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(2, 9)))
        open_ = self.pick("<nav>", '<nav class="menu">', '<div class="navbar">', '<div id="menu" role="navigation">', '<ul class="breadcrumb">')
        tag = open_[1:].split(">")[0].split()[0]
        return f"{open_}<ul>{items}</ul></{tag}>"

    def header(self) -> str:
        tag, a = self.pick("header ", 'div class="header"', 'div id="masthead"', 'div class="topbar"').split(" ", 1)
        inner = self.pick("", self.menu(), f'<div class="logo">{self.link()}</div>', f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(2, 8)}</p>")
        return f"<{tag} {a}>{inner}{self.pick('', self.menu())}</{tag}>"

    def footer(self) -> str:
        tag, a = self.pick("footer ", 'div class="footer"', 'div id="bottom"', 'section class="copyright"').split(" ", 1)
        return f"<{tag} {a}>{self.pick('&copy; ', '')}{self.words(2, 25)}{self.pick('', self.link(), '<p>' + self.words(4, 20) + '</p>')}</{tag}>"

    def advert(self, inside: bool = False) -> str:
        mark = ' data-y="0"' if inside else ""
        a = self.pick('class="ad"', 'class="ad"', 'id="ad-1"', 'class="sponsored"', 'class="promo banner"', 'class="advertisement"')
        body = self.pick(self.words(3, 30), f"<p>{self.words(3, 30)}</p>", self.link(3, 8))
        tag = self.pick("div", "div", "section", "aside")
        return f"<{tag} {a}{mark}>{body}</{tag}>"

    def notice(self, inside: bool = False) -> str:
        mark = ' data-y="0"' if inside else ""
        a = self.pick('class="cookie-notice"', 'role="alert"', 'id="consent"', 'class="notice"', 'class="popup"', 'class="newsletter"')
        return f"<div {a}{mark}><p>{self.words(4, 30)}</p>{self.pick('', self.link())}</div>"

    def side(self, inside: bool = False) -> str:
        mark = ' data-y="0"' if inside else ""
        tag, a = self.pick("aside ", 'div class="sidebar"', 'div class="related"', 'div class="widget"', 'section class="popular"').split(" ", 1)
        body = self.pick(self.words(4, 40), "<ul>" + "".join(f"<li>{self.link(2, 7)}</li>" for _ in range(self.r.randint(2, 7))) + "</ul>", f"<h3>{self.words(1, 3)}</h3><p>{self.words(5, 40)}</p>")
        return f"<{tag} {a}{mark}>{body}</{tag}>"

    def form(self, inside: bool = False) -> str:
        mark = ' data-y="0"' if inside else ""
        a = self.pick("", 'class="search"', 'id="login"', 'class="signup"')
        return f"<form {a}{mark}><label>{self.words(1, 4)}</label><input name=q><p>{self.words(1, 15)}</p></form>"

    def comments(self, inside: bool = False) -> str:
        mark = ' data-y="0"' if inside else ""
        tag, a = self.pick('section id="comments"', 'div class="comments"', 'div class="comment-list"', 'section class="discussion"', 'div id="respond"').split(" ", 1)
        one = lambda: self.pick(f'<div class="comment"><p>{self.words(3, 60)}</p></div>', f"<p>{self.words(3, 60)}</p>", f"<li>{self.words(3, 50)}</li>")
        return f"<{tag} {a}{mark}>{self.pick('', '<h3>' + self.words(1, 3) + '</h3>')}{''.join(one() for _ in range(self.r.randint(1, 6)))}</{tag}>"

    def paragraph(self) -> str:
        r = self.r
        size = r.choice(((2, 12), (15, 60), (30, 120), (30, 120)))
        text = self.words(*size)
        if r.random() < 0.2:
            tag = self.pick("b", "em", "span")
            text += f" <{tag}>{self.words(1, 5)}</{tag}> {self.words(2, 10)}"
        if r.random() < 0.15:
            text += f" {self.link()} {self.words(1, 10)}"
        kind = r.random()
        if kind < 0.08:
            return f"<ul>{''.join(f'<li>{self.words(2, 20)}</li>' for _ in range(r.randint(2, 5)))}</ul>"
        if kind < 0.14:
            tag = self.pick("h2", "h3")
            return f"<{tag}>{self.words(2, 8)}</{tag}>"
        if kind < 0.18:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.21:
            return f"<table><tr><td>{self.words(1, 5)}</td><td>{self.words(1, 5)}</td></tr></table>"
        if kind < 0.24:
            return f"<pre>{text}</pre>"
        if kind < 0.28:
            return f"<div>{text}</div>"
        return f"<p><b>{text}<br>" if r.random() < 0.12 else f"<p>{text}</p>"

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{self.words(2, 12)}</h1>"] if r.random() < 0.8 else []
        parts += [self.paragraph() for _ in range(r.choice((1, 1, 2, 3, 4, 6, 10, 18)))]
        for part in (self.advert, self.side, self.notice, self.form):
            for _ in range(r.choice((0, 0, 0, 1, 1, 2))):
                parts.insert(r.randint(0, len(parts)), part(True))
        if r.random() < 0.35:
            parts.append(self.comments(True))
        tag, a = self.pick(
            "article ", "article ", "article ", "main ", 'article class="post"', 'div class="content"', 'div id="article-body"', 'div class="post-content"', 'section class="entry"', 'div class="story"', "div "
        ).split(" ", 1)
        text = f'<{tag} {a} data-y="1">{"".join(parts)}</{tag}>'
        return self.pick(text, text, f"<main>{text}</main>", f'<div id="content">{text}</div>', f"<div>{text}</div>")

    def page(self) -> str:
        r = self.r
        maybe = lambda p, f: [f()] if r.random() < p else []
        front = maybe(0.4, self.header) + maybe(0.7, self.menu) + maybe(0.3, self.notice) + maybe(0.5, self.advert) + maybe(0.2, self.form) + maybe(0.2, self.side)
        if r.random() < 0.3:
            r.shuffle(front)
        back = maybe(0.25, self.comments) + maybe(0.3, self.side) + maybe(0.2, self.advert) + maybe(0.15, self.form) + maybe(0.8, self.footer) + maybe(0.15, self.notice)
        body = "".join([*front, self.article(), *back])
        body = self.pick(body, body, f'<div class="{self.pick("page", "container", "wrapper")}">{body}</div>')
        text = f"<!DOCTYPE html><html><head><title>{self.words(2, 9)}</title><style>p{{}}</style></head><body>{body}</body></html>"
        return text[: r.randint(len(text) // 2, len(text))] if r.random() < 0.06 else text


def sample_pages(n: int, seed: int = 5) -> list[str]:
    maker = _Maker(seed)
    return [maker.page() for _ in range(n)]
