"""Labelled pages for training the extractor: layouts in common use, filled with invented words.

``data-y`` marks a part as main text (1) or not (0); what lies below inherits it."""

from __future__ import annotations

import random


class Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.words = ["".join(self.rng.choices("aeiourstlnmdpc", k=self.rng.randint(2, 9))) for _ in range(400)]

    def some(self, a: int, b: int) -> str:
        return " ".join(self.rng.choices(self.words, k=self.rng.randint(a, b)))

    def prose(self, most: int = 6) -> str:
        return " ".join(self.some(3, 18).capitalize() + self.rng.choice([".", ".", ".", "?", "!"])
                        for _ in range(self.rng.randint(1, most)))

    def pick(self, *choices: str) -> str:
        return self.rng.choice(choices)

    def links(self, n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{self.some(1, 1)}">{self.some(1, 3)}</a></{tag}>' for _ in range(n))

    def content(self) -> str:
        w, out = self, []
        out.append(f"<h1>{w.some(3, 9)}</h1>")
        for _ in range(w.rng.randint(1, 12)):
            kind = w.rng.random()
            if kind < 0.66:
                body = w.prose(w.pick(1, 4, 8))
                if w.rng.random() < 0.25:
                    body += f' <a href="/x">{w.some(1, 4)}</a> {w.prose(2)}'
                if w.rng.random() < 0.15:
                    body = w.some(2, 4) + "."
                out.append(f"<p>{w.pick('', '<b>')}{body}{w.pick('', '', '<br>')}</p>")
            elif kind < 0.76:
                out.append(f"<{w.pick('h2', 'h3')}>{w.some(1, 6)}</h2>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{w.some(2, 12)}</li>" for _ in range(w.rng.randint(2, 5))) + "</ul>")
            elif kind < 0.89:
                out.append(f"<blockquote><p>{w.prose(2)}</p></blockquote>")
            elif kind < 0.92:
                out.append(f"<pre>{w.some(4, 20)}</pre>")
            elif kind < 0.95:
                out.append("<table>" + "".join(f"<tr><td>{w.some(1, 3)}</td><td>{w.some(1, 3)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                out.append(w.aside())
        return "".join(out)

    def aside(self) -> str:
        """What interrupts or follows an article."""
        w = self
        return w.pick(
            f'<div class="{w.pick("ad", "ads", "advert", "ad-slot", "sponsored", "promo")}" data-y="0">{w.pick(w.prose(1), w.some(2, 8))}</div>',
            f'<div class="{w.pick("share", "social-links", "share-buttons")}" data-y="0">{w.links(3, "span")}</div>',
            f'<aside class="{w.pick("related", "pullout", "sidebar", "")}" data-y="0"><h3>{w.some(1, 3)}</h3><ul>{w.links(4)}</ul></aside>',
            f'<aside data-y="0"><p>{w.prose(2)}</p></aside>',
            f'<div class="{w.pick("newsletter", "subscribe", "signup")}" data-y="0"><p>{w.prose(1)}</p><form><label>{w.some(1, 3)}</label><button>{w.some(1, 1)}</button></form></div>',
            f'<form class="{w.pick("", "search", "login")}" data-y="0"><label>{w.some(1, 2)}</label><p>{w.prose(1)}</p></form>')

    def comments(self) -> str:
        w = self
        body = "".join(f'<{t} class="{w.pick("comment", "reply", "user-comment")}"><b>{w.some(1, 2)}</b><p>{w.prose(3)}</p></{t}>'
                       for t in [w.pick("div", "li", "article")] * w.rng.randint(1, 5))
        return (f'<{w.pick("section", "div")} {w.pick("class", "id")}="{w.pick("comments", "comment-list", "responses", "discussion", "disqus_thread")}" '
                f'data-y="0"><h2>{w.some(1, 2)}</h2>{body}</div>')

    def page(self) -> str:
        w = self
        head = f"<html><head><title>{w.some(3, 8)}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
        top, bottom = [], []
        if w.rng.random() < 0.7:
            top.append(f'<{w.pick("header", "div class=header", "div id=masthead")} data-y="0"><h2>{w.some(1, 3)}</h2><p>{w.some(2, 7)}</p></div></header>')
        if w.rng.random() < 0.8:
            top.append(f'<{w.pick("nav", "div class=menu", "div id=nav", "ul class=navigation")} data-y="0"><ul>{w.links(w.rng.randint(3, 8))}</ul></nav></div>')
        if w.rng.random() < 0.4:
            top.append(f'<div {w.pick("class", "id")}="{w.pick("cookie-notice", "cookie-banner", "consent", "notice", "alert", "gdpr popup")}" '
                       f'data-y="0"><p>{w.prose(3)}</p><button>{w.some(1, 1)}</button></div>')
        if w.rng.random() < 0.5:
            top.append(w.aside())
        if w.rng.random() < 0.25:
            top.append(f'<div class="{w.pick("breadcrumb", "breadcrumbs")}" data-y="0">{w.links(3, "span")}</div>')
        side = (f'<{w.pick("aside", "div class=sidebar", "div id=sidebar", "div class=widget")} data-y="0"><h3>{w.some(1, 3)}</h3>'
                f'<ul>{w.links(5)}</ul><p>{w.prose(2)}</p></div></aside>')
        if w.rng.random() < 0.3:
            top.append(side)
        elif w.rng.random() < 0.4:
            bottom.append(side)
        if w.rng.random() < 0.45:
            bottom.append(w.comments())
        if w.rng.random() < 0.4:
            bottom.append(w.aside())
        if w.rng.random() < 0.85:
            bottom.append(f'<{w.pick("footer", "div class=footer", "div id=footer", "div class=site-footer")} data-y="0">'
                          f'&copy; {w.some(1, 2)} &middot; {w.pick(w.prose(1), w.some(2, 6), w.links(4, "span"))}</div></footer>')
        kind = w.rng.random()
        within = ""
        if kind < 0.25 and bottom and "comment" in bottom[0]:
            within, bottom = bottom[0], bottom[1:]
        if kind < 0.55:
            body = f'<article data-y="1">{w.content()}{within}</article>'
        elif kind < 0.7:
            body = f'<main data-y="1">{w.content()}{within}</main>'
        else:
            body = f'<div {w.pick("class", "id")}="{w.pick("content", "post", "entry-content", "article-body", "story", "main", "text")}" data-y="1">{w.content()}{within}</div>'
        if w.rng.random() < 0.4:
            body = f'<div class="{w.pick("wrapper", "container", "page", "row")}">{body}</div>'
        return head + "".join(top) + body + "".join(bottom) + w.pick("</body></html>", "")


def labelled_pages(count: int = 300, seed: int = 5) -> list[str]:
    writer = Writer(seed)
    return [writer.page() for _ in range(count)]
