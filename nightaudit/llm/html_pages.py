"""Labelled pages for the block labeller: page layouts with marked main text, drawn from a fixed seed.

A page is put together from parts that sites use (navigation, mastheads, notices, adverts, side columns, share bars,
forms, reader comments, footers) round an article, with varying tags, class and id names, or none. Elements of the
main text carry ``data-main``; the reader of training pages turns the mark into a label, and features never see it.
"""

from __future__ import annotations

import random

#: Name parts that sites give their boxes.
NAMES = {
    "nav": ["nav", "menu", "navbar", "main-menu", "breadcrumbs", "breadcrumb", "topnav", "site-nav", "toc", "pagination", "tabs"],
    "head": ["header", "masthead", "site-header", "topbar", "branding", "banner", "page-header", "logo"],
    "foot": ["footer", "site-footer", "copyright", "legal", "colophon", "credits", "bottom"],
    "side": ["sidebar", "aside", "widget", "related", "recommended", "most-read", "trending", "teaser", "secondary", "right-col"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "adsbox", "ad-slot", "banner-ad", "promotion"],
    "notice": ["notice", "cookie", "cookie-banner", "consent", "alert", "popup", "modal", "newsletter", "subscribe", "paywall", "gdpr", "disclaimer"],
    "share": ["share", "social", "sharing", "share-bar", "tags", "follow-us", "toolbar"],
    "comments": ["comments", "comment-list", "comment", "discussion", "replies", "reply", "responses", "disqus", "user-comments"],
    "form": ["search", "login", "signup", "contact-form", "search-box", "feedback"],
    "main": ["content", "article", "post", "entry", "story", "article-body", "post-content", "entry-content", "main", "text", "body-copy"],
}
_VERBS = ["Share", "Print", "Login", "Home", "About", "Contact", "Search", "More", "Next", "Subscribe", "Reply", "OK", "Menu"]
_SYLLABLES = "the an er on ti re st en nd ou ing ion ed ha ma lo ri ka su ne de la es ie ch un au ge ver be ra do ci que".split()


class _Writer:
    def __init__(self, rng: random.Random):
        self.r = rng

    def words(self, n: int) -> str:
        out = ["".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4))) for _ in range(n)]
        if self.r.random() < 0.2:  # noisy texts are main text all the same
            out = [w + self.r.choice(["***", "###", "%%%", "!!", " |", "&amp;"]) for w in out]
        return " ".join(out).capitalize()

    def sentences(self, lo: int, hi: int) -> str:
        return " ".join(self.words(self.r.randint(3, 18)) + self.r.choice(".......?!") for _ in range(self.r.randint(lo, hi)))

    def names(self, kind: str) -> str:
        out = ""
        if self.r.random() < 0.75:
            out += f' class="{self.r.choice(NAMES[kind])}{self.r.choice(["", "", " wide", " clearfix", "-1"])}"'
        if self.r.random() < 0.25 or not out:
            out += f' id="{self.r.choice(NAMES[kind])}"'
        return out

    def links(self, n: int) -> list[str]:
        return [f'<a href="/{i}">{self.words(self.r.randint(1, 3)) if self.r.random() < 0.7 else self.r.choice(_VERBS)}</a>' for i in range(n)]

    def nav(self) -> str:
        links = self.links(self.r.randint(2, 9))
        tag = self.r.choice(["nav", "nav", "div", "ul"])
        names = self.names("nav") if tag != "nav" or self.r.random() < 0.5 else ""
        if tag == "ul" or self.r.random() < 0.6:
            inner = "".join(f"<li>{a}</li>" for a in links)
            return f"<ul{names}>{inner}</ul>" if tag == "ul" else f"<{tag}{names}><ul>{inner}</ul></{tag}>"
        return f"<{tag}{names}>{self.r.choice([' ', ' | ', ' &raquo; ']).join(links)}</{tag}>"

    def head(self) -> str:
        tag = self.r.choice(["header", "header", "div"])
        names = self.names("head") if tag != "header" or self.r.random() < 0.5 else ""
        inner = self.r.choice([f"<h1>{self.words(2)}</h1>", f'<a href="/">{self.words(2)}</a>', f"<p>{self.words(5)}</p>", f"<span>{self.words(3)}</span>"])
        return f"<{tag}{names}>{inner}{self.nav() if self.r.random() < 0.4 else ''}</{tag}>"

    def foot(self) -> str:
        tag = self.r.choice(["footer", "footer", "div"])
        names = self.names("foot") if tag != "footer" or self.r.random() < 0.4 else ""
        text = self.r.choice([f"&copy; 2024 {self.words(2)} &middot; {self.sentences(1, 2)}", self.sentences(1, 3), f"&copy; {self.words(2)}. All rights reserved.", " ".join(self.links(4))])
        if self.r.random() < 0.4:
            text = f"<p>{text}</p>"
        return f"<{tag}{names}>{text}</{tag}>"

    def box(self, kind: str) -> str:
        tag = self.r.choice({"side": ["aside", "aside", "div", "section"], "notice": ["div", "section", "aside"]}.get(kind, ["div", "div", "section"]))
        names = self.names(kind) if tag != "aside" or self.r.random() < 0.6 else ""
        inner = []
        for _ in range(self.r.randint(1, 3)):
            inner.append(self.r.choice([
                f"<p>{self.sentences(1, 3)}</p>", f"<p>{self.sentences(1, 2)}</p>", f"<h3>{self.words(3)}</h3>",
                f"<ul>{''.join(f'<li>{a}</li>' for a in self.links(3))}</ul>", self.sentences(1, 2)]))
        return f"<{tag}{names}>{''.join(inner)}</{tag}>"

    def form(self) -> str:
        return (f'<form{self.names("form") if self.r.random() < 0.6 else ""}><label>{self.words(2)}</label><input name="q"><p>{self.sentences(1, 1)}</p>'
                f"<select><option>{self.words(1)}</option></select><button>{self.r.choice(_VERBS)}</button></form>")

    def comments(self) -> str:
        tag = self.r.choice(["section", "div", "ol", "ul"])
        item = "li" if tag in ("ol", "ul") else self.r.choice(["div", "article", "p"])
        each = []
        for _ in range(self.r.randint(1, 4)):
            says = self.sentences(1, 4)
            by = self.r.choice(["", f"<b>{self.words(1)}</b> ", f"<span class=\"author\">{self.words(1)}</span> "])
            own = f' class="{self.r.choice(["comment", "reply", "comment-body"])}"' if self.r.random() < 0.7 else ""
            each.append(f"<{item}{own}>{by}{says if item == 'p' else f'<p>{says}</p>'}</{item}>")
        title = f"<h3>{self.r.choice(['Comments', '3 comments', self.words(2)])}</h3>" if tag in ("section", "div") and self.r.random() < 0.7 else ""
        return f"<{tag}{self.names('comments')}>{title}{''.join(each)}</{tag}>"

    def article(self) -> str:
        parts = []
        m = ' data-main="1"'
        title = self.words(self.r.randint(3, 10))
        heading = f"<{(h := self.r.choice(['h1', 'h1', 'h2']))}{m}>{title}</{h}>"
        parts.append(f"<header>{heading}</header>" if self.r.random() < 0.15 else heading)
        close = self.r.choice(["</p>", "</p>", "</p>", ""])
        for i in range(self.r.randint(1, 14)):
            kind = self.r.random()
            if kind < 0.68:
                text = self.sentences(1, 7) if self.r.random() < 0.85 else self.words(self.r.randint(1, 3)) + "."
                if self.r.random() < 0.2:
                    text = f'{text} <a href="#">{self.words(2)}</a> <em>{self.words(2)}</em> {self.sentences(1, 2)}'
                parts.append(self.r.choice([f"<p{m}>{text}{close}", f"<p{m}>{text}{close}", f"<p{m}><b>{text}<br>{close}", f"<div{m}>{text}</div>"]))
            elif kind < 0.76:
                parts.append(f"<h2{m}>{self.words(self.r.randint(2, 6))}</h2>")
            elif kind < 0.82:
                parts.append("<ul>" + "".join(f"<li{m}>{self.sentences(1, 1)}</li>" for _ in range(self.r.randint(2, 4))) + "</ul>")
            elif kind < 0.86:
                parts.append(f"<blockquote{m}>{self.sentences(1, 3)}</blockquote>")
            elif kind < 0.89:
                parts.append(f"<pre{m}>{self.words(8)}</pre>")
            elif kind < 0.92:
                parts.append("<table><tr>" + "".join(f"<td{m}>{self.words(2)}</td>" for _ in range(3)) + "</tr></table>")
            elif kind < 0.94:
                parts.append(f"<figure><img src=x><figcaption{m}>{self.sentences(1, 1)}</figcaption></figure>")
            else:
                parts.append(self.r.choice([lambda: self.box("ad"), lambda: self.box("side"), lambda: self.box("share"), lambda: self.box("notice")])())
        inner = "".join(parts)
        if self.r.random() < 0.2:
            inner += self.comments()
        kind = self.r.random()
        if kind < 0.55:
            return f"<article{self.names('main') if self.r.random() < 0.4 else ''}>{inner}</article>"
        if kind < 0.75:
            return f"<main>{inner}</main>"
        if kind < 0.92:
            return f"<div{self.names('main')}>{inner}</div>"
        return inner

    def page(self) -> str:
        before = [f() for f in (self.head, self.nav, lambda: self.box("notice"), lambda: self.box("ad"), lambda: self.box("ad"), self.form, lambda: self.box("side")) if self.r.random() < 0.4]
        after = [f() for f in (lambda: self.box("share"), self.comments, lambda: self.box("side"), lambda: self.box("ad"), self.form, lambda: self.box("notice"), self.nav, self.foot) if self.r.random() < 0.45]
        self.r.shuffle(before)
        inside = "".join(before) + self.article() + "".join(after)
        if self.r.random() < 0.3:
            inside = f'<div id="{self.r.choice(["page", "wrapper", "container"])}">{inside}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(4)}</title></head><body>{inside}</body></html>"


    def short_page(self) -> str:
        """A page of one or a few blocks: no heading, no telling names, or no element of its own around the text."""
        m = ' data-main="1"'
        kind = self.r.random()
        block = lambda: f"<p{m}>{self.sentences(1, 3)}</p>"
        heading = f"<h1{m}>{self.words(self.r.randint(2, 6))}</h1>"
        if kind < 0.3:
            inner = f"<article>{block()}</article>"
        elif kind < 0.4:
            inner = f"<main>{block()}</main>"
        elif kind < 0.6:
            inner = f"<x-main{m}>{self.sentences(1, 6)}</x-main>"
        elif kind < 0.7:
            inner = "".join(block() for _ in range(self.r.randint(1, 4)))
        else:
            inner = f"<div>{heading}{''.join(block() for _ in range(self.r.randint(1, 4)))}</div>"
        before = self.nav() if self.r.random() < 0.3 else ""
        after = self.r.choice(["", "", self.foot(), f"<div>&copy; 2024 {self.words(2)}</div>", f"<div>&copy; {self.words(2)}. All rights reserved.</div>"])
        return f"<html><body>{before}{inner}{after}</body></html>"


def labelled_pages(n: int = 600, seed: int = 5, short: int = 200) -> list[str]:
    """``n`` pages and ``short`` pages of few blocks whose main-text elements carry data-main."""
    w, few = _Writer(random.Random(seed)), _Writer(random.Random(seed + 1))
    return [w.page() for _ in range(n)] + [few.short_page() for _ in range(short)]
