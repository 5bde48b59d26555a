"""Labelled pages to learn main-text extraction from.

No table holds labelled pages, so they are made here by rule: layouts of many
kinds (article element, sections, plain divisions or no container, short
articles, tables and definition lists, notices, menus, sidebars, adverts, forms,
comments after the article and within it), filled with invented words; each text block
carries its label. The generator is seeded, so the model is the same in every
run.
"""
from __future__ import annotations

import random

SYLLABLES = "ka lo mi ra te su no vi da pe zu fo ri ga be lu sha tor ven mal der gi pra sto".split()
LINKS = "home about news sport contact archive login shop blog help imprint privacy terms sitemap team jobs".split()


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def sentence(self, least: int = 4, most: int = 18) -> str:
        words = [self.word() for _ in range(self.r.randint(least, most))]
        return " ".join(words).capitalize() + self.r.choice("..!?")

    def prose(self) -> str:
        kind = self.r.random()
        if kind < 0.2:  # short paragraphs are content as well
            return self.sentence(1, 5)
        return " ".join(self.sentence() for _ in range(self.r.randint(1, 6)))

    def links(self) -> str:
        names = [self.r.choice((self.r.choice(LINKS), self.word())) for _ in range(self.r.randint(2, 8))]
        if self.r.random() < 0.6:
            return "<ul>" + "".join(f'<li><a href="/{x}">[[0:{x}]]</a></li>' for x in names) + "</ul>"
        return "".join(f'<a href="/{x}">{x}</a> | ' for x in names).join(("<p>[[0:", "]]</p>"))

    def content(self) -> str:
        r, out = self.r, []
        title = self.sentence(2, 9)[:60]
        head = f"<h1>[[1:{title}]]</h1>"
        short = r.random() < 0.2
        if r.random() > (0.4 if short else 0.05):
            out.append(f"<header>{head}</header>" if r.random() < 0.2 else head)
        for _ in range(1 if short else r.randint(1, 9)):
            kind = 0 if short else r.random()
            if kind < 0.72:
                out.append(f"<p>[[1:{self.prose()}]]</p>")
            elif kind < 0.8:
                out.append(f"<h2>[[1:{self.sentence(1, 6)}]]</h2>")
            elif kind < 0.88:
                out.append("<ul>" + "".join(f"<li>[[1:{self.sentence(2, 9)}]]</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>[[1:{self.prose()}]]</blockquote>")
            elif kind < 0.935:
                out.append(self.table())
            elif kind < 0.945:
                out.append("<dl>" + "".join(f"<dt>[[1:{self.word()}]]</dt><dd>[[1:{self.sentence(2, 9)}]]</dd>" for _ in range(r.randint(1, 3))) + "</dl>")
            elif kind < 0.96:
                out.append(f'<p>[[1:{self.sentence()} <a href="/x">{self.word()}</a> {self.word()}.]]</p>')
            else:
                out.append(f"<pre>[[1:{self.sentence()}]]</pre>")
            if r.random() < 0.1:
                out.append(self.advert())
        return "".join(out)

    def table(self) -> str:
        r, wide = self.r, self.r.randint(2, 3)
        row = lambda tag: "<tr>" + "".join(f"<{tag}>[[1:{r.choice((self.word(), str(r.randint(1, 999)), self.sentence(2, 6)))}]]</{tag}>" for _ in range(wide)) + "</tr>"
        return "<table>" + (row("th") if r.random() < 0.5 else "") + "".join(row("td") for _ in range(r.randint(1, 3))) + "</table>"

    def comments(self) -> str:
        r = self.r
        tag = r.choice(("p", "div", "li"))
        said = "".join(f"<{tag}>[[0:{self.prose()}]]</{tag}>" for _ in range(r.randint(1, 4)))
        name = r.choice(("comments", "comment-list", "comment", "replies", "discussion", "reader-comments"))
        head = f"<h3>[[0:{self.sentence(1, 3)}]]</h3>" if r.random() < 0.7 else ""
        element = r.choice(("div", "section", "ul" if tag == "li" else "div"))
        return f'<{element} {r.choice(("class", "id"))}="{name}">{head}{said}</{element}>'

    def advert(self) -> str:
        c = self.r.choice(("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner"))
        text = self.r.choice((self.sentence(3, 10), self.prose()))
        return f'<div class="{c}">[[0:{text}]]</div>'

    def before(self) -> list[str]:
        r = self.r
        return [x for p, x in (
            (0.4, f"<header>[[0:{self.sentence(1, 4)}]]</header>"),
            (0.2, f'<div id="header" class="site-header">[[0:{self.sentence(1, 5)}]]</div>'),
            (0.6, f"<nav>{self.links()}</nav>"),
            (0.3, f'<div class="{r.choice(("menu", "navbar", "nav", "breadcrumb", "topnav"))}">{self.links()}</div>'),
            (0.3, f'<div class="{r.choice(("cookie", "notice", "cookie-banner", "consent", "alert"))}">[[0:{self.prose()}]]</div>'),
            (0.3, self.advert()),
            (0.2, f'<form action="/s"><label>[[0:{self.word()}]]</label><input name="q"><button>go</button></form>'),
            (0.2, f"<aside>[[0:{self.prose()}]]</aside>")) if r.random() < p]

    def after(self) -> list[str]:
        r = self.r
        return [x for p, x in (
            (0.25, f"<aside>{self.links()}<p>[[0:{self.prose()}]]</p></aside>"),
            (0.25, f'<div class="{r.choice(("sidebar", "side", "related", "widget", "recommended"))}"><h3>[[0:{self.sentence(1, 3)}]]</h3>{self.links()}<p>[[0:{self.sentence()}]]</p></div>'),
            (0.35, self.comments()),
            (0.2, f'<form class="{r.choice(("newsletter", "subscribe", "signup", "login"))}"><p>[[0:{self.sentence()}]]</p><input type="email"></form>'),
            (0.3, self.advert()),
            (0.2, f'<div class="{r.choice(("share", "social", "tags", "meta", "pagination"))}">{self.links()}</div>'),
            (0.6, f"<footer>[[0:&copy; {self.word()} &middot; {self.sentence(2, 8)}]]</footer>"),
            (0.2, f'<div id="footer">[[0:{self.sentence()}]]{self.links()}</div>')) if r.random() < p]

    def page(self) -> str:
        r = self.r
        opening, closing = r.choice((
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
            ('<div class="content">', "</div>"), ('<div id="main-content" class="post">', "</div>"),
            ('<section class="entry-content">', "</section>"), ('<div class="article-body text">', "</div>"), ("<div>", "</div>"), ("<section>", "</section>"), ("", ""), ("", "")))
        before, after = self.before(), self.after()
        r.shuffle(before)
        inner = self.content()
        if r.random() < 0.15:
            inner += self.comments()
        if r.random() < 0.1 and after:  # what belongs to the page may stand within the article's element
            inner += after.pop(0)
        return ("<html><head><title>t</title><style>p{}</style></head><body><script>var a=1;</script>" + "".join(before)
                + opening + inner + closing + "".join(after) + "</body></html>")


def labelled_pages(n: int, seed: int = 7) -> list[str]:
    """Pages whose text blocks are written ``[[label:text]]``, 1 for main text."""
    make = Maker(seed)
    return [make.page() for _ in range(n)]
