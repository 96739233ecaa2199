"""The small labelled table: pages for training, with the texts of their article.

Some are written by hand; the others are laid out by a rule, in several styles: with tags that
say what a place is, with names, with names that mislead, and without any of these.
"""

from __future__ import annotations

import random

NEWS = """<html><head><title>Harbour opens</title><style>p{color:red}</style></head><body>
<header><h1>Daily Paper</h1><p>Independent news since long ago</p></header>
<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>World</a></li><li><a href=/c>Sport</a></li></ul></nav>
<div class="ad">Buy new shoes today and save half of the price.</div>
<article><h1>Harbour opens after long works</h1><p>The harbour opened on Monday after three years of
building works that cost more than expected.</p><p>Yes.</p><p>Boats left at noon.</p>
<p>Read the <a href=/x>full report of the committee</a> for the list of works.</p>
<aside>Related: more news about boats and their owners in the region</aside></article>
<div id="comments"><p>I was there and it was a very long day for all of us, thanks for the report.</p></div>
<footer>&copy; Daily Paper, all rights reserved.</footer></body></html>"""

BLOG = """<html><body><div class="menu"><a href=1>Start</a> <a href=2>About me</a></div>
<div class="content"><h2>Bread at home</h2><p>Mix flour and water and wait for a day, then add salt and
fold the dough a few times.</p><p>Bake it hot.</p><ul><li>500 g flour</li><li>350 g water</li></ul>
<p>Enjoy!</p><form action=/s><p>Leave your address to get a letter every week about bread</p></form></div>
<div class="sidebar"><p>About the author: a baker who writes about bread, mills and old ovens.</p></div>
<div class="cookie-notice">We use cookies to make this site work better for every visitor of it.</div>
<div>Powered by a small machine</div></body></html>"""

PLAIN = """<html><body><p><a href=1>Home</a> <a href=2>Archive</a> <a href=3>Links</a></p>
<h1>On walking</h1><p>Walking is the oldest way to get from one place to another, and for a long time it was
the only one that most people had.</p><p>A walk needs no ticket, no fuel and no timetable, which is why
doctors and poets alike have praised it in so many books.</p><p>It also needs time, and that is what most of
us believe we lack when the evening comes.</p><p><a href=4>Next page</a></p><p>Copyright 2001</p></body></html>"""

SHOP = """<html><body><nav><a href=1>Cart</a></nav><main><h1>Oak chair</h1><p>A chair made of oak.</p>
<table><tr><td>Height</td><td>90 cm</td></tr></table><section class="related"><h3>You may like</h3>
<a href=5>Pine chair</a><a href=6>Oak table</a></section></main><div class="newsletter"><p>Subscribe to hear
of offers before anyone else does, once a month at most.</p></div><footer><p>Terms of sale apply to every
order that is placed on this site, please read them before you buy anything.</p></footer></body></html>"""

WIKI = """<html><body><div id="toc"><a href=#1>History</a> <a href=#2>Use</a></div><article>
<p>A <a href=/lever>lever</a> is a <a href=/beam>beam</a> on a <a href=/hinge>fixed hinge</a>.</p>
<p><a href=/first>First class levers</a></p><h2>History</h2><p>Levers are older than writing.</p>
<div class="comments"><p>Nice page, thank you for it, I used it at school.</p><p>Agreed.</p></div>
</article><aside><p>Advert: learn mechanics in ten days with our course for beginners.</p></aside>
<div role="complementary">See also the page on wheels</div></body></html>"""

BROKEN = """<body><nav><li><a href=1>One<li><a href=2>Two</nav><!-- ad --><div class=ads>Win a trip to the
sea, only this week and only here.</div><article><h1>Late trains</h1><p><b>Trains were late.<br><p>Nobody
knows why.<p>Ask again.<p>Service should be back to its usual order by the end of the week.</article><footer>
Contact us by letter &middot; Imprint"""

BOARD = """<html><body><header><a href=/>Board</a></header><div class="alert">The site will be closed on
Sunday from two to four in the morning for repairs.</div><article><header><h1>Bees in spring</h1></header>
<p>Bees leave the hive when the first warm days come.</p><pre>12 hives</pre><blockquote>All alive.</blockquote>
<footer>Filed under garden</footer></article><section id="replies"><article><p>My bees are late this year
and I wonder why that is so.</p></article></section></body></html>"""

BARE = """<p>One single paragraph stands on this page, with enough words to be what the page is about, and
nothing else comes before it or after it on the whole page.</p>"""

LIST = """<html><body><h3>Partner sites</h3><ul><li><a href=1>First partner site</a></li><li><a href=2>Second
partner site</a></li></ul><p><a href=3>Log in</a></p><p>Imprint</p></body></html>"""

MIXED = """<html><body><p><a href=1>Home</a></p><p>The river rose by two metres in one night, and the
lower town was under water when the day broke over the hills.</p><p>Nobody was hurt.</p><p>The mayor thanked
the many helpers who filled sandbags until the morning came and the rain stopped at last.</p>
<p><a href=2>More</a> <a href=3>news</a></p></body></html>"""

SHORT = "<html><body><article><p>Yes.</p></article></body></html>"

ENDING = """<html><body><nav><a href=1>Home</a></nav><article><h1>Notes</h1><p>It rained.</p><p>Then not.</p>
</article></body></html>"""

START = """<html><body><article><h1>Notes</h1><p>It snowed.</p><p>Then not.</p></article><footer>Imprint</footer>"""

OPENING = """<main><p>Rain again.</p><p>Nobody came.</p><h2>Later</h2><p>Sun.</p></main>"""

LINKED = """<html><body><main><p><a href=1>One link only</a></p></main><p>Imprint</p></body></html>"""

ASIDES = """<html><body><nav>All pages of this site in one place</nav><aside>Buy a boat this week and get a second
one for half of the price, as long as we have any left in our harbour.</aside><form>Your name</form></body></html>"""

PAGES = [
    (SHORT, ("Yes.",)),
    (ENDING, ("Notes", "It rained.", "Then not.")),
    (START, ("Notes", "It snowed.", "Then not.")),
    (OPENING, ("Rain again.", "Nobody came.", "Later", "Sun.")),
    (LINKED, ("One link only",)),
    (ASIDES, ()),
    (NEWS, (
        "Harbour opens after long works",
        "The harbour opened on Monday after three years of building works that cost more than expected.",
        "Yes.", "Boats left at noon.",
        "Read the full report of the committee for the list of works.",
    )),
    (BLOG, (
        "Bread at home",
        "Mix flour and water and wait for a day, then add salt and fold the dough a few times.",
        "Bake it hot.", "500 g flour", "350 g water", "Enjoy!",
    )),
    (PLAIN, (
        "On walking",
        "Walking is the oldest way to get from one place to another, and for a long time it was "
        "the only one that most people had.",
        "A walk needs no ticket, no fuel and no timetable, which is why doctors and poets alike "
        "have praised it in so many books.",
        "It also needs time, and that is what most of us believe we lack when the evening comes.",
    )),
    (SHOP, ("Oak chair", "A chair made of oak.", "Height", "90 cm")),
    (WIKI, (
        "A lever is a beam on a fixed hinge.", "First class levers", "History",
        "Levers are older than writing.",
    )),
    (BROKEN, (
        "Late trains", "Trains were late.", "Nobody knows why.", "Ask again.",
        "Service should be back to its usual order by the end of the week.",
    )),
    (BOARD, (
        "Bees in spring", "Bees leave the hive when the first warm days come.", "12 hives",
        "All alive.",
    )),
    (BARE, (
        "One single paragraph stands on this page, with enough words to be what the page is about, "
        "and nothing else comes before it or after it on the whole page.",
    )),
    (LIST, ()),
    (MIXED, (
        "The river rose by two metres in one night, and the lower town was under water when the "
        "day broke over the hills.",
        "Nobody was hurt.",
        "The mayor thanked the many helpers who filled sandbags until the morning came and the rain "
        "stopped at last.",
    )),
]

# Names that tell the truth about a place, by the kind of place.
TRUE_NAMES = {
    "menu": ["menu", "nav", "main-navigation", "breadcrumbs", "site-menu"],
    "notice": ["cookie-notice", "alert", "banner", "consent-popup"],
    "advert": ["ad", "ads", "advert", "sponsored", "promo-box"],
    "related": ["related", "sidebar", "recommended", "right-sidebar", "widget-area"],
    "comments": ["comments", "replies", "comment-list", "user-comments"],
    "form": ["newsletter", "signup", "search-box", "login"],
    "footer": ["footer", "site-footer", "copyright", "page-footer"],
}
# Names of layouts that hold the article, though a word in them names another place.
FALSE_NAMES = [
    "layout with-sidebar", "page-header-social-wrap", "has-banner", "ad-free", "comments-enabled",
    "no-sidebar wide", "content-sidebar-wrap", "menu-open-wrap", "header", "widget-frame",
]
INNER_NAMES = ["content", "entry", "story", "article-body", "post-content"]
STYLES = ("tags", "names", "misleading", "misleading names", "bare")
PER_STYLE = 80

_WORDS = (
    "river stone light winter harbour engine garden letter market bridge copper window paper "
    "village morning report council summer answer forest wheel silver number station island "
    "after before under their every would could many never often small large quiet early"
).split()


class _Writer:
    """Writes one page in a style, and remembers the texts of its article."""

    def __init__(self, style: str, seed: int) -> None:
        self.style = style
        self.draw = random.Random(f"{style} {seed}")
        self.article: list[str] = []
        self.said: set[str] = set()

    def words(self, least: int, most: int) -> str:
        """Words that are not yet on the page, so that a text has one label."""
        count, text = self.draw.randint(least, most), ""
        while not text or text in self.said:
            text = " ".join(self.draw.choice(_WORDS) for _ in range(count)).capitalize() + "."
            count += 1
        self.said.add(text)
        return text

    def links(self, count: int, least: int = 1, most: int = 3) -> list[str]:
        return [f"<a href=/{n}>{self.words(least, most)}</a>" for n in range(count)]

    def place(self, kind: str, tag: str, body: str) -> str:
        """A place outside the article, called what it is as the style does."""
        if self.style in ("tags", "misleading") and tag != "div":
            return f"<{tag}>{body}</{tag}>"
        if self.style == "bare":
            return f"<div>{body}</div>"
        name = self.draw.choice(TRUE_NAMES[kind])
        return f'<div {self.draw.choice(["class", "id"])}="{name}">{body}</div>'

    def own(self, tag: str, text: str, shown: str | None = None) -> str:
        self.article.append(text)
        return f"<{tag}>{shown or text}</{tag}>"

    def body(self) -> str:
        draw, out = self.draw, []
        if draw.random() < 0.6:
            title = self.words(1, 9)
            linked = self.style != "bare" and draw.random() < 0.2
            out.append(self.own(draw.choice(["h1", "h2"]), title, f"<a href=/z>{title}</a>" if linked else title))
        else:
            out.append(self.own("p", self.words(15, 90)))
        for _ in range(draw.randint(2, 9) if draw.random() < 0.9 else draw.randint(10, 40)):
            shape = draw.random()
            if shape < 0.5:
                out.append(self.own("p", self.words(15, 90) if draw.random() < 0.9 else self.words(90, 2000)))
            elif shape < 0.75:
                out.append(self.own("p", self.words(1, 9)))
            elif shape < 0.85:
                first, link, last = self.words(5, 20), self.words(1, 3), self.words(5, 20)
                out.append(self.own("p", f"{first} {link} {last}", f"{first} <a href=/x>{link}</a> {last}"))
            elif shape < 0.9 and self.style != "bare":
                link = self.words(2, 6)
                out.append(self.own("p", link, f"<a href=/y>{link}</a>"))
            elif shape < 0.91 and self.style != "bare":
                owner = self.words(1, 3)  # an article may quote a notice
                out.append(self.own("p", f"All rights reserved by {owner}"))
            elif shape < 0.95:
                items = [self.own("li", self.words(1, 6)) for _ in range(draw.randint(2, 4))]
                out.append(f"<ul>{''.join(items)}</ul>")
            else:
                out.append(self.own("h3", self.words(1, 5)))
        out.append(self.own("p", self.words(15, 60) if self.style == "bare" else self.words(1, 40)))
        return "".join(out)

    def shell(self, body: str) -> str:
        """The article's own place."""
        draw = self.draw
        if self.style in ("tags", "misleading"):
            tag = draw.choice(["article", "main"])
            body = f"<{tag}>{body}</{tag}>"
        elif self.style in ("names", "misleading names"):
            body = f'<div class="{draw.choice(INNER_NAMES)}">{body}</div>'
        return body

    def menu(self) -> str:
        links = self.links(self.draw.randint(2, 7))
        rows = self.draw.choice(["list", "line", "paragraphs"])
        if rows == "list":
            return f"<ul>{''.join(f'<li>{a}</li>' for a in links)}</ul>"
        return " | ".join(links) if rows == "line" else "".join(f"<p>{a}</p>" for a in links)

    def headlines(self) -> str:
        """Links as long as sentences, or of a few words, below or beside each other."""
        draw = self.draw
        least, most = (4, 18) if draw.random() < 0.6 else (1, 5)
        links = self.links(draw.randint(1 if self.style != "bare" else 2, 5), least, most)
        title = f"<h4>{self.words(1, 3)}</h4>" if self.style != "bare" and draw.random() < 0.7 else ""
        return title + (" ".join(links) if draw.random() < 0.4 else "".join(f"<p>{a}</p>" for a in links))

    def ending(self) -> str:
        owner = self.words(1, 3)
        lines = [f"&copy; {owner}", f"Copyright 2019 {owner}", f"All rights reserved by {owner}"]
        return f"<p>{self.draw.choice(lines)}</p>"

    def page(self) -> tuple[str, tuple[str, ...]]:
        draw, bare = self.draw, self.style == "bare"
        inside = [self.body()]
        if draw.random() < 0.3:  # a list of links within the article's place is still a menu
            inside.append(f"<ul>{''.join(f'<li>{a}</li>' for a in self.links(draw.randint(3, 6), 2, 9))}</ul>")
        if not bare and draw.random() < 0.5:
            inside.append(self.place("related", "aside", self.headlines()))
        if self.style.endswith("names") and draw.random() < 0.3:
            inside.append(self.place("advert", "div", self.words(3, 30)))
        article = self.shell("".join(inside))
        after = [self.place("related", "aside", self.headlines())] if draw.random() < 0.6 else []
        if not bare and draw.random() < 0.5:
            many = draw.randint(1, 5) if draw.random() < 0.7 else draw.randint(6, 25)
            said = [f"<p>{self.words(2, draw.choice([30, 60, 200]))}</p>" for _ in range(many)]
            if draw.random() < 0.4 and self.style in ("tags", "misleading"):
                said = [f"<article>{s}</article>" for s in said]
            name = draw.choice(TRUE_NAMES["comments"])
            after.append(f'<section id="{name}">{"".join(said)}</section>')
        if self.style.startswith("misleading"):
            held = article + (after.pop() if after and draw.random() < 0.5 else "")
            name = draw.choice(FALSE_NAMES)
            article = f'<div class="{name}">{held}</div>'
            if draw.random() < 0.2:
                article = f"<form action=/>{article}</form>"
        before = [self.place("menu", "nav", self.menu())] if draw.random() < 0.7 else []
        if not bare and draw.random() < 0.5:
            before.append(self.place("notice", "div", f"<p>{self.words(6, 30)}</p>"))
        if not bare and draw.random() < 0.5:
            kind = "advert" if self.style != "misleading" else "related"
            before.append(self.place(kind, "aside", self.words(4, draw.choice([40, 200]))))
        if not bare and draw.random() < 0.3:
            after.append(self.place("form", "form", f"<p>{self.words(4, 25)}</p>"))
        if not bare and draw.random() < 0.2:
            after.append(self.place("footer", "footer", f"<p>{self.words(20, 200)}</p>"))
        if draw.random() < 0.6:
            menu = self.menu() if draw.random() < 0.5 else ""
            after.append(self.place("footer", "footer", self.ending() + menu))
        before = before if draw.random() < 0.85 else []
        after = after if draw.random() < 0.85 else []
        return f"<html><body>{''.join(before)}{article}{''.join(after)}</body></html>", tuple(self.article)


def laid_out(style: str, seed: int) -> tuple[str, tuple[str, ...]]:
    """A page of a style and the texts of its article, the same for the same arguments."""
    return _Writer(style, seed).page()


def labelled() -> list[tuple[str, tuple[str, ...]]]:
    """All labelled pages: those written by hand, and ``PER_STYLE`` of each style."""
    return PAGES + [laid_out(style, n) for style in STYLES for n in range(PER_STYLE)]
