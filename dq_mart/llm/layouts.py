"""Labelled pages for the main-text field, drawn from templates.

A page is a frame (head, menus, header, notices, adverts, sidebars, forms,
comments, footer, in changing order, tags and names) around an article; the
article's elements carry ``data-main``.  Texts are drawn from invented words of
several kinds, in and out of the article alike, so that the labels lean on
layout more than on words.  The same number and seed give the same pages.
"""

from __future__ import annotations

import random

# Names that pages give to their parts.
NAMES = {
    "menu": "nav navbar navigation menu main-menu top-menu topnav breadcrumb breadcrumbs pagination pager "
            "skip-link toc nav-links site-nav mobile-menu submenu".split(),
    "header": "header site-header page-header masthead top-bar topbar branding logo site-title tagline "
              "site-description hero-banner".split(),
    "footer": "footer site-footer page-footer colophon copyright legal imprint bottom credits site-info "
              "footer-links".split(),
    "sidebar": "sidebar side aside widget widget-area related related-posts recommended popular trending "
               "recent-posts more-stories tags categories archive secondary rail".split(),
    "notice": "cookie cookies cookie-banner consent gdpr notice alert warning popup modal overlay message "
              "announcement paywall banner toast disclaimer privacy".split(),
    "advert": "ad ads advert advertisement adsense ad-slot ad-container banner-ad sponsored sponsor promo "
              "promotion commercial affiliate dfp-ad".split(),
    "form": "form search search-form login signup register newsletter subscribe subscription contact "
            "contact-form survey poll filter".split(),
    "comments": "comments comment-list comment comments-area respond reply replies discussion disqus reviews "
                "review feedback reader-comments user-comments thread".split(),
    "share": "share sharing social social-links share-buttons follow tools meta post-meta byline author-box "
             "print".split(),
    "main": "content main-content post entry entry-content article article-body post-body post-content story "
            "story-body text body-text page-content main single".split(),
}
TAGS = {
    "menu": ("nav", "nav", "ul", "div", "nav"), "header": ("header", "header", "div"),
    "footer": ("footer", "footer", "div"), "sidebar": ("aside", "aside", "div", "section"),
    "notice": ("div", "div", "section", "aside", "dialog"), "advert": ("div", "div", "aside", "ins", "section"),
    "form": ("form", "form", "div"), "comments": ("section", "div", "div", "ol"),
    "share": ("div", "ul", "p"), "main": ("article", "article", "main", "div", "section"),
}
ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "sidebar": "complementary",
         "form": "search", "main": "main", "notice": "alert"}
PHRASES = {
    "menu": "Home|About us|Contact|News|Sport|Login|Next|Previous|1|2|3|Skip to content|More|Products|Help",
    "header": "Daily Post|Sign in|Our blog|Welcome|The Journal|Search|Menu",
    "footer": "&copy; 2024|All rights reserved.|Privacy policy|Terms of use|Imprint|Contact us|Sitemap|&middot;",
    "sidebar": "Related articles|Most read|Popular|Tags|Archives|You may also like|Recent posts",
    "notice": "We use cookies to improve your experience.|Accept|Reject all|Please enable JavaScript.|"
              "This page has moved.|Got it",
    "advert": "Advertisement|Sponsored|Buy now|Special offer|Shop now|Learn more",
    "form": "Search|E-mail|Subscribe|Send|Your name|Password|Log in|Sign up for our newsletter",
    "comments": "Comments|Leave a comment|Reply|Posted by|3 comments|Report|says:|2 days ago",
    "share": "Share|Tweet|Print|By|Published|Updated 3 May 2024|Follow us|5 min read",
}
_PARTS = ("th an on er in re nd ou en ti es or it ha at st ed ly ble ing tion", "der ich ein sch ung lich keit",
          "ne tre ment elle eau oi ch aux", "ción mente ado que os as", "ka to mi ra shi no", "de la un et")
_MARKS = ("%%%", "###", "&amp;&amp;&amp;", "***", "$$$", "|", "&lt;&gt;", "1234", "éà", "äß")


class _Draw:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.parts = rng.choice(_PARTS).split()
        self.marks = rng.choice(_MARKS) if rng.random() < 0.15 else ""

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def word(self) -> str:
        w = "".join(self.rng.choice(self.parts) for _ in range(self.rng.randint(1, 4)))
        return w + self.marks if self.marks and self.chance(0.5) else w

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))

    def sentence(self, n: int | None = None) -> str:
        s = self.words(n or self.rng.choice((1, 2, 4, 8, 12, 18)))
        s = s[:1].upper() + s[1:]
        if self.chance(0.3):
            s = s.replace(" ", ", ", 1)
        return s + self.rng.choice("....?!") if self.chance(0.9) else s

    def prose(self, sentences: int) -> str:
        return " ".join(self.sentence() for _ in range(sentences))

    def attributes(self, kind: str) -> str:
        out = []
        if self.chance(0.8):
            names = self.rng.sample(NAMES[kind], self.rng.choice((1, 1, 2)))
            if self.chance(0.2):
                names = [n.replace("-", "_") for n in names]
            out.append(f'{self.rng.choice(("class", "class", "id"))}="{" ".join(names)}"')
        if kind in ROLES and self.chance(0.15):
            out.append(f'role="{ROLES[kind]}"')
        return " " + " ".join(out) if out else ""

    def element(self, kind: str, inside: str, main: bool = False) -> str:
        tag = self.rng.choice(TAGS[kind])
        attrs = self.attributes(kind)
        # without a telling tag, a name or a role there is nothing to go by
        if not attrs and tag in ("div", "section", "ul", "ol", "p", "ins", "dialog") and not main:
            attrs = f' class="{self.rng.choice(NAMES[kind])}"'
        if tag in ("ul", "ol"):
            inside = "".join(f"<li>{x}</li>" for x in inside.split("\x00"))
        inside = inside.replace("\x00", "\n")
        return f"<{tag}{attrs}{' data-main' if main else ''}>{inside}</{tag}>"

    def link(self, text: str) -> str:
        return f'<a href="/{self.rng.randrange(1000)}">{text}</a>'

    def phrase(self, kind: str) -> str:
        own = PHRASES[kind].split("|")
        return self.rng.choice(own) if self.chance(0.5) else self.words(self.rng.randint(1, 4))

    # parts that are not the article -------------------------------------
    def menu(self) -> str:
        items = [self.link(self.phrase("menu")) for _ in range(self.rng.randint(1, 8))]
        if self.chance(0.5):
            return self.element("menu", "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>") \
                .replace("<li><ul>", "<ul>").replace("</ul></li>", "</ul>")
        return self.element("menu", "\x00".join(items))

    def header(self) -> str:
        inside = [f"<h1>{self.phrase('header')}</h1>" if self.chance(0.5) else self.link(self.phrase("header"))]
        if self.chance(0.5):
            inside.append(f"<p>{self.sentence()}</p>")
        if self.chance(0.4):
            inside.append(self.menu())
        return self.element("header", "\x00".join(inside))

    def footer(self) -> str:
        inside = [self.phrase("footer"), self.prose(self.rng.randint(0, 2))]
        if self.chance(0.3):
            inside = [f"<p>{x}</p>" for x in inside]
        if self.chance(0.4):
            inside.append(self.link(self.phrase("footer")))
        return self.element("footer", "\x00".join(inside))

    def sidebar(self) -> str:
        inside = [f"<h3>{self.phrase('sidebar')}</h3>"]
        if self.chance(0.6):
            inside.append("<ul>" + "".join(f"<li>{self.link(self.sentence())}</li>"
                                           for _ in range(self.rng.randint(1, 6))) + "</ul>")
        if self.chance(0.5):
            inside.append(f"<p>{self.prose(self.rng.randint(1, 3))}</p>")
        return self.element("sidebar", "\x00".join(inside))

    def notice(self) -> str:
        inside = [f"<p>{self.prose(self.rng.randint(1, 3))}</p>" if self.chance(0.5) else self.phrase("notice")]
        if self.chance(0.6):
            inside.append(f"<button>{self.phrase('notice')}</button>")
        return self.element("notice", "\x00".join(inside))

    def advert(self) -> str:
        text = self.prose(self.rng.randint(1, 3)) if self.chance(0.7) else self.phrase("advert")
        return self.element("advert", self.link(text) if self.chance(0.3) else
                            f"<p>{text}</p>" if self.chance(0.3) else text)

    def form(self) -> str:
        inside = [f"<label>{self.phrase('form')}</label>", '<input type="text">',
                  f"<button>{self.phrase('form')}</button>", f"<p>{self.prose(1)}</p>",
                  f"<select><option>{self.word()}<option>{self.word()}</select>",
                  f"<textarea>{self.words(3)}</textarea>", f"<fieldset><legend>{self.word()}</legend></fieldset>"]
        return self.element("form", "\x00".join(self.rng.sample(inside, self.rng.randint(2, 4))))

    def comments(self) -> str:
        inside = [f"<h2>{self.phrase('comments')}</h2>"] if self.chance(0.6) else []
        for _ in range(self.rng.randint(1, 5)):
            tag = self.rng.choice(("div", "li", "article", "p"))
            by = f"<b>{self.word()}</b> {self.phrase('comments')}" if self.chance(0.6) else ""
            said = self.prose(self.rng.randint(1, 4))
            inside.append(f"<p>{said}</p>" if self.chance(0.3) else
                          f"<{tag}{self.attributes('comments')}>{by}" + (f"<p>{said}</p>" if tag != "p" else " " + said)
                          + f"</{tag}>")
        if self.chance(0.3):
            inside.append(self.form())
        return self.element("comments", "\x00".join(inside))

    def share(self) -> str:
        return self.element("share", "\x00".join(self.link(self.phrase("share")) if self.chance(0.6)
                                                 else self.phrase("share") for _ in range(self.rng.randint(1, 4))))

    def other(self, kinds: tuple[str, ...]) -> str:
        return getattr(self, self.rng.choice(kinds))()

    # the article -----------------------------------------------------------
    def main_block(self) -> str:
        r = self.rng.random()
        if r < 0.62:
            text = self.prose(self.rng.choice((1, 1, 2, 4, 8)))
            if self.chance(0.2):
                text = f"<b>{self.word()}</b> {text}"
            if self.chance(0.15):
                text += f" {self.link(self.words(2))} {self.sentence()}"
            if self.chance(0.1):
                text += f"<br>{self.sentence()}"
            if self.chance(0.15):                    # never closed
                return f"<p data-main><b>{text}<br>"
            return f"<p data-main>{text}</p>"
        if r < 0.75:
            tag = self.rng.choice(("h2", "h2", "h3", "h4"))
            return f"<{tag} data-main>{self.sentence(self.rng.randint(1, 8)).rstrip('.')}</{tag}>"
        if r < 0.84:
            tag = self.rng.choice(("ul", "ol"))
            return f"<{tag} data-main>" + "".join(f"<li>{self.prose(1)}</li>"
                                                  for _ in range(self.rng.randint(1, 5))) + f"</{tag}>"
        if r < 0.90:
            return f"<blockquote data-main>{self.prose(2)}</blockquote>"
        if r < 0.93:
            return f"<pre data-main>{self.words(6)}\n  {self.words(4)}</pre>"
        if r < 0.96:
            return "<table data-main>" + "".join(f"<tr><td>{self.word()}</td><td>{self.words(2)}</td></tr>"
                                                 for _ in range(self.rng.randint(1, 4))) + "</table>"
        if r < 0.98:
            return f'<figure data-main><img src="x.png" alt="{self.word()}"><figcaption>{self.sentence()}</figcaption></figure>'
        return f"<div data-main>{self.prose(2)}</div>"

    def plain_article(self) -> str:
        """Text right inside the container."""
        text = self.rng.choice((" ", "<br>", "<br><br>\n")).join(
            self.prose(self.rng.choice((1, 3, 8))) for _ in range(self.rng.randint(1, 4)))
        return f"<{(tag := self.rng.choice(TAGS['main']))}{self.attributes('main')} data-main>{text}</{tag}>"

    def article(self) -> str:
        if self.chance(0.1):
            return self.plain_article()
        title = f"<h1 data-main>{self.sentence(self.rng.randint(1, 12))}</h1>"
        out = []
        if self.chance(0.85):
            out.append(f"<header>{title}</header>" if self.chance(0.15) else title)
        if self.chance(0.25):
            out.append(self.share())
        for _ in range(self.rng.choice((1, 2, 3, 5, 8, 12, 20))):
            out.append(self.main_block())
            if self.chance(0.12):
                out.append(self.other(("advert", "advert", "sidebar", "form", "notice", "share", "comments", "menu")))
        while self.chance(0.45):
            out.append(self.other(("share", "sidebar", "comments", "comments", "footer", "form", "advert", "notice")))
        inside = "\n".join(out) if self.chance(0.5) else "".join(out)
        tag = self.rng.choice(TAGS["main"])
        return f"<{tag}{self.attributes('main')}>{inside}</{tag}>"

    def page(self) -> str:
        head = f"<head><title>{self.sentence()}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head>"
        before = [getattr(self, k)() for k, p in (("notice", .25), ("header", .5), ("menu", .75), ("advert", .4),
                                                  ("form", .2), ("sidebar", .2)) if self.chance(p)]
        after = [getattr(self, k)() for k, p in (("comments", .35), ("share", .15), ("sidebar", .35),
                                                 ("advert", .25), ("form", .2), ("notice", .15),
                                                 ("footer", .8)) if self.chance(p)]
        if self.chance(0.3):
            self.rng.shuffle(before)
        body = [*before, self.article(), *after]
        if self.chance(0.3):
            at = len(before)
            body[at] = f"<div class=\"{self.rng.choice(('wrapper', 'container', 'page', 'row', 'layout'))}\">" \
                f"{body[at]}{self.sidebar() if self.chance(0.4) else ''}</div>"
        return f"<!DOCTYPE html><html>{head}<body>{(chr(10) if self.chance(0.4) else '').join(body)}</body></html>"


def training_pages(count: int, seed: int = 11) -> list[str]:
    return [_Draw(random.Random(f"{seed}:{i}")).page() for i in range(count)]
