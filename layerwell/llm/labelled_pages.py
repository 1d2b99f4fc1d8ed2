"""Generated web pages of which it is known what is content.

They vary how a page is laid out, how its parts are named (or not named at all)
and what stands around the article, so that a model fitted on them does not
depend on one site's markup. Their words mean nothing.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

SYLLABLES = "ba ko li men ra su to ve nor esh ing and der sch que tion é ña ü ou".split()
ARTICLE_NAMES = "content article post-body entry-content story text articleBody main-content prose".split()
SIDE_NAMES = "sidebar related widget more-stories recommended side-column".split()
NOTICE_NAMES = "cookie-notice consent alert-bar gdpr-banner site-notice".split()
AD_NAMES = "ad ads advert sponsored promo-box ad-slot banner".split()
COMMENT_NAMES = "comments comment-list discussion replies".split()


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.content = rng, set()

    def words(self, low: int, high: int) -> str:
        r = self.rng
        made = ("".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))
        return " ".join(made)

    def sentence(self, low: int = 1, high: int = 25) -> str:
        text = self.words(low, high)
        return text[:1].upper() + text[1:] + self.rng.choice(".....!?")

    def kept(self, text: str) -> str:
        self.content.add(" ".join(text.split()))
        return text

    def box(self, inner: str, names: list[str], tags: str = "div section", named: float = 0.8) -> str:
        tag = self.rng.choice(tags.split())
        name = self.rng.choice(names) if self.rng.random() < named else self.rng.choice(["x1", "row", "c-7", ""])
        how = self.rng.choice(["class", "id"])
        return f'<{tag} {how}="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    def links(self, low: int = 3, high: int = 9) -> str:
        items = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.75:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.rng.choice([" | ", " "]).join(items)

    def paragraph(self) -> str:
        r = self.rng
        text = self.kept(" ".join(self.sentence() for _ in range(r.choice([1, 1, 2, 3, 5, 9]))))
        kind = r.random()
        if kind < 0.1:
            first, _, rest = text.partition(" ")
            text = f"<b>{first}</b> {rest}" if rest else f"<b>{first}</b>"
        elif kind < 0.16 and text.count(" ") > 8:
            head, _, tail = text.rpartition(" ")
            text = f'{head} <a href="/z">{tail}</a>'
        elif kind < 0.3:
            return f"<p><b>{text}<br>"
        return f"<p>{text}</p>"

    def article(self) -> str:
        r = self.rng
        parts = [f"<h1>{self.kept(self.words(2, 9))}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.78:
                parts.append(self.paragraph())
            elif kind < 0.84:
                parts.append(f"<h2>{self.kept(self.words(2, 6))}</h2>")
            elif kind < 0.9:
                items = "".join(f"<li>{self.kept(self.sentence(3, 14))}</li>" for _ in range(r.randint(2, 5)))
                parts.append(f"<ul>{items}</ul>")
            elif kind < 0.94:
                parts.append(f"<blockquote>{self.kept(self.sentence(6, 30))}</blockquote>")
            else:
                parts.append(self.box(self.sentence(3, 16), AD_NAMES, named=1))
        inner = "".join(parts)
        kind = r.random()
        if kind < 0.5:
            return f"<article>{inner}</article>"
        if kind < 0.62:
            return f"<main>{inner}</main>"
        if kind < 0.7:
            return f"<table><tr><td>{inner}</td></tr></table>"
        return self.box(inner, ARTICLE_NAMES)

    def comments(self) -> str:
        made = "".join(
            f"<div class=\"{self.rng.choice(['comment', 'reply', 'comment-body'])}\">"
            f"<p>{' '.join(self.sentence(3, 20) for _ in range(self.rng.randint(1, 4)))}</p></div>"
            for _ in range(self.rng.randint(1, 5))
        )
        return self.box(f"<h3>{self.words(1, 3)}</h3>{made}", COMMENT_NAMES, named=0.95)

    def form(self) -> str:
        fields = "".join(f"<label>{self.words(1, 4)}</label><input name=a>" for _ in range(self.rng.randint(1, 3)))
        return f"<form action=/go><p>{self.sentence(2, 10)}</p>{fields}<button>{self.words(1, 2)}</button></form>"

    def aside(self) -> str:
        inner = f"<h3>{self.words(1, 4)}</h3>" + self.rng.choice([self.links(), f"<p>{self.sentence(3, 20)}</p>"])
        return f"<aside>{inner}</aside>" if self.rng.random() < 0.5 else self.box(inner, SIDE_NAMES)

    def footer(self) -> str:
        inner = f"&copy; {self.words(1, 3)} &middot; {' '.join(self.sentence(1, 12) for _ in range(self.rng.randint(1, 3)))}"
        if self.rng.random() < 0.4:
            inner = self.links() + f"<p>{inner}</p>"
        return f"<footer>{inner}</footer>" if self.rng.random() < 0.7 else self.box(inner, ["footer", "site-foot"])

    def whole(self) -> str:
        r = self.rng
        maybe = lambda part, chance: part() if r.random() < chance else ""
        if r.random() < 0.08:  # nothing but the text
            bare = self.kept(" ".join(self.sentence() for _ in range(r.randint(1, 5))))
            inner = bare if r.random() < 0.4 else "".join(self.paragraph() for _ in range(r.randint(1, 6)))
            return f"<html><body>{inner}</body></html>" if r.random() < 0.5 else inner
        nav = lambda: f"<nav>{self.links()}</nav>" if r.random() < 0.7 else self.box(self.links(), ["menu", "nav"])
        body = "".join([
            maybe(lambda: self.box(f"<p>{self.sentence(4, 25)}</p><button>{self.words(1, 2)}</button>", NOTICE_NAMES), 0.35),
            maybe(lambda: f"<header><p>{self.words(1, 5)}</p></header>", 0.4),
            maybe(nav, 0.85),
            maybe(lambda: self.box(self.links(2, 4), ["breadcrumbs"]), 0.2),
            maybe(lambda: self.box(self.sentence(2, 16), AD_NAMES), 0.6),
            self.article(),
            maybe(self.aside, 0.4),
            maybe(self.comments, 0.4),
            maybe(self.form, 0.3),
            maybe(self.footer, 0.85),
        ])
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title></head><body>{body}</body></html>"


def labelled_pages(count: int, seed: int) -> Iterator[tuple[str, set[str]]]:
    """Pages, and the texts of those of their blocks that are content."""
    rng = random.Random(seed)
    for _ in range(count):
        page = _Page(rng)
        yield page.whole(), page.content
