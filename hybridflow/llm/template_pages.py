"""Made-up pages with known main text, by which the node classifier is trained.

A page is drawn from a seed: which semantic elements it uses, how classes are named, which kinds of
surroundings it has, and in what order. Leaves of the main text carry ``data-truth``, which the
node descriptions ignore.
"""

from __future__ import annotations

import random

SYLLABLES = "an be co da en fi go ha in ja ko le ma no or pa qu re sa ti un va we xa yo zu ther ing tion est".split()
MAIN = "content main post entry article story body text page-body".split()
NEUTRAL = "box wrap col row inner block container c1 s-2 grid x".split()
TITLES = "Menu Home About Login Search Related Share Comments Subscribe Tags Archive Contact".split()


class Draw(random.Random):
    def word(self) -> str:
        return "".join(self.choice(SYLLABLES) for _ in range(self.randint(1, 4)))

    def words(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.randint(a, b)))

    def label(self) -> str:
        """A few words, now and then with the marks of running text."""
        return self.words(1, 3) + self.choice(["", "", "", ".", ","])

    def brief(self, a: int, b: int) -> str:
        """Prose, or less than a sentence."""
        return self.words(1, 4).capitalize() + "." if self.random() < 0.3 else self.prose(a, b)

    def sentence(self) -> str:
        return self.words(4, 18).capitalize() + self.choice(".....?!")

    def prose(self, a: int = 1, b: int = 6) -> str:
        parts = []
        for _ in range(self.randint(a, b)):
            s = self.sentence()
            if self.random() < 0.12:
                s = f'{self.words(1, 5)} <a href="/{self.word()}">{self.words(1, 3)}</a> {s}'
            if self.random() < 0.08:
                s = f"<{(t := self.choice(['b', 'em', 'i', 'strong', 'code']))}>{self.words(1, 4)}</{t}> {s}"
            parts.append(s)
        return " ".join(parts)

    def naming(self, words: str) -> str:
        name = self.choice(words.split())
        name = self.choice(["", "", "site-", "page-", "the-"]) + name + self.choice(["", "", "-box", "-1", "-wrap", "_item"])
        return f' class="{name}"' if self.random() < 0.75 else f' id="{name}"'

    def links(self, a: int = 3, b: int = 9) -> str:
        items = "".join(f'<li><a href="/{self.word()}">{self.label()}</a></li>' for _ in range(self.randint(a, b)))
        if self.random() < 0.3:
            return items.replace("<li>", "").replace("</li>", " | ")
        return f"<ul>{items}</ul>"


def main_part(d: Draw) -> str:
    """Leaves of the article, each marked."""
    mark = ' data-truth="1"'
    out = []
    if d.random() < 0.85:
        out.append(f"<h1{mark}>{d.words(2, 10).capitalize()}</h1>")
    if d.random() < 0.2:
        out.append(f"<p{mark}><b>{d.prose(1, 2)}<br>")
    if tiny := d.random() < 0.15:
        out = [f"<h1{mark}>{d.sentence()}</h1>"] if d.random() < 0.8 else []
    for _ in range(1 if tiny else d.randint(1, 14)):
        kind = d.random() * (0.68 if tiny else 1)
        if kind < 0.68:
            text = d.prose(1, 1 if tiny else 8) if d.random() < 0.8 else d.words(1, 4).capitalize() + "."
            out.append(f"<p{mark}>{text}" + ("</p>" if d.random() < 0.8 else ""))
        elif kind < 0.78:
            out.append(f"<h2{mark}>{d.words(1, 7)}</h2>")
        elif kind < 0.84:
            out.append("<ul>" + "".join(f"<li{mark}>{d.words(2, 14)}</li>" for _ in range(d.randint(2, 7))) + "</ul>")
        elif kind < 0.88:
            out.append(f"<blockquote{mark}>{d.prose(1, 3)}</blockquote>")
        elif kind < 0.91:
            out.append(f"<pre{mark}>{d.words(4, 30)}</pre>")
        elif kind < 0.94:
            rows = "".join(f"<tr><td{mark}>{d.words(1, 4)}</td><td{mark}>{d.randint(1, 999)}</td></tr>" for _ in range(d.randint(2, 5)))
            out.append(f"<table>{rows}</table>")
        elif kind < 0.96:
            out.append(f'<figure><img src="x.png"><figcaption{mark}>{d.sentence()}</figcaption></figure>')
        elif kind < 0.98:
            out.append(f"<div{mark}>{d.prose(1, 4)}</div>")
        else:
            out.append(advert(d))
    return "".join(out)


def advert(d: Draw) -> str:
    tag = d.choice(["div", "div", "aside", "p", "section"])
    return f"<{tag}{d.naming('ad ad ads advert sponsored banner promo')}>{d.brief(1, 4)}</{tag}>"


def menu(d: Draw) -> str:
    tag = d.choice(["nav", "nav", "div", "ul"])
    name = "" if tag == "nav" and d.random() < 0.6 else d.naming("nav menu navigation breadcrumb toolbar pager")
    return f"<{tag}{name}>{d.links().replace('<ul>', '').replace('</ul>', '') if tag == 'ul' else d.links()}</{tag}>"


def header(d: Draw) -> str:
    inside = (f"<h1>{d.words(1, 3)}</h1>" if d.random() < 0.4 else f"<div>{d.words(1, 4)}</div>") + (menu(d) if d.random() < 0.5 else "")
    if d.random() < 0.4:
        inside += f"<p>{d.sentence()}</p>"
    return f"<header>{inside}</header>" if d.random() < 0.6 else f"<div{d.naming('header masthead head')}>{inside}</div>"


def footer(d: Draw) -> str:
    inside = f"&copy; {d.words(1, 3)} &middot; {d.brief(1, 3)}" + (d.links(2, 5) if d.random() < 0.4 else "")
    if d.random() < 0.3:
        inside = f"<p>{inside}</p>"
    return f"<footer>{inside}</footer>" if d.random() < 0.65 else f"<div{d.naming('footer copyright legal foot')}>{inside}</div>"


def sidebar(d: Draw) -> str:
    inside = f"<h3>{d.choice(TITLES)}</h3>{d.links()}" + (f"<p>{d.prose(1, 3)}</p>" if d.random() < 0.5 else "")
    return f"<aside>{inside}</aside>" if d.random() < 0.5 else f"<div{d.naming('sidebar widget related recommended aside')}>{inside}</div>"


def notice(d: Draw) -> str:
    tag = d.choice(["div", "section", "dialog"])
    button = f"<button>{d.word()}</button>" if d.random() < 0.6 else ""
    return f"<{tag}{d.naming('cookie consent notice alert popup modal')}><p>{d.brief(1, 3)}</p>{button}</{tag}>"


def form(d: Draw) -> str:
    fields = "".join(f'<label>{d.words(1, 3)}</label><input name="{d.word()}">' for _ in range(d.randint(1, 4)))
    inside = f"<p>{d.sentence()}</p>{fields}<button>{d.word()}</button>"
    return f"<form{d.naming('search login signup subscribe newsletter') if d.random() < 0.6 else ''}>{inside}</form>"


def talk(d: Draw) -> str:
    each = [
        f"<{(t := d.choice(['div', 'li', 'article']))}{d.naming('comment reply') if d.random() < 0.7 else ''}><b>{d.word()}</b><p>{d.brief(1, 4)}</p></{t}>"
        for _ in range(d.randint(1, 5))
    ]
    tag = d.choice(["div", "section", "ol"])
    return f"<{tag}{d.naming('comments discussion replies respond')}><h3>{d.choice(TITLES)}</h3>{''.join(each)}</{tag}>"


def page(seed: int) -> str:
    d = Draw(seed)
    body = main_part(d) if d.random() < 0.97 else ""
    style = d.random()
    inside = [talk(d)] if d.random() < 0.12 else []
    inside += [advert(d)] if d.random() < 0.12 else []
    if style < 0.5:
        body = f"<article{d.naming(' '.join(MAIN)) if d.random() < 0.3 else ''}>{body}{''.join(inside)}</article>"
    elif style < 0.8:
        body = f"<div{d.naming(' '.join(MAIN))}>{body}{''.join(inside)}</div>"
    elif style < 0.9:
        body = f"<div{d.naming(' '.join(NEUTRAL))}>{body}{''.join(inside)}</div>"
    if d.random() < 0.35:
        body = f"<main>{body}</main>"
    if d.random() < 0.3:
        body = f"<div{d.naming(' '.join(NEUTRAL))}>{body}</div>"
    before = [f(d) for f in (header, menu, notice, advert, advert, form, sidebar) if d.random() < 0.4]
    after = [f(d) for f in (talk, sidebar, advert, form, footer, footer, notice, menu) if d.random() < 0.35]
    d.shuffle(before)
    d.shuffle(after)
    if d.random() < 0.2:
        side = sidebar(d)
        body = f'<div class="row">{body}{side}</div>' if d.random() < 0.5 else f'<div class="row">{side}{body}</div>'
    head = f"<head><title>{d.words(2, 6)}</title><style>p{{}}</style><script>var a='<p>';</script></head>"
    return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{body}{''.join(after)}</body></html>"
