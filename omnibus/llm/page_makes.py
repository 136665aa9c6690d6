"""Labelled pages of many makes, composed from parts at random but the same in each run.

``data-y`` says whether an element's text is main text, for all below it, as in ``html_examples``.
Wording is of no matter to the model, so texts are words of random number.
"""

from __future__ import annotations

import random

WORDS = "the a of river stone bread market evening north engine paper glass window seven old bright they made found under".split()
NAMES = ("", " class=main-content", " class=post-body", " id=content", " class=entry", " class='col-8 story'", " class=c12")


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high))).capitalize()


def _sentences(rng: random.Random, low: int = 1, high: int = 5) -> str:
    return " ".join(_words(rng, 3, 18) + rng.choice("...!?") for _ in range(rng.randint(low, high)))


def _link(rng: random.Random, text: str) -> str:
    return f"<a href=/{rng.randint(1, 999)}>{text}</a>"


def _links(rng: random.Random, tag: str = "li") -> str:
    return "".join(f"<{tag}>{_link(rng, _words(rng, 1, 4))}</{tag}>" for _ in range(rng.randint(1, 7)))


def _main_block(rng: random.Random) -> str:
    kind = rng.random()
    if kind < 0.5:
        return f"<p>{_sentences(rng)}</p>"
    if kind < 0.58:
        return f"<p>{_sentences(rng, 0, 2)} {_link(rng, _sentences(rng, 1, 1))} {_sentences(rng, 0, 1)}</p>"
    if kind < 0.66:
        tag, item = rng.choice(["ul", "ol"]), rng.choice([_links, None, None])
        return f"<{tag}>{item(rng) if item else ''.join(f'<li>{_words(rng, 1, 9)}' for _ in range(rng.randint(1, 5)))}</{tag}>"
    if kind < 0.74:
        return f"<h{(n := rng.randint(2, 4))}>{_words(rng, 1, 7)}</h{n}>"
    if kind < 0.78:
        return f"<blockquote><p>{_sentences(rng)}</p></blockquote>"
    if kind < 0.82:
        return f"<pre>{_words(rng, 3, 20)}</pre>"
    if kind < 0.86:
        return f"<table><tr><th>{_words(rng, 1, 2)}<th>{_words(rng, 1, 2)}<tr><td>{_words(rng, 1, 6)}<td>{rng.randint(1, 99)}</table>"
    if kind < 0.9:
        return f"<figure><img src=a><figcaption>{_words(rng, 3, 12)}</figcaption></figure>"
    if kind < 0.94:
        return f"<dl><dt>{_words(rng, 1, 2)}<dd>{_words(rng, 2, 12)}</dl>"
    return f"<div>{_sentences(rng, 1, 3)}</div>"


def _aside_block(rng: random.Random) -> str:
    """What stands between the blocks of an article without being part of it."""
    text = f"<p>{_sentences(rng, 1, 3)}</p>"
    return rng.choice([
        f"<div class={rng.choice(['ad', 'advert', 'ad-slot', 'sponsored', 'promo-box'])} data-y=0>{rng.choice([text, _sentences(rng, 1, 2), _link(rng, _words(rng, 2, 6))])}</div>",
        f"<aside data-y=0>{text}</aside>",
        f"<div class={rng.choice(['share', 'social-links', 'related', 'tags', 'newsletter'])} data-y=0>{rng.choice([text, _links(rng, 'span')])}</div>",
        f"<form data-y=0><p>{_words(rng, 3, 9)}.</p><label>{_words(rng, 1, 2)}</label><input><button>{_words(rng, 1, 2)}</button></form>",
        f"<footer data-y=0><p>{_words(rng, 2, 9)}</p></footer>",
        f"<nav data-y=0><ul>{_links(rng)}</ul></nav>",
    ])


def _comments(rng: random.Random) -> str:
    item = lambda: rng.choice([
        f"<div class=comment><p>{_sentences(rng)}</p></div>", f"<li class=comment-body>{_sentences(rng)}</li>",
        f"<article class=comment><header>{_words(rng, 1, 2)}</header><p>{_sentences(rng)}</p></article>",
    ])
    inside = f"<h3>{_words(rng, 1, 3)}</h3>" + "".join(item() for _ in range(rng.randint(1, 5)))
    tag, name = rng.choice([
        ("section", "class=comments"), ("div", "id=comments"), ("div", "class='comment-list'"), ("ol", "class=commentlist"),
        ("section", "id=reader-comments"), ("div", "class=replies"),
    ])
    return f"<{tag} {name} data-y=0>{inside}</{tag}>"


def _main(rng: random.Random) -> str:
    blocks = [_main_block(rng) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 6, 8]))]
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        blocks.insert(rng.randint(1, len(blocks)), _aside_block(rng))
    if rng.random() < 0.15:
        blocks = [f"<div>{''.join(blocks)}</div>"]
    plain = title = f"<h{(n := rng.choice([1, 1, 1, 2]))}>{_words(rng, 1, 9)}</h{n}>"
    if rng.random() < 0.25:
        title = f"<header{rng.choice(['', ' class=page-header', ' class=entry-header', ' class=head'])}>{title}{rng.choice(['', f'<p>{_words(rng, 2, 9)}</p>'])}</header>"
    inside = (title if rng.random() < 0.85 else "") + "".join(blocks)
    if rng.random() < 0.15:
        inside += _comments(rng)
    make = rng.random()
    if make < 0.25:
        return f"<article{rng.choice(NAMES)} data-y=1>{inside}</article>"
    if make < 0.35:
        return f"<main data-y=1>{inside}</main>"
    if make < 0.45:
        return f"<main><article data-y=1>{inside}</article></main>"
    if make < 0.65:
        return f"<div{rng.choice(NAMES)} data-y=1>{inside}</div>"
    if make < 0.72:
        return f"<section{rng.choice(NAMES)} data-y=1>{inside}</section>"
    if make < 0.76:
        return f"<table><tr><td data-y=1>{inside}</td></tr></table>"
    # Blocks that stand in the page itself.
    return "".join(b if "data-y" in b.split(">")[0] else b.replace(">", " data-y=1>", 1) for b in [plain, *blocks])


def _top(rng: random.Random) -> list[str]:
    site = f"{_link(rng, _words(rng, 1, 3))}<p>{_words(rng, 2, 9)}{rng.choice(['', '.'])}</p>"
    return [
        rng.choice([f"<header>{site}</header>", f"<div id=header>{site}</div>", f"<div class=masthead><h2>{_words(rng, 1, 3)}</h2></div>",
                    f"<header class=site-header><h1>{_words(rng, 1, 3)}</h1></header>", "", ""]),
        rng.choice([f"<nav><ul>{_links(rng)}</ul></nav>", f"<div class=menu>{_links(rng, 'span')}</div>", f"<ul class=navbar>{_links(rng)}</ul>",
                    f"<nav class=breadcrumb>{_links(rng, 'span')}</nav>", f"<nav><ul>{_links(rng)}</ul></nav>", "", ""]),
        rng.choice([f"<div class={rng.choice(['ad', 'banner', 'advertisement'])}>{_sentences(rng, 1, 2)}</div>", "", "", ""]),
        rng.choice([f"<div class='{rng.choice(['cookie-notice', 'consent', 'popup modal', 'alert'])}'><p>{_sentences(rng, 1, 3)}</p><button>{_words(rng, 1, 2)}</button></div>", "", "", ""]),
    ]


def _bottom(rng: random.Random) -> list[str]:
    return [
        rng.choice([_comments(rng), "", ""]),
        rng.choice([f"<aside><h3>{_words(rng, 1, 2)}</h3><p>{_sentences(rng, 1, 2)}</p></aside>", f"<div class=sidebar><ul>{_links(rng)}</ul></div>",
                    f"<div class=widget><p>{_sentences(rng, 1, 2)}</p></div>", f"<div class=related-posts><ul>{_links(rng)}</ul></div>", "", "", ""]),
        rng.choice([f"<footer>&copy; {_words(rng, 1, 6)}{rng.choice(['', '.'])}</footer>", f"<footer><p>{_sentences(rng, 1, 2)}</p><ul>{_links(rng)}</ul></footer>",
                    f"<div id=footer><p>{_sentences(rng, 1, 2)}</p></div>", f"<p class=copyright>&copy; {_words(rng, 2, 6)}</p>",
                    f"<div>{_links(rng, 'span')}</div>", "", ""]),
    ]


def page(rng: random.Random) -> str:
    """One page; with nothing but its main text in one of six."""
    if rng.random() < 0.06:
        return f"<html><body data-y=1>{_sentences(rng)}{rng.choice(['', '<br><br>' + _sentences(rng)])}</body></html>"
    around = rng.random() > 1 / 6
    parts = [*(_top(rng) if around else []), _main(rng), *(_bottom(rng) if around else [])]
    if around and rng.random() < 0.2:
        # A side column may stand before the text.
        parts.insert(1, parts.pop(-2))
    body = "".join(parts)
    if rng.random() < 0.3:
        body = f"<div class={rng.choice(['wrapper', 'page', 'container', 'site-content', 'has-sidebar'])}>{body}</div>"
    return f"<html><head><title>t</title></head><body{rng.choice(['', '', ' class=single-post', ' class=nav-open'])} data-y=0>{body}</body></html>"


def pages(count: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return [page(rng) for _ in range(count)]
