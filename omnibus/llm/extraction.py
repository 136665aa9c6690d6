"""Main text of web pages: a tree-structured graphical model over the block tree.

Each block element is a node with two states, main text or not.  Its own
features give its potential, and each parent and child a potential that depends
on the kind of child.  Sum-product messages go from the leaves up to the root
and back down, which gives each node's exact marginal; text whose node is more
likely main text than not is kept, in page order, one line per block.

Weights are learned by gradient ascent on the likelihood of labelled pages,
with the same messages: pages labelled by hand, ``MADE_PAGES`` pages composed of
labelled parts, and at most ``SAMPLE_PAGES`` pages of the table, chosen by a hash
of their id, that mark their main text with one <article> or <main> and so label
themselves.  Each of these three sources weighs as much as the others.

Defined cases: NULL html is an empty page; a page without main text gets the
empty string and 0.  White space is what Python's split() takes for it.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omnibus.llm import page_makes
from omnibus.llm.dom import Page
from omnibus.llm.html_examples import PAGES

SAMPLE_PAGES = 60
MADE_PAGES = 240
EPOCHS = 30
_RATE, _DECAY = 0.4, 0.0005

GROUPS = {
    "article": "article main", "nav": "nav menu", "head": "header hgroup", "foot": "footer address", "aside": "aside dialog",
    "form": "form fieldset select option textarea button legend", "title": "h1 h2 h3 h4 h5 h6",
    "text": "p blockquote pre figcaption dd dt", "list": "ul ol dl li", "table": "table tbody thead tr td th caption",
    "box": "div section figure center details summary", "page": "html body root",
}
_GROUP_OF = {tag: group for group, tags in GROUPS.items() for tag in tags.split()}
_LANDMARKS = ("article", "nav", "head", "foot", "aside", "form")
_HINT_NAMES = ("advert", "menu", "comment", "foot", "side", "notice", "head", "main")
_NAMES = [
    *(f"tag:{g}" for g in GROUPS), *(f"hint:{h}" for h in _HINT_NAMES), *(f"under:{h}" for h in _HINT_NAMES),
    *(f"in:{m}" for m in (*_LANDMARKS, "nothing", "head of article", "foot of article", "named part of article")),
    "bias", "has text", "length", "sentence", "own links", "all links", "share", "bare page", "no article",
    "loose text", "loose sentence", "loose links", "loose page text", "beside title", "beside sentence", "loose beside sentence",
    "box links",
]
_ENDS = ".!?:\"'»”"
_AT = {name: i for i, name in enumerate(_NAMES)}
WIDE = 0.7
#: Kinds of child that have a table of their own: text blocks, boxes, landmarks.
KINDS = 3


class Tree:
    """A page's nodes with what the model sees of them: sparse features and kinds."""

    def __init__(self, page: Page):
        self.parents = page.parents
        n = len(page.tags)
        groups = [_GROUP_OF.get(tag, "box") for tag in page.tags]
        chars, links = page.chars[:], page.link_chars[:]
        # Names of a box around the page's heading, its <main> or most of its text say little about what is in it.
        titled = [tag in ("h1", "main") for tag in page.tags]
        for i in range(n - 1, 0, -1):
            p = page.parents[i]
            chars[p] += chars[i]
            links[p] += links[i]
            titled[p] |= titled[i]
        bare = not any(g in _LANDMARKS for g in groups) and not any(h - {"main"} for h in page.hints)
        articles = any(g == "article" and "comment" not in h for g, h in zip(groups, page.hints))
        last = dict(page.runs)
        # Boxes that hold a heading, or a sentence outside of links.
        title_in, sentence_in = [False] * n, [False] * n
        for i in range(1, n):
            title_in[page.parents[i]] |= groups[i] == "title" and page.link_chars[i] == 0 < page.chars[i]
            spoken = page.chars[i] > page.link_chars[i] and last[i][-1] in _ENDS and groups[i] != "title"
            sentence_in[page.parents[i]] |= spoken
        self.kinds, self.features = [0] * n, []
        hints: list[frozenset] = []
        under: list[frozenset] = []
        places: list[str] = []
        for i in range(n):
            p, group = page.parents[i], groups[i]
            place, above = (places[p], under[p]) if i else ("nothing", frozenset())
            own = page.hints[i]
            if titled[i] or group == "page":
                own &= {"main"}
            elif chars[i] > WIDE * chars[0]:
                own &= {"main", "comment"}
            if place == "article":
                # The head of an article is its title, not the page's.
                own -= {"head"}
            if group in _LANDMARKS:
                inner = place in ("article", "head of article", "foot of article") and group in ("head", "foot")
                place = f"{group} of article" if inner else group
            if place == "article" and own - {"main"}:
                place = "named part of article"
            hints.append(own)
            under.append(above | own)
            places.append(place)
            if group in _LANDMARKS and place != "head of article" or own - {"main"}:
                self.kinds[i] = 2
            elif group not in ("text", "title", "list", "table"):
                self.kinds[i] = 1
            found = [(_AT["bias"], 1.0), (_AT["tag:" + group], 1.0), (_AT["in:" + place], 1.0)]
            found += [(_AT["hint:" + h], 1.0) for h in own] + [(_AT["under:" + h], 1.0) for h in above]
            if page.chars[i]:
                found.append((_AT["has text"], 1.0))
                found.append((_AT["length"], min(1.0, page.chars[i] / 200)))
                found.append((_AT["own links"], page.link_chars[i] / page.chars[i]))
                if last[i][-1] in _ENDS:
                    found.append((_AT["sentence"], 1.0))
            if chars[i]:
                found.append((_AT["all links"], links[i] / chars[i]))
                found.append((_AT["share"], chars[i] / chars[0]))
            if bare:
                found.append((_AT["bare page"], 1.0))
            if i and title_in[p]:
                found.append((_AT["beside title"], 1.0))
            if i and sentence_in[p]:
                found.append((_AT["beside sentence"], 1.0))
            if i and chars[p]:
                found.append((_AT["box links"], links[p] / chars[p]))
            if not articles:
                found.append((_AT["no article"], 1.0))
                if i and sentence_in[p] and place == "nothing" and not under[i] - {"main"}:
                    found.append((_AT["loose beside sentence"], 1.0))
                if page.chars[i] and place == "nothing" and not under[i] - {"main"}:
                    # Nothing names its place, on a page that names no text.
                    found.append((_AT["loose text"], 1.0))
                    found.append((_AT["loose links"], page.link_chars[i] / page.chars[i]))
                    if last[i][-1] in _ENDS:
                        found.append((_AT["loose sentence"], 1.0))
                    if group == "page":
                        found.append((_AT["loose page text"], 1.0))
            self.features.append(found)

    def marginals(self, model: tuple[list[float], list]) -> tuple[list[float], list]:
        weights, pair = model
        unary = [sum(weights[k] * v for k, v in f) for f in self.features]
        return marginals(self.parents, self.kinds, unary, pair)


def _softplus_pair(a: float, b: float) -> float:
    """log(exp a + exp b)."""
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(parents: list[int], kinds: list[int], unary: list[float], pair: list) -> tuple[list[float], list]:
    """Sum-product on the tree: P(node is main text), and for each node but the root P(parent, node) as four numbers.

    ``unary`` is the potential of state 1 (0 for state 0); ``pair[kind]`` holds the potentials of
    (parent, child) states 00, 01, 10, 11.  Nodes stand after their parents, so one pass over them
    from the end carries all messages up, and one from the start carries them down.
    """
    n = len(parents)
    in0, in1 = [0.0] * n, unary[:]  # own potential and what comes from below
    up0, up1 = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        t = pair[kinds[i]]
        up0[i] = _softplus_pair(in0[i] + t[0], in1[i] + t[1])
        up1[i] = _softplus_pair(in0[i] + t[2], in1[i] + t[3])
        in0[parents[i]] += up0[i]
        in1[parents[i]] += up1[i]
    # From here in0, in1 become beliefs: all evidence at a node.
    both: list = [None] * n
    chance = [0.0] * n
    for i in range(n):
        if i:
            t, p = pair[kinds[i]], parents[i]
            rest0, rest1 = in0[p] - up0[i], in1[p] - up1[i]
            joint = (rest0 + in0[i] + t[0], rest0 + in1[i] + t[1], rest1 + in0[i] + t[2], rest1 + in1[i] + t[3])
            top = max(joint)
            joint = [math.exp(x - top) for x in joint]
            total = sum(joint)
            both[i] = [x / total for x in joint]
            in0[i] += _softplus_pair(rest0 + t[0], rest1 + t[2])
            in1[i] += _softplus_pair(rest0 + t[1], rest1 + t[3])
        gap = in0[i] - in1[i]
        chance[i] = 1 / (1 + math.exp(gap)) if gap < 700 else 0.0
    return chance, both


def hand_labels(page: Page) -> list[int]:
    labels = []
    for i, named in enumerate(page.attributes):
        labels.append(int(named["data-y"]) if "data-y" in named else (labels[page.parents[i]] if i else 0))
    return labels


def own_labels(page: Page) -> list[int] | None:
    """Labels of a page that marks its main text itself; None if it doesn't, or more than once."""
    if sum(tag in ("article", "main") for tag in page.tags) != 1:
        return None
    labels = [0]
    for i in range(1, len(page.tags)):
        group = _GROUP_OF.get(page.tags[i], "box")
        if group == "article":
            labels.append(1)
        elif group in ("nav", "foot", "aside", "form") or page.hints[i] & {"advert", "comment", "menu", "notice", "side"}:
            labels.append(0)
        else:
            labels.append(labels[page.parents[i]])
    return labels


def learn(sources: list[list[tuple[Page, list[int]]]], epochs: int = EPOCHS) -> tuple[list[float], list]:
    """(feature weights, pair tables) of highest penalised likelihood, by adaptive gradient steps.

    ``sources`` are lists of labelled pages; each list weighs as much as any other, however long.
    """
    ready = [(1 / len(pages), Tree(page), labels) for pages in sources for page, labels in pages]
    # Sources take turns, so that none has the last word.
    ready = [ready[i] for i in sorted(range(len(ready)), key=lambda i: (i * 0.6180339887498949) % 1)]
    most = max((part for part, _, _ in ready), default=1.0)
    base = len(_NAMES)
    size = base + 4 * KINDS
    weights, squares = [0.0] * size, [1e-6] * size
    split = lambda: (weights[:base], [weights[base + 4 * k : base + 4 * k + 4] for k in range(KINDS)])
    for _ in range(epochs):
        for part, tree, labels in ready:
            slope = [-_DECAY * w for w in weights]
            chance, both = tree.marginals(split())
            scale = part / most
            for i, f in enumerate(tree.features):
                miss = (labels[i] - chance[i]) * scale
                for k, v in f:
                    slope[k] += miss * v
                if i:
                    at = base + 4 * tree.kinds[i]
                    slope[at + 2 * labels[tree.parents[i]] + labels[i]] += scale
                    for k in range(4):
                        slope[at + k] -= both[i][k] * scale
            for k in range(size):
                squares[k] += slope[k] * slope[k]
                weights[k] += _RATE * slope[k] / math.sqrt(squares[k])
    return split()


def labelled() -> list[list[tuple[Page, list[int]]]]:
    """The labelled pages that need no table: by hand, and composed of labelled parts."""
    return [[(p, hand_labels(p)) for p in map(Page, made)] for made in (PAGES, page_makes.pages(MADE_PAGES))]


def main_text(html: str | None, model: tuple[list[float], list]) -> str:
    page = Page(html or "")
    if not page.runs:
        return ""
    chance, _ = Tree(page).marginals(model)
    return "\n".join(text for node, text in page.runs if chance[node] > 0.5)


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES):
    """Learn from the labelled pages and a bounded sample of the table's self-labelled ones."""
    chosen = pages.where(F.col(html).isNotNull()).select(page_id).orderBy(F.xxhash64(page_id), page_id).limit(sample)
    ids = [r[0] for r in chosen.collect() if r[0] is not None]
    rows = pages.where(F.col(page_id).isin(ids)).select(page_id, html).dropDuplicates([page_id]).collect() if ids else []
    own = []
    for row in sorted(rows, key=lambda r: r[0]):
        page = Page(row[1] or "")
        if (labels := own_labels(page)) is not None:
            own.append((page, labels))
    return learn([*labelled(), own])


def extract(pages: DataFrame, model, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    def run(batches):
        for batch in batches:
            texts = [main_text(value.as_py(), model) for value in batch.column("html")]
            kept = batch.select(["page_id", "url"])
            yield kept.append_column("text", pa.array(texts, pa.string())).append_column(
                "n_chars", pa.array([len(t) for t in texts], pa.int64())
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    return pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    ).mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
