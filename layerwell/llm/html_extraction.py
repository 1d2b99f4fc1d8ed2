"""HTML extraction with a tree-structured graphical model.

The page becomes a tree of block elements with runs of text as leaves. Every
node is content or not; it has a potential from its features, and every edge has
one from the kinds of both ends. Sum-product messages, once up and once down the
tree, give exact marginals, so a run of text is judged by itself, by what holds
it, and by its neighbours. The weights are those of a conditional random field,
fitted by gradient ascent (observed less expected features) on labelled pages.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import batch_of, columns, hash_below, in_batches
from layerwell.llm.labelled_pages import labelled_pages

LABELLED_PAGES = 400  # generated pages that the model is fitted on
TABLE_PAGES = 200  # and pages of the table that mark their article, at most
EPOCHS = 30
SEED = 10

# Elements by their part in a page.
GROUPS = {
    "article": "article main",
    "chrome": "nav menu header footer aside dialog",
    "form": "form fieldset button select option label textarea input legend",
    "heading": "h1 h2 h3 h4 h5 h6",
    "text": "p blockquote pre",
    "list": "ul ol dl",
    "item": "li dt dd",
    "table": "table thead tbody tfoot tr td th caption",
    "box": "div section center figure figcaption details summary address hgroup",
    "page": "html body",
}
GROUP_OF = {tag: group for group, tags in GROUPS.items() for tag in tags.split()}
RAW = "script style iframe title"  # may run to the end of the page, as in browsers
SKIPPED = "noscript template svg object canvas"  # nothing, unless closed in their block
CLOSED_BY = {  # open elements that a start tag ends
    "li": "p li", "dt": "p dt dd", "dd": "p dt dd", "tr": "p td th tr", "td": "p td th",
    "th": "p td th", "option": "option",
}
CLOSES_P = set(GROUP_OF) - {"button", "label", "select", "option", "input", "textarea", "legend"}
GOOD_NAMES = "article content entry story post text body main page prose"
BAD_NAMES = (
    "nav menu side sidebar aside foot footer head header masthead banner ad ads advert advertisement"
    " sponsor sponsored promo cookie cookies consent gdpr notice alert popup modal overlay comment"
    " comments reply replies discussion respond share social related recommended more teaser widget"
    " subscribe newsletter signup login search breadcrumb breadcrumbs pagination pager tags meta"
    " legal copyright toolbar form disclaimer"
)
_GOOD, _BAD = set(GOOD_NAMES.split()), set(BAD_NAMES.split())

# Markup from a "<" on. A quoted value may hold any character; in the second
# form, for pages whose quotes do not close, a tag with quotes ends before the next "<".
_MARKUP, _PLAIN_MARKUP = (
    re.compile(
        r"<!--.*?(?:-->|\Z)"
        rf"|<({'|'.join(RAW.split())})\b[^>]*+(?:(?<=/)>|>.*?(?:</\1\s*>|\Z))"
        rf"|<(/?)([a-z][a-z0-9]*)(?:((?:{bare}++|\"{value}*+\"|'{single}*+')*+)>|([^>]*+)>)"
        r"|<[!?/][^>]*+>",
        re.I | re.S,
    )
    for bare, value, single in (("[^>\"']", '[^"]', "[^']"), ("[^<>\"']", '[^"<]', "[^'<]"))
)
_ODD_TAGS = 50  # tags with quotes that do not close, from which the second form holds
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS = re.compile(r"[.!?…:;][\"'”’»)]*$")


@dataclass
class Node:
    parent: int
    group: str  # of an element, or "run" for text
    names: str = ""
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    tag: str = ""


def markup(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """Start, end, tag (none of a comment and the like), whether it is an end tag,
    and attributes of each piece of markup, in one sweep over the page."""
    pattern, odd, at = _MARKUP, 0, 0
    last = page.rfind(">") + 1  # behind it there is no tag, but maybe a comment
    while (at := page.find("<", at)) >= 0:
        if at >= last:
            if (at := page.find("<!--", at)) >= 0:
                yield at, len(page), None, False, ""
            return
        m = pattern.match(page, at, last)
        if m is None:
            at += 1
            continue
        if m[5] is not None:
            odd += 1
            pattern = _PLAIN_MARKUP if odd > _ODD_TAGS else pattern
        open_ended = m.end() == last and (
            page.startswith("<!--", at) and not page.endswith("-->", at + 4, last)
            or m[1] and not page.endswith("/>", at, last) and not re.match(rf"{m[1]}\s*>", page[page.rfind("</", at, last) + 2 : last], re.I)
        )
        start, at = at, len(page) if open_ended else m.end()
        yield start, at, m[3].lower() if m[3] else None, bool(m[2]), m[4] or m[5] or ""


def closed_elements(tags: Sequence[tuple[int, int, str | None, bool, str]]) -> dict[int, int]:
    """Of the elements in ``SKIPPED`` that are closed before the block they are in,
    the place of the start tag and that of the end tag in ``tags``."""
    kinds, stack, open_, ends = {*GROUP_OF, *SKIPPED.split()} - {"input"}, [], Counter(), {}
    for i, (_, _, tag, is_end, rest) in enumerate(tags):
        if tag not in kinds:
            continue
        if not is_end:
            if not rest.endswith("/"):
                stack.append((tag, i))
                open_[tag] += 1
        elif open_[tag]:
            while True:
                name, start = stack.pop()
                open_[name] -= 1
                if name == tag:
                    break
            if tag not in GROUP_OF:
                ends[start] = i
    return ends


def parse(page: str | None) -> list[Node]:
    """Nodes of a page; a parent comes before its children. Unclosed and stray
    tags are taken as browsers do, roughly: scripts, styles, frames and titles run
    to the end of the page, objects and the like without an end are no elements."""
    nodes = [Node(-1, "page", tag="html")]
    stack, open_, run, links, at = [0], Counter(), None, 0, 0
    page = page or ""

    def text(piece: str) -> None:
        nonlocal run
        if not piece:
            return
        if run is None:
            if piece.isspace():
                return
            run = Node(stack[-1], "run")
            nodes.append(run)
        run.parts.append(piece)
        if links:
            run.linked += len(piece)

    def close() -> None:
        open_[nodes[stack.pop()].tag] -= 1

    tags = list(markup(page))
    closed, behind = closed_elements(tags), 0
    for i, (start, end, tag, is_end, rest) in enumerate(tags):
        if i < behind:
            continue
        text(page[at:start])
        at = end
        if i in closed:
            behind = closed[i] + 1
            at = tags[closed[i]][1]
            continue
        if tag is None:
            continue
        if tag == "a":
            links = max(0, links + (-1 if is_end else 1)) if is_end or not rest.endswith("/") else links
        if tag == "br":
            text(" ")
        if tag not in GROUP_OF:
            continue
        run, links = None, 0
        if is_end:
            if open_[tag]:
                while nodes[stack[-1]].tag != tag:
                    close()
                close()
            continue
        ends = CLOSED_BY.get(tag, "p" if tag in CLOSES_P else "").split()
        while len(stack) > 1 and nodes[stack[-1]].tag in ends:
            close()
        if tag in ("html", "body") and len(stack) == 1:
            continue
        names = " ".join(x for own in _NAMES.findall(rest) for x in own)
        nodes.append(Node(stack[-1], GROUP_OF[tag], names, tag=tag))
        if tag != "input" and not rest.endswith("/"):
            stack.append(len(nodes) - 1)
            open_[tag] += 1
    text(page[at:])
    for node in nodes:
        if node.parts:
            node.text = " ".join(html.unescape("".join(node.parts)).split())
    return nodes


def features(nodes: Sequence[Node]) -> list[list[str]]:
    """Names of the features of each node."""
    out, hints = [], []
    for node in nodes:
        above = hints[node.parent] if node.parent >= 0 else frozenset()
        if node.group != "run":
            words = {w.lower() for w in _NAME.findall(node.names)}
            own = {f"in {node.group}"} if node.group in ("article", "chrome", "form", "table", "item") else set()
            own |= {"in bad"} if words & _BAD else {"in good"} if words & _GOOD else set()
            hints.append(above | own)
            out.append([f"is {node.group}", *(f"own {x}" for x in own)])
            continue
        hints.append(above)
        size = len(node.text.split())
        share = node.linked / max(1, len(node.text))
        out.append([
            "is run",
            f"words {min(6, size.bit_length())}",
            f"links {0 if share < 0.05 else 1 if share < 0.4 else 2}",
            "ends" if _ENDS.search(node.text) else "open",
            f"holder {nodes[node.parent].group}",
            *(["rights"] if "©" in node.text else []),
            *sorted(above),
        ])
    return out


def edge(nodes: Sequence[Node], i: int) -> str:
    """Kind of the edge to node i from its parent."""
    return f"{nodes[nodes[i].parent].group}>{'run' if nodes[i].group == 'run' else 'element'}"


@dataclass
class Model:
    """Log potentials: a feature's weight for content, and a 2 x 2 table per kind
    of edge (parent's state, child's state)."""

    unary: dict[str, float]
    pair: dict[str, tuple]

    def marginals(self, nodes: Sequence[Node], own: Sequence[list[str]] | None = None, edges: bool = False):
        """Probability of content for every node; with ``edges``, also of the four
        joint states of every edge."""
        own = own or features(nodes)
        n = len(nodes)
        score = [sum(map(self.unary.get, f, [0.0] * len(f))) for f in own]
        tables = [None] + [self.pair.get(edge(nodes, i), (0.0, 0.0, 0.0, 0.0)) for i in range(1, n)]
        # Messages are log ratios of content to other; ``up`` is what the
        # subtree below says, ``message`` what it tells the parent.
        up, message = score[:], [0.0] * n
        for i in range(n - 1, 0, -1):
            t00, t01, t10, t11 = tables[i]
            message[i] = _log_sum(t10, t11 + up[i]) - _log_sum(t00, t01 + up[i])
            up[nodes[i].parent] += message[i]
        belief, joint = up[:], [None] * n
        for i in range(1, n):
            t00, t01, t10, t11 = tables[i]
            rest = belief[nodes[i].parent] - message[i]
            belief[i] = up[i] + _log_sum(t01, t11 + rest) - _log_sum(t00, t10 + rest)
            if edges:
                logs = (t00, t01 + up[i], t10 + rest, t11 + rest + up[i])
                top = max(logs)
                parts = [math.exp(x - top) for x in logs]
                joint[i] = [x / sum(parts) for x in parts]
        shares = [_logistic(b) for b in belief]
        return (shares, joint) if edges else shares


def _log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def states(nodes: Sequence[Node], truth: Sequence[bool]) -> list[int]:
    """States of all nodes from those of the runs: an element is content if most
    of the text below it is."""
    weight = [len(n.text) if n.group == "run" else 0 for n in nodes]
    good = [w if t else 0 for w, t in zip(weight, truth)]
    for i in range(len(nodes) - 1, 0, -1):
        weight[nodes[i].parent] += weight[i]
        good[nodes[i].parent] += good[i]
    return [int(2 * g > w) for g, w in zip(good, weight)]


def fit(pages: Sequence[tuple[Sequence[Node], Sequence[bool]]], epochs: int = EPOCHS) -> Model:
    """Adam on the likelihood of the labelled trees, with a small penalty."""
    cases = []
    for nodes, truth in pages:
        own, state = features(nodes), states(nodes, truth)
        cases.append((nodes, own, state))
    names = sorted({f for _, own, _ in cases for fs in own for f in fs})
    kinds = sorted({edge(nodes, i) for nodes, _, _ in cases for i in range(1, len(nodes))})
    at = {f: i for i, f in enumerate(names)}
    at_edge = {k: len(names) + 4 * i for i, k in enumerate(kinds)}
    w = np.zeros(len(names) + 4 * len(kinds))
    m, v, rng, t = np.zeros_like(w), np.zeros_like(w), np.random.default_rng(SEED), 0

    def model() -> Model:
        return Model(
            {f: float(w[i]) for f, i in at.items()},
            {k: tuple(w[i : i + 4].tolist()) for k, i in at_edge.items()},
        )

    for _ in range(epochs):
        order = rng.permutation(len(cases))
        for start in range(0, len(order), 64):
            now, grad = model(), -0.01 * w
            for c in order[start : start + 64]:
                nodes, own, state = cases[c]
                share, joint = now.marginals(nodes, own, edges=True)
                for i, fs in enumerate(own):
                    for f in fs:
                        grad[at[f]] += state[i] - share[i]
                    if i:
                        k = at_edge[edge(nodes, i)]
                        grad[k : k + 4] -= joint[i]
                        grad[k + 2 * state[nodes[i].parent] + state[i]] += 1
            t += 1
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            w += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model()


def marked(page: str) -> tuple[list[Node], list[bool]] | None:
    """A page that marks its one article, as a labelled page: what lies in the
    article is content, but for elements there that are named otherwise."""
    nodes = parse(page)
    if sum(n.tag == "article" for n in nodes) != 1:
        return None
    own, inside = features(nodes), [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        other = node.group in ("chrome", "form") or "own in bad" in own[i]
        inside[i] = node.tag == "article" or inside[node.parent] and not other
    return nodes, inside


def train(pages: DataFrame | None = None) -> Model:
    """Fit on generated pages and, where given, a bounded sample of the table."""
    cases = []
    for page, content in labelled_pages(LABELLED_PAGES, SEED):
        nodes = parse(page)
        cases.append((nodes, [n.group == "run" and n.text in content for n in nodes]))
    if pages is not None:
        rows = columns(pages, "page_id", "html").where("html is not null and length(html) < 20000")
        rows = rows.withColumn("key", F.xxhash64("page_id", "html"))
        n = rows.agg(F.approx_count_distinct("key")).first()[0]
        # Some four times as many as are wanted get past the bound, whatever the size of the table.
        near = rows.where(hash_below(F.col("key"), n, 4 * TABLE_PAGES)).distinct()
        some = near.orderBy("key", "page_id").select("html").limit(TABLE_PAGES)
        cases += [case for (page,) in some.collect() if (case := marked(page))]
    return fit(cases)


def extract(page: str | None, model: Model) -> str:
    """The runs that are content, in page order."""
    nodes = parse(page)
    shares = model.marginals(nodes)
    return "\n\n".join(n.text for n, p in zip(nodes, shares) if n.group == "run" and p >= 0.5 and n.text)


def extract_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: page_id, url, text (blocks joined by an empty line), n_chars.

    A null or empty html, and a page without content, gives an empty text. Rows
    may repeat; an empty table gives no rows; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            made = [extract(page, own) for page in batch.column("html").to_pylist()]
            yield batch_of(
                ["page_id", "url", "text", "n_chars"],
                [batch.column("page_id"), batch.column("url"), made, [len(t) for t in made]],
                [None, None, pa.string(), pa.int64()],
            )

    rows = columns(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    return in_batches(rows, run, "page_id long, url string, text string, n_chars long")
