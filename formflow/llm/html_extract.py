"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between tags that begin or end a block.
Each block is a vector: its tag path and the class and id words on it, hashed, its
words, hashed, and a few measures. A bidirectional LSTM in numpy reads the page's
whole sequence of blocks and labels each as main text or not, so a block is judged with
what stands before and after it. The page's text is the blocks labelled main, in order.

The labeller is trained here, on the driver, on ``TRAIN_PAGES`` generated pages whose
blocks are labelled by construction: pages of many layouts with menus, headers,
sidebars, notices, adverts, forms, comments and footers around an article, also cut off
in the middle. Nothing of the given pages is used to train it. The weights, some tens of
kilobytes, are broadcast.

Defined results: a null or empty page, and a page without a main block, has an empty
text; broken markup is read as far as it goes; repeated rows are extracted one by one;
an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from formflow.llm.common import ROW, packed, slices, text_of
from formflow.llm.words import in_batches

# Elements of HTML by what they do to text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " canvas form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript object ol optgroup option p pre"
    " section select summary svg table tbody td template textarea tfoot th thead title tr ul".split()
)
SILENT = frozenset(("script", "style"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these ends an open one of the same group.
SIBLINGS = {"li": {"li"}, "p": {"p"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d")


@dataclass(slots=True)
class Leaf:
    path: tuple[str, ...]  # element names from the body down
    names: tuple[str, ...]  # words of the class, id and role values on the path
    text: str
    linked: int  # characters of the text inside links


def leaves(page: str) -> list[Leaf]:
    """Blocks of text in page order; scripts, styles, markup comments and the head's elements are no text."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", entities.unescape("".join(held))).strip()
        if text and not any(t == "head" for t, _ in stack):
            out.append(Leaf(tuple(t for t, _ in stack), tuple(n for _, names in stack for n in names), text, linked))
        held.clear()
        linked = 0

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            held.append(page[at:])
            linked += (len(page) - at) * (links > 0)
            break
        if found.start() > at:
            held.append(page[at : found.start()])
            linked += (found.start() - at) * (links > 0)
        at = found.end()
        if found[1] is None:
            continue
        tag, closing = found[1].lower(), page[found.start() + 1] == "/"
        if tag in SILENT and not closing:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
            continue
        if tag not in BLOCKS:
            continue
        flush()
        links = 0 if closing else links
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID:
            rivals = SIBLINGS.get(tag)
            if rivals and stack and stack[-1][0] in rivals:
                stack.pop()
            elif tag == "body":
                stack = [s for s in stack if s[0] != "head"]
            words = tuple(w for m in _NAMES.finditer(found[2]) for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower()))
            stack.append((tag, words))
    flush()
    return out


PATH, WORDS, MEASURES = 48, 16, 8
FEATURES = 2 * PATH + WORDS + MEASURES


@functools.lru_cache(1 << 14)
def _slot(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode())
    return h % size, 1.0 if h >> 31 else -1.0


def features(page: list[Leaf]) -> np.ndarray:
    """One vector for each block: hashed path, hashed names, hashed words, measures."""
    out = np.zeros((len(page), FEATURES), np.float32)
    for row, leaf in zip(out, page, strict=True):
        # every tag of the path, the nearer the more; every word, by the length of the text
        for up, tag in enumerate(reversed(leaf.path)):
            at, sign = _slot(tag, PATH)
            row[at] += sign * 0.85**up
        for name in set(leaf.names):
            at, sign = _slot("#" + name, PATH)
            row[PATH + at] += sign
        words = leaf.text.split()
        share = 1 / max(4.0, np.sqrt(len(words)))
        for word in words:
            at, sign = _slot(word.lower(), WORDS)
            row[2 * PATH + at] += sign * share
        n = len(leaf.text)
        row[2 * PATH + WORDS :] = (
            np.log1p(len(words)) / 4, np.log1p(n) / 6, min(1.0, leaf.linked / max(1, n)), leaf.text[-1] in ".!?…", len(leaf.path) / 8,
            leaf.text.count("|") > 1, "©" in leaf.text, len(_DIGITS.findall(leaf.text)) / max(1, n),
        )
    return out


HIDDEN = 20


class Labeller:
    """A bidirectional LSTM over sequences of feature vectors, with a logistic output for each step."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 1):
        if weights is None:
            rng = np.random.default_rng(seed)
            weights = {}
            for way in "fb":
                weights[f"x{way}"] = rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, 4 * HIDDEN)).astype(np.float32)
                weights[f"h{way}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
                bias = np.zeros(4 * HIDDEN, np.float32)
                bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
                weights[f"b{way}"] = bias
            weights["out"] = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
            weights["bias"] = np.zeros(1, np.float32)
        self.weights = weights

    def _pass(self, way: str, x: np.ndarray, there: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states of one direction; ``x`` is (step, page, feature), steps run forwards here."""
        steps, pages, _ = x.shape
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        fed = x @ self.weights[f"x{way}"] + self.weights[f"b{way}"]
        for t in range(steps):
            g = fed[t] + h @ self.weights[f"h{way}"]
            gates = 1 / (1 + np.exp(-np.clip(g[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            new = np.tanh(g[:, 3 * HIDDEN :])
            before = (h, c)
            on = there[t][:, None]
            c = np.where(on, f * c + i * new, c)
            squashed = np.tanh(c)
            h = np.where(on, o * squashed, h)
            out[t] = h
            if keep is not None:
                keep.append((before, gates, new, squashed))
        return out

    def scores(self, x: np.ndarray, there: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits (step, page). ``there`` marks the steps that a page has; padding may be on either end."""
        states = []
        for way in "fb":
            held = [] if keep is not None else None
            s = self._pass(way, x if way == "f" else x[::-1], there if way == "f" else there[::-1], held)
            states.append(s if way == "f" else s[::-1])
            if keep is not None:
                keep[way] = held
        both = np.concatenate(states, axis=2)
        if keep is not None:
            keep["both"] = both
        return both @ self.weights["out"] + self.weights["bias"][0]

    def gradients(self, x: np.ndarray, there: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over all steps that are there."""
        keep: dict = {}
        logits = self.scores(x, there, keep)
        error = np.where(there, 1 / (1 + np.exp(-np.clip(logits, -30, 30))) - wanted, 0).astype(np.float32) / there.sum()
        grads = {"out": np.einsum("tp,tph->h", error, keep["both"]), "bias": np.array([error.sum()], np.float32)}
        for k, way in enumerate("fb"):
            from_out = error[:, :, None] * self.weights["out"][k * HIDDEN : (k + 1) * HIDDEN]
            xs, on, from_out = (a if way == "f" else a[::-1] for a in (x, there, from_out))
            wx, wh = np.zeros_like(self.weights[f"x{way}"]), np.zeros_like(self.weights[f"h{way}"])
            wb = np.zeros_like(self.weights[f"b{way}"])
            dh = np.zeros((x.shape[1], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t in range(len(xs) - 1, -1, -1):
                (h0, c0), gates, new, squashed = keep[way][t]
                i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
                here = on[t][:, None]
                dh = dh + from_out[t]
                active = np.where(here, dh, 0)
                down = np.where(here, dc, 0) + active * o * (1 - squashed**2)
                inner = np.concatenate(
                    [down * new * i * (1 - i), down * c0 * f * (1 - f), active * squashed * o * (1 - o), down * i * (1 - new**2)], axis=1
                )
                wx += xs[t].T @ inner
                wh += h0.T @ inner
                wb += inner.sum(axis=0)
                dh = np.where(here, inner @ self.weights[f"h{way}"].T, dh)
                dc = np.where(here, down * f, dc)
            grads |= {f"x{way}": wx, f"h{way}": wh, f"b{way}": wb}
        return grads


def stacked(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages of different lengths side by side as (step, page, feature), and which steps are there."""
    longest = max((len(p) for p in pages), default=0)
    x = np.zeros((longest, len(pages), FEATURES), np.float32)
    there = np.zeros((longest, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k] = p
        there[: len(p), k] = True
    return x, there


# --- pages to learn from -------------------------------------------------------------------

TRAIN_PAGES, EPOCHS = 900, 14
_MAIN_NAMES = "article content post entry story main body text single blog markdown prose".split()
_SIDE_NAMES = "sidebar aside widget related promo newsletter share social popular archive tags rail recommend".split()
_AD_NAMES = "ad ads advert advertisement sponsor sponsored banner promo promoted affiliate".split()
_NOTE_NAMES = "cookie notice consent alert gdpr popup modal overlay banner subscribe paywall".split()
_TALK_NAMES = "comments comment discussion replies responses disqus thread reader".split()


def _sentence(rng: random.Random, words: list[str], low: int, high: int) -> str:
    out = rng.choices(words, k=rng.randint(low, high))
    out[0] = out[0].capitalize()
    return " ".join(out) + rng.choice([".", ".", ".", "!", "?", ""])


def _class(rng: random.Random, names: list[str], often: float = 0.95) -> str:
    if rng.random() > often:
        return ""
    name = rng.choice(names)
    name = rng.choice([name, f"{name}-{rng.choice(['box', 'wrap', 'list', 'inner', 'area', 'block'])}", f"site-{name}", f"{name}s"])
    return f' {rng.choice(["class", "class", "id"])}="{name}"'


def example(rng: random.Random) -> tuple[str, list[bool]]:
    """A page and, for each of its blocks in order, whether it is main text."""
    words = ["".join(rng.choices("etaoinshrdlucmfwyé", k=rng.randint(1, 9))) for _ in range(150)]
    if rng.random() < 0.25:  # noisy writing is main text all the same
        words = [w + rng.choice(["&amp;&amp;", "###", "!!", " |", "***", ""]) for w in words]
    marks: list[bool] = []

    def block(tag: str, main: bool, text: str, attrs: str = "") -> str:
        marks.append(main)
        return f"<{tag}{attrs}>{text}" + ("" if tag in ("p", "li") and rng.random() < 0.1 else f"</{tag}>")

    def link_list(tag: str, attrs: str) -> str:
        inner = "".join("<li>" + f'<a href="/{i}">' + "{}" + "</a></li>" for i in range(rng.randint(2, 8)))
        count = inner.count("{}")
        marks.extend([False] * count)
        return f"<{tag}{attrs}><ul>{inner.format(*(_sentence(rng, words, 1, 3) for _ in range(count)))}</ul></{tag}>"

    def plain(tag: str, names: list[str], low: int = 3, high: int = 25) -> str:
        parts = "".join(block(rng.choice(["p", "div", "p"]), False, _sentence(rng, words, low, high)) for _ in range(rng.randint(1, 2)))
        return f"<{tag}{_class(rng, names)}>{parts}</{tag}>"

    def advert() -> str:
        marks.append(False)
        return f"<div{_class(rng, _AD_NAMES, 1)}>{_sentence(rng, words, 3, 25)}</div>"

    def notice() -> str:
        if rng.random() < 0.15:
            return block(rng.choice(["noscript", "iframe", "object", "canvas"]), False, _sentence(rng, words, 2, 15))
        return plain(rng.choice(["div", "section", "aside"]), _NOTE_NAMES)

    def form() -> str:
        field = block("textarea", False, _sentence(rng, words, 1, 6)) if rng.random() < 0.2 else "<input type=text>"
        marks.extend([False, False])
        return f"<form><label>{_sentence(rng, words, 1, 4)}</label>{field}<button>{_sentence(rng, words, 1, 2)}</button></form>"

    def header() -> str:
        return f"<header{_class(rng, ['header', 'top', 'masthead'], 0.5)}>" + block(rng.choice(["h1", "div", "p"]), False, _sentence(rng, words, 1, 6)) + (
            link_list("nav", "") if rng.random() < 0.6 else ""
        ) + "</header>"

    def menu() -> str:
        return link_list(*rng.choice([("nav", ""), ("nav", ' class="menu"'), ("div", ' class="menu"'), ("div", ' id="navigation"'), ("div", ' class="breadcrumbs"')]))

    def side() -> str:
        tag = rng.choice(["aside", "div", "section"])
        attrs = _class(rng, _SIDE_NAMES, 1 if tag != "aside" else 0.5)
        return link_list(tag, attrs) if rng.random() < 0.5 else f"<{tag}{attrs}>" + block("h3", False, _sentence(rng, words, 1, 4)) + block("p", False, _sentence(rng, words, 4, 30)) + f"</{tag}>"

    def talk() -> str:
        tag = rng.choice(["section", "div", "ol"])
        inner = "".join(block(rng.choice(["p", "li", "div"]), False, _sentence(rng, words, 2, 40)) for _ in range(rng.randint(1, 5)))
        return f"<{tag}{_class(rng, _TALK_NAMES, 1)}>{inner}</{tag}>"

    def foot() -> str:
        marks.append(False)
        return f"<footer>&copy; {_sentence(rng, words, 1, 12)} &middot; {_sentence(rng, words, 1, 12)}</footer>"

    def article() -> str:
        tag, attrs = rng.choice([("article", ""), ("article", ""), ("article", _class(rng, _MAIN_NAMES)), ("main", ""), ("div", _class(rng, _MAIN_NAMES, 1)), ("section", _class(rng, _MAIN_NAMES, 1))])
        out = [block("h1", True, _sentence(rng, words, 1, 12))] if rng.random() < 0.85 else []
        for _ in range(rng.choice([1, 2, 4, 8, 14])):
            roll = rng.random()
            if roll < 0.7:
                text = " ".join(_sentence(rng, words, 1, 25) for _ in range(rng.choice([1, 1, 2, 4, 9])))
                if rng.random() < 0.15:
                    text = f'{text} <a href="/x">{_sentence(rng, words, 1, 4)}</a>'
                if rng.random() < 0.15:
                    text = f"<b>{text}<br>"
                out.append(block("p", True, text))
            elif roll < 0.8:
                out.append(block(rng.choice(["h2", "h3"]), True, _sentence(rng, words, 1, 6)))
            elif roll < 0.88:
                out.append("<ul>" + "".join(block("li", True, _sentence(rng, words, 1, 10)) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif roll < 0.93:
                out.append("<blockquote>" + block("p", True, _sentence(rng, words, 4, 30)) + "</blockquote>")
            elif roll < 0.96:
                out.append("<table><tr>" + "".join(block("td", True, _sentence(rng, words, 1, 3)) for _ in range(3)) + "</tr></table>")
            else:
                out.append(rng.choice([advert, side, notice])())
        return f"<{tag}{attrs}>" + "".join(out) + f"</{tag}>"

    parts = [x for x, p in ((header, 0.4), (menu, 0.7), (notice, 0.25), (advert, 0.5), (side, 0.2)) if rng.random() < p]
    rng.shuffle(parts)
    tail = [x for x, p in ((side, 0.3), (advert, 0.2), (talk, 0.35), (form, 0.25), (notice, 0.2), (foot, 0.8)) if rng.random() < p]
    page = "".join(f() for f in parts) + article()
    if rng.random() < 0.9:  # else the page is cut off
        page += "".join(f() for f in tail)
    page = f"<html><head><title>{_sentence(rng, words, 1, 6)}</title><style>p{{}}</style></head><body>{page}</body></html>"
    return page, marks


def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 7) -> Labeller:
    """A labeller fitted by Adam on generated pages."""
    rng = random.Random(seed)
    held = []
    while len(held) < pages:
        page, marks = example(rng)
        found = leaves(page)
        if found and len(found) == len(marks):
            held.append((features(found), np.array(marks, np.float32)))
    model = Labeller(seed=seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    held.sort(key=lambda p: len(p[0]))
    batches = [held[i : i + 32] for i in range(0, len(held), 32)]
    turn = 0
    for epoch in range(epochs):
        rng.shuffle(batches)
        for batch in batches:
            turn += 1
            x, there = stacked([f for f, _ in batch])
            wanted = np.zeros(there.shape, np.float32)
            for k, (_, marks) in enumerate(batch):
                wanted[: len(marks), k] = marks
            rate = 0.01 * (1 if epoch < epochs * 2 // 3 else 0.25)
            for k, g in model.gradients(x, there, wanted).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                step = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)
                model.weights[k] = (model.weights[k] - rate * step).astype(np.float32)
    return model


#: Characters of pages that are labelled together; a longer page is alone.
TOGETHER = 4 << 20


@functools.lru_cache(1)
def trained() -> Labeller:
    return train()


def main_text(pages: list[str], model: Labeller) -> list[str]:
    """The text of each page: its main blocks, one to a line. Pages of like length are labelled together."""
    found = [leaves(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if found[k]), key=lambda k: len(found[k]))
    while order:
        batch, width = [], 0
        while order and len(batch) < 256 and (width := max(width, len(found[order[0]]))) * (len(batch) + 1) <= 60_000 or not batch:
            batch.append(order.pop(0))
        x, there = stacked([features(found[k]) for k in batch])
        scores = model.scores(x, there)
        for i, k in enumerate(batch):
            out[k] = "\n".join(leaf.text for leaf, s in zip(found[k], scores[: len(found[k]), i], strict=True) if s > 0)
    return out


def extract(pages: DataFrame, keep: list[str] | None = None, model: Labeller | None = None) -> DataFrame:
    """Rows of ``pages`` (column html) packed (all columns, or those of ``keep``), with the main ``text``."""
    sent = pages.sparkSession.sparkContext.broadcast((model or trained()).weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(sent.value)
        for batch in slices(batches, 512):
            at = 0
            for some in in_batches(((page,) for page in batch.column("html").to_pylist()), 0, TOGETHER):
                texts = main_text([page for (page,) in some], labeller)
                yield pa.RecordBatch.from_arrays([batch.column(ROW).slice(at, len(some)), pa.array(texts, pa.string())], names=[ROW, "text"])
                at += len(some)

    rows = packed(pages, keep, html=text_of("html"))
    return rows.mapInArrow(run, f"{ROW} {rows.schema[ROW].dataType.simpleString()}, text string")
