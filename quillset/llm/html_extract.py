"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes its leaf blocks in order: runs of text between tags that start or end a block, each with the tags and
class words of its ancestors. Scripts, styles, comments, text areas and the head give no blocks; buttons, lists to choose
from, templates and drawings are blocks that the field learns to leave out. The field has two labels, main text or not, features of the block, of its ancestors and of its text, and weights for neighbours;
it is trained by gradient ascent on the exact likelihood of labelled pages and decoded by Viterbi.

The labelled pages are made by ``labelled_pages``: layouts of many kinds with invented words, in which every block of
the article is marked. Quotes hold a value only behind an equals sign, as in HTML. Comments and the elements that HTML
reads as raw text run to the end of the page if they are not closed; of a tag that never ends only the name goes, and
a control that is not closed ends where a block begins. Null or empty pages have no text. A page is one value of a
row, whatever its length and however often it occurs; columns other than the text's pass through.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable
from dataclasses import dataclass
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns

# Element names of the HTML standard.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msup msub msqrt object noscript".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
CONTROLS = frozenset("button select optgroup option".split())
CLOSED_BY_SAME = frozenset("p li tr td th dt dd option".split())

token = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>|([^<]+|<)",
    re.DOTALL,
)
#: Behind the last sign that ends a tag: the same groups, but a tag is no more than its name.
after_tags = re.compile(r"<!--.*|<![^>]*|<\?[^>]*|<(/?)([a-zA-Z][^\s/>]*+)()|([^<]+|<)", re.DOTALL)
naming = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
name_part = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
white = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int


def leaf_blocks(html: str | None) -> list[Block]:
    """The blocks with text, white space inside them turned into single spaces."""
    blocks: list[Block] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = 0
    html = html or ""

    def close() -> None:
        nonlocal linked
        text = white.sub(" ", unescape("".join(parts))).strip()
        if text:
            blocks.append(Block(text, tuple(path), linked))
        parts.clear()
        linked = 0

    at, last = 0, html.rfind(">")
    while m := (token if at < last else after_tags).match(html, at):
        at = m.end()
        if m[4] is not None:
            parts.append(m[4])
            if links:
                linked += len(m[4].strip())
            continue
        if m[2] is None or at > last + 1:
            continue
        tag, ends = m[2].lower(), bool(m[1])
        if tag == "a":
            links = max(0, links + (-1 if ends else 1))
        if tag in RAW:
            if not ends and not m[3].endswith("/"):
                end = re.compile(f"</{tag}[^>]*>|\\Z", re.IGNORECASE).search(html, at)
                at = end.end()
            continue
        if tag in INLINE:
            continue
        close()
        if tag in VOID:
            continue
        if ends:
            for i in range(len(path) - 1, -1, -1):
                if path[i][0] == tag:
                    del path[i:]
                    links = 0
                    break
            continue
        while path and path[-1][0] in CONTROLS and tag not in CONTROLS:
            path.pop()
        if path and (path[-1][0] == "p" or tag in CLOSED_BY_SAME and path[-1][0] == tag):
            path.pop()
        words = {w.lower() for found in naming.findall(m[3]) for w in name_part.findall("".join(found))}
        path.append((tag, tuple(sorted(words))))
    close()
    return [b for b in blocks if not any(tag == "head" for tag, _ in b.path)]


def features(block: Block) -> list[str]:
    """What the field sees of a block; ancestors count by tag and by class word, the nearest one also by itself."""
    found = {"any"}
    for tag, words in block.path:
        found.add(f"in {tag}")
        found.update(f"named {w}" for w in words)
    for tag, words in block.path[-2:]:
        found.add(f"near {tag}")
        found.update(f"near named {w}" for w in words)
    words = block.text.split()
    n = len(words)
    found.add("words " + ("1" if n < 2 else "2-4" if n < 5 else "5-9" if n < 10 else "10-19" if n < 20 else "20+"))
    share = block.linked / max(1, len(block.text))
    found.add("links " + ("none" if not share else "some" if share < 0.5 else "most"))
    if block.text[-1] in ".!?…:\"'”»":
        found.add("sentence end")
    if "©" in block.text or "·" in block.text or "|" in block.text:
        found.add("footer sign")
    return sorted(found)


@dataclass(frozen=True)
class Field:
    """``emit[f]`` are the weights of feature f for both labels, ``step[a, b]`` that of label b after label a."""

    index: dict[str, int]
    emit: np.ndarray
    step: np.ndarray

    def scores(self, blocks: Iterable[Block]) -> np.ndarray:
        index = self.index
        rows = [self.emit[[index[f] for f in features(b) if f in index]].sum(0) for b in blocks]
        return np.array(rows).reshape(-1, 2)

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not blocks:
            return []
        scores, step = self.scores(blocks).tolist(), self.step.tolist()
        best, back = scores[0], []
        for here in scores[1:]:
            came = [0 if best[0] + step[0][k] >= best[1] + step[1][k] else 1 for k in (0, 1)]
            best = [best[came[k]] + step[came[k]][k] + here[k] for k in (0, 1)]
            back.append(came)
        label = 0 if best[0] >= best[1] else 1
        labels = [label]
        for came in reversed(back):
            label = came[label]
            labels.append(label)
        return labels[::-1]

    def main_text(self, html: str | None) -> str:
        blocks = leaf_blocks(html)
        return " ".join(b.text for b, label in zip(blocks, self.decode(blocks), strict=True) if label)


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 400, rate: float = 0.5, decay=1e-4) -> Field:
    """Weights of the largest penalised likelihood, by full gradient steps with forward-backward expectations."""
    pages = [p for p in pages if p[0]]
    index: dict[str, int] = {}
    rows = [[[index.setdefault(f, len(index)) for f in features(b)] for b in blocks] for blocks, _ in pages]
    sizes = np.array([len(p) for p in rows])
    own = np.arange(sizes.max())[None, :] < sizes[:, None]
    flat = np.concatenate([np.array(r) for page in rows for r in page])
    owner = np.repeat(np.flatnonzero(own.ravel()), [len(r) for page in rows for r in page])
    labels = np.zeros(own.shape, int)
    labels[own] = np.concatenate([np.array(x) for _, x in pages])
    target = np.eye(2)[labels] * own[:, :, None]
    gold = np.zeros((2, 2))
    np.add.at(gold, (labels[:, :-1][own[:, 1:]], labels[:, 1:][own[:, 1:]]), 1)
    emit, step = np.zeros((len(index), 2)), np.zeros((2, 2))
    seen_emit, seen_step = np.full(emit.shape, 1e-3), np.full(step.shape, 1e-3)
    for _ in range(rounds):
        scores = np.stack([np.bincount(owner, emit[flat, k], minlength=own.size) for k in (0, 1)], axis=1)
        chance, pair = expectations(scores.reshape(*own.shape, 2), step, own)
        gap = (target - chance).reshape(-1, 2)
        grad = np.stack([np.bincount(flat, gap[owner, k], minlength=len(index)) for k in (0, 1)], axis=1)
        grad = grad / len(pages) - decay * emit
        seen_emit += grad**2
        emit = emit + rate * grad / np.sqrt(seen_emit)
        grad = (gold - pair) / len(pages) - decay * step
        seen_step += grad**2
        step = step + rate * grad / np.sqrt(seen_step)
    return Field(index, emit, step)


def expectations(scores: np.ndarray, step: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all pages at once: chances of the labels of each block, and expected uses of each step.

    ``own`` tells the blocks of a page from the padding behind them.
    """
    move = np.exp(step)
    here = np.exp(scores - scores.max(axis=2, keepdims=True))
    ahead, behind = np.zeros_like(here), np.ones_like(here)
    ahead[:, 0] = here[:, 0] / here[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, here.shape[1]):
        ahead[:, i] = (ahead[:, i - 1] @ move) * here[:, i]
        ahead[:, i] /= ahead[:, i].sum(axis=1, keepdims=True)
    pair = np.zeros((2, 2))
    for i in range(here.shape[1] - 2, -1, -1):
        later = behind[:, i + 1] * here[:, i + 1]
        joint = ahead[:, i, :, None] * move * later[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pair += joint[own[:, i + 1]].sum(axis=0)
        back = later @ move.T
        back /= back.sum(axis=1, keepdims=True)
        behind[:, i] = np.where(own[:, i + 1, None], back, 1.0)
    both = ahead * behind
    return both / both.sum(axis=2, keepdims=True) * own[:, :, None], pair


#: Marks the blocks of the article in labelled pages.
MARK = ""
ARTICLES = (
    ("<article>", "</article>"),
    ("<main>", "</main>"),
    ("<main><article>", "</article></main>"),
    ('<div class="article-body">', "</div>"),
    ('<div class="post-content entry">', "</div>"),
    ('<div id="content" class="main story">', "</div>"),
    ('<section class="article text">', "</section>"),
    ('<div class="page"><article class="post">', "</article></div>"),
)
# Usual names of what surrounds an article.
BLOCK_NAMES = {
    "div": "ad,ads,advert,advertisement,banner ad,promo,sponsored,sidebar,widget,menu,navbar,breadcrumb,breadcrumbs,"
    "notice,cookie-notice,cookie consent,alert,popup,modal,newsletter,subscribe,signup,related,share,social,toolbar,"
    "tags,meta,byline author,comments,comment,comment-list,discussion,replies,login,search,copyright,legal,skip,paywall",
    "section": "comments,related posts,newsletter,ads,notice,sidebar,reviews",
    "aside": ",sidebar,related,ad,widget,note",
    "nav": ",menu,breadcrumbs,toc,pagination",
    "header": ",site-header,masthead,top",
    "footer": ",site-footer,bottom,copyright",
    "form": ",search,login,newsletter,comment-form,contact",
    "ul": "menu,nav,share-links,comment-list,tags,pagination",
    "ol": "comments,breadcrumb",
}


def labelled_pages(n: int = 900, seed: int = 17) -> list[str]:
    """Pages in which every block of the article begins with ``MARK``."""
    rng = random.Random(seed)
    syllables = [a + b for a in "bdfgklmnprstv" for b in ("a", "e", "i", "o", "u", "an", "er", "on", "is")]

    def text(low: int, high: int, end: str = ".") -> str:
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(low, high))]
        return " ".join(words).capitalize() + end

    def outside() -> str:
        tag = rng.choice(list(BLOCK_NAMES))
        name = rng.choice(BLOCK_NAMES[tag].split(","))
        head = f'<{tag} {rng.choice(("class", "id"))}="{name}">' if name else f"<{tag}>"
        kind = rng.random()
        if tag in ("ul", "ol") or kind < 0.35:
            items = "".join(
                f"<li>{link(1, 3) if rng.random() < 0.7 else text(3, 25)}</li>" for _ in range(rng.randint(1, 6))
            )
            body = items if tag in ("ul", "ol") else f"<ul>{items}</ul>"
        elif kind < 0.6:
            body = text(1, 14)
        elif kind < 0.8:
            body = "".join(f"<p>{text(3, 40)}</p>" for _ in range(rng.randint(1, 3)))
        else:
            body = f"<h3>{text(1, 4, '')}</h3><p>{text(4, 40)}</p>"
        if rng.random() < 0.1:
            body += control()
        if tag == "footer" and rng.random() < 0.6:
            body = f"&copy; {text(1, 3, '')} &middot; {body}"
        return f"{head}{body}</{tag}>"

    def control() -> str:
        kind = rng.random()
        if kind < 0.4:
            return f"<button class=btn>{text(1, 3, '')}</button>"
        if kind < 0.7:
            options = "".join(f"<option>{text(1, 3, '')}</option>" for _ in range(rng.randint(1, 4)))
            return f"<select>{options}</select>"
        if kind < 0.85:
            return f"<svg><text>{text(1, 3, '')}</text></svg>"
        return f"<template><p>{text(2, 20)}</p></template>"

    def link(low: int, high: int) -> str:
        return f'<a href="/x">{text(low, high, "")}</a>'

    def inside() -> str:
        kind = rng.random()
        if kind < 0.6:
            some = f" <b>{text(1, 2, '')}</b>" if rng.random() < 0.3 else f" {link(1, 3)}" if rng.random() < 0.2 else ""
            return f"<p>{MARK}{text(1, 60, '')}{some}{rng.choice(('.', '.', ''))}</p>"
        if kind < 0.72:
            return f"<h2>{MARK}{text(1, 8, '')}</h2>"
        if kind < 0.8:
            return "<ul>" + "".join(f"<li>{MARK}{text(1, 12)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>"
        if kind < 0.86:
            return f"<blockquote>{MARK}{text(4, 40)}</blockquote>"
        if kind < 0.9:
            return "<table><tr>" + "".join(f"<td>{MARK}{text(1, 3, '')}</td>" for _ in range(3)) + "</tr></table>"
        if kind < 0.95:
            return f"<div>{MARK}{text(1, 40)}</div>"
        return f"<pre>{MARK}{text(2, 30)}</pre><p><b>{MARK}{text(2, 30)}<br>"

    pages = []
    for _ in range(n):
        head, end = rng.choice(ARTICLES)
        parts = [f"<h1>{MARK}{text(1, 12, '')}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.randint(1, 12)):
            parts.append(inside() if rng.random() < 0.85 else outside())
            if rng.random() < 0.06:
                parts.append(control())
        before = "".join(outside() for _ in range(rng.randint(0, 5)))
        after = "".join(outside() for _ in range(rng.randint(0, 5)))
        pages.append(f"<html><head><title>x</title></head><body>{before}{head}{''.join(parts)}{end}{after}</body></html>")
    return pages


def labelled_blocks(html: str) -> tuple[list[Block], list[int]]:
    blocks = leaf_blocks(html)
    labels = [int(MARK in b.text) for b in blocks]
    return [Block(b.text.replace(MARK, ""), b.path, b.linked) for b in blocks if b.text != MARK], labels


def fit(pages: list[str] | None = None) -> Field:
    """A field trained on labelled pages, by default on those of ``labelled_pages``."""
    return train([labelled_blocks(p) for p in (pages if pages is not None else labelled_pages())])


def extract(pages: DataFrame, field: Field, html_col="html", out="text") -> DataFrame:
    """All columns of ``pages`` and the main text of each whole page in column ``out``, replaced if it is there."""
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def load():
        field = shared.value
        return lambda rows: [field.main_text(r["html"]) for r in rows]

    asked = pages.withColumn(out, F.struct(F.col(html_col).alias("html")))
    return add_columns(asked, load, out, [T.StructField(out, T.StringType())])
