"""Main text of web pages: flat blocks, classified by a decision tree over their own and their neighbours' figures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.blocks import Block, page_blocks
from matchwright.llm.texts import slices

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "article", "furniture", "page_has_article", "heading", "named")

_P = "Rain fell on the harbour for most of the week and the boats stayed in, so the market had little fish to sell."
_Q = "Nobody was hurt, the mayor said on Friday, and repairs to the old sea wall will begin as soon as the water has gone down again."
_S = "It was late."
_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport and leisure</a></li></ul>'

_BODIES = (
    f"<article data-keep><h1>Storm</h1><p>{_P}</p><p>{_S}</p><p>{_Q}</p></article>",
    f"<article data-keep><p>Les.</p><p><a href=/s>Here is the map</a></p><p>{_Q}</p><p>No.</p></article>",
    f"<main data-keep><h2>Storm</h2><p>{_P}<p>{_Q}<ul><li>{_S}<li><a href=/2>Two boats sank</a></ul></main>",
    f"<div data-keep><h1>Storm at sea</h1><p>{_P}</p><p>{_S}</p><p>{_Q}</p><p>{_P} <a href=/x>More here</a></p></div>",
)
_FURNITURE = ("nav", "aside", "footer", "form", "header", "div class=ad", "div class=comments", "div id=sidebar", "div class='cookie notice'", "div class=cookie-banner", "div id=siteFooter")
_FILLING = (_S, "Buy two lamps today.", _P, f"{_Q}</p><p>{_P}", "<a href=/a>About us</a> <a href=/b>Terms of use</a>")


def labelled_pages() -> list[str]:
    """Labelled pages by rule: each body with each kind of furniture before, after or inside it, and with a bare menu.

    Blocks inside an element with data-keep and outside furniture, also by compound names, belong
    to the main text, all others do not. Articles also stand in wrappers whose names mislead.
    """
    pages = []
    for body in _BODIES:
        for where in _FURNITURE:
            for filling in _FILLING:
                extra = f"<{where}><p>{filling}</p></{where.split()[0]}>"
                pages += [f"<div>{_MENU}</div>{extra}{body}<p>Imprint</p>", f"{body}{extra}<p>Log in</p>"]
                if where != "header":
                    pages.append(body.replace("<p>", f"{extra}<p>", 1))
    wrapped = ("form", "div class='content search'", "div class=page-banner", "div class='page with-menu'")
    pages += [f"<div>{_MENU}</div><{w}>{body}</{w.split()[0]}><p>Imprint</p>" for w in wrapped for body in _BODIES if body[1] in "am"]
    return pages


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block, in the order of FEATURES."""
    if not blocks:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in blocks], float)
    named = np.array([b.named for b in blocks], float)
    density = np.minimum(1.0, np.array([b.linked for b in blocks], float) / words)
    before, after = (lambda x: np.concatenate(([0.0], x[:-1]))), (lambda x: np.concatenate((x[1:], [0.0])))
    article = np.array([b.article for b in blocks], float)
    furniture = np.array([b.furniture for b in blocks], float)
    heading = np.array([len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit() for b in blocks], float)
    return np.column_stack(
        (words, density, before(words), before(density), after(words), after(density), article, furniture, np.full(len(blocks), article.max()), heading, named)
    )


def train(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 5) -> tuple:
    """A binary decision tree by Gini impurity: (feature, threshold, low side, high side), or a leaf's answer.

    Ties go to the feature that comes first, thresholds lie halfway between neighbouring values.
    """
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return (bool(share > 0.5),)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= t
            a, b = y[low], y[~low]
            if min(len(a), len(b)) < least:
                continue
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(t), low)
    if best is None:
        return (bool(share > 0.5),)
    _, f, t, low = best
    return (f, t, train(x[low], y[low], depth - 1, least), train(x[~low], y[~low], depth - 1, least))


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    f, t, low, high = tree
    return np.where(x[:, f] <= t, classify(low, x), classify(high, x))


def labelled_tree(pages: list[str] | None = None) -> tuple:
    """The tree of the labelled pages; they are a small fixed table, so it is trained on the driver."""
    sets = [page_blocks(p) for p in pages or labelled_pages()]
    y = np.array([b.marked and not b.furniture and not b.named for blocks in sets for b in blocks], float)
    return train(np.concatenate([features(b) for b in sets]), y)


def main_text(page: str | None, tree: tuple) -> str:
    blocks = page_blocks(page or "")
    keep = classify(tree, features(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def main_texts(pages: DataFrame, tree: tuple | None = None) -> DataFrame:
    """page_id, url, text (empty if none), n_chars of every page, from its whole html.

    Null or empty html gives an empty text; page_id and url pass through, null or repeated as
    they are; other columns are not read. Each page is one row's work: nothing is shuffled.
    """
    tree = tree or labelled_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(p, tree) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    cut = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").alias("html"))
    return cut.mapInArrow(run, "page_id long, url string, text string, n_chars long")
