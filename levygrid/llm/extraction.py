"""Main text of web pages: boosted trees over DOM nodes and a consistent choice of nodes."""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from levygrid.llm.boosting import Trees, fit
from levygrid.llm.common import slices
from levygrid.llm.htmldom import HINTS, MARK, Nodes

#: At most so many pages, of about so many bytes together, supply training texts and labels.
SAMPLE_PAGES = 300
SAMPLE_BYTES = 16 << 20
#: Texts to compose pages of if the sample has none.
PLAIN_TEXTS = [
    "The council met on Tuesday to talk about the new bridge, which is to open in the spring after two years of work and many delays.",
    "Most of the people who live near the river said that they had not been asked, but that they would use it to walk to the market.",
    "In the north the rain came early this year, so farmers had to bring in the wheat before it was ripe and sell it for less than before.",
    "She wrote four books about the history of the town, and the last of them tells how the old mill was built, burned down and built again.",
    "To make the soup, cut the onions into small pieces, fry them in oil until they are soft, add water and salt, and let it boil for an hour.",
]
#: Pages that are composed for training from texts of the sampled pages.
COMPOSED_PAGES = 450
#: Nodes that the trees are fitted on, at most; taken evenly.
TRAINING_NODES = 30_000
SEED = 42
_BATCH = 1 << 20
_SEMANTIC = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}


class Composer:
    """Pages of known structure: an article among menus, notices, adverts, comments and so on."""

    def __init__(self, texts: list[str], seed: int = SEED):
        self.texts = texts
        self.draw = random.Random(seed)

    def _text(self, low: int, high: int) -> str:
        words = self.draw.choice(self.texts).split()
        n = self.draw.randint(low, high)
        at = self.draw.randrange(max(1, len(words) - n + 1))
        return html.escape(" ".join(words[at : at + n]), quote=False)

    def _links(self, n: int) -> str:
        return "".join(f'<li><a href="#">{self._text(1, 5)}</a></li>' for _ in range(n))

    def _name(self, group: str, plain: float) -> str:
        if self.draw.random() < plain:
            return self.draw.choice(["", ' class="c1 x"', ' id="b2"', ' class="row"', ' class="box inner"'])
        words = [w for w in HINTS[group].split() if w not in ("input", "option", "label", "body", "head", "foot")]
        word = self.draw.choice(words)
        word = self.draw.choice([word, f"site-{word}", f"{word}-box", f"{word}_list", f"my{word.title()}"])
        return f' {self.draw.choice(["class", "id", "class"])}="{word}"'

    def _junk(self, group: str) -> str:
        draw = self.draw
        if group == "nav":
            inner = f"<ul>{self._links(draw.randint(3, 9))}</ul>"
        elif group == "header":
            inner = f"<div>{self._text(1, 4)}</div><p>{self._text(2, 10)}</p>" + draw.choice(["", f"<ul>{self._links(4)}</ul>"])
        elif group == "footer":
            inner = f"&copy; {self._text(1, 3)} &middot; {self._text(2, 14)}" + draw.choice(["", f"<ul>{self._links(3)}</ul>"])
        elif group == "side":
            inner = f"<h3>{self._text(1, 4)}</h3><ul>{self._links(draw.randint(2, 6))}</ul>" + draw.choice(["", f"<p>{self._text(5, 40)}</p>"])
        elif group == "notice":
            inner = f"<p>{self._text(4, 30)}</p><button>{self._text(1, 2)}</button>"
        elif group == "advert":
            inner = draw.choice([self._text(3, 14), f'<a href="#">{self._text(3, 10)}</a>', f"<p>{self._text(4, 25)}</p>"])
        elif group == "form":
            inner = f"<label>{self._text(1, 4)}</label><input><select><option>{self._text(1, 2)}<option>{self._text(1, 2)}</select><button>{self._text(1, 2)}</button>"
        elif group == "comment":
            inner = f"<h3>{self._text(1, 3)}</h3>" + "".join(
                f"<{t}{c}><b>{self._text(1, 2)}</b><p>{self._text(3, 60)}</p></{t}>"
                for t, c in [(draw.choice(["div", "li"]), self._name("comment", 0.5))] for _ in range(draw.randint(1, 6))
            )
        else:
            inner = f"<ul>{self._links(draw.randint(2, 5))}</ul>"
        semantic = _SEMANTIC.get(group) if draw.random() < 0.5 else None
        tag = semantic or draw.choice(["div", "section", "div"])
        # Without a telling tag, a telling name, but for what its shape gives away.
        plain = 0.6 if semantic or group in ("nav", "footer") else 0.0
        return f'<{tag}{self._name(group, plain)} {MARK}="0">{inner}</{tag}>'

    def _article(self) -> str:
        draw = self.draw
        title = f"<h1>{self._text(2, 9)}</h1>"
        parts = [f'<header class="post-header">{title}</header>' if draw.random() < 0.15 else title]
        for _ in range(draw.choice([1, 2, 3, 4, 6, 9, 14])):
            kind = draw.random()
            text = self._text(4, draw.choice([12, 60, 150]))
            if kind < 0.72:
                open_, close = draw.choice([("<p>", "</p>"), ("<p>", "</p>"), ("<p>", ""), ("<div>", "</div>"), ("<p><b>", "<br>")])
                parts.append(f"{open_}{text}{close}")
            elif kind < 0.8:
                parts.append(f"<h2>{self._text(1, 6)}</h2>")
            elif kind < 0.87:
                parts.append("<ul>" + "".join(f"<li>{self._text(2, 20)}</li>" for _ in range(draw.randint(2, 6))) + "</ul>")
            elif kind < 0.94:
                parts.append(f'<p>{text} <a href="#">{self._text(1, 3)}</a> {self._text(2, 30)}</p>')
            else:
                parts.append(f"<blockquote><p>{text}</p></blockquote>")
        for group in draw.sample(["advert", "side", "share", "form", "notice", "comment"], draw.choice([0, 0, 0, 1, 2])):
            parts.insert(len(parts) if group == "comment" else draw.randint(1, len(parts)), self._junk(group))
        tag = draw.choice(["article", "article", "main", "div", "section"])
        plain = 0.5 if tag in ("article", "main") else 0.25
        out = f'<{tag}{self._name("main", plain)} {MARK}="1">{"".join(parts)}</{tag}>'
        return f"<div{self._name('main', 0.7)}>{out}</div>" if draw.random() < 0.3 else out

    def page(self) -> str:
        draw = self.draw
        def some(groups, share):
            return [self._junk(g) for g in groups if draw.random() < share]

        top = some(["header", "nav", "notice", "advert", "form"], 0.5)
        tail = some(["comment", "side", "advert", "notice", "share", "form"], 0.4) + some(["footer"], 0.8)
        # A wrapper with a promising name may hold much that isn't the article.
        middle = [self._article(), *tail]
        if draw.random() < 0.4:
            at = draw.randint(1, len(middle))
            middle[:at] = [f"<div{self._name('main', 0.3)}>{''.join(middle[:at])}</div>"]
        return "".join(top + middle)


def _labelled(page: str) -> str | None:
    """A page with one ``article`` (or ``main``) marked as the main text and all else as not."""
    for tag in ("article", "main"):
        if page.count(f"<{tag}") == 1:
            return f'<div {MARK}="0">{page.replace(f"<{tag}", f"<{tag} {MARK}=\"1\"")}</div>'
    return None


def train(pages: list[str]) -> Trees:
    """Fit on pages with a landmark and on pages composed of the pages' texts.

    Inside a landmark, nodes whose names say that they are something else have no label.
    Deterministic for the same pages. Without any text pages are composed of fixed ones.
    """
    texts = []
    for page in pages:
        nodes = Nodes()
        nodes.add_page(0, page)
        texts += [t for t in nodes.text if t.count(" ") >= 8]
    composer = Composer(texts or PLAIN_TEXTS)
    marked = [p for p in map(_labelled, pages) if p]
    composed = [composer.page() for _ in range(COMPOSED_PAGES)]
    nodes = Nodes()
    for i, source in enumerate(marked):
        nodes.add_page(i, source)
    junk = sum(1 << i for i, group in enumerate(HINTS) if group != "main")
    nodes.label = [-1 if y == 1 and a & junk else y for y, a in zip(nodes.label, nodes.above)]
    for i, source in enumerate(composed, len(marked)):
        nodes.add_page(i, source)
    y = nodes.targets()
    known = np.flatnonzero(y >= 0)
    known = known[:: max(1, -(-len(known) // TRAINING_NODES))]
    return fit(nodes.features()[known], y[known].astype(float))


def extract(pages: list[str], trees: Trees) -> list[str]:
    """Main texts of pages."""
    nodes = Nodes()
    for i, page in enumerate(pages):
        nodes.add_page(i, page)
    return nodes.texts(nodes.decode(trees.score(nodes.features())), len(pages)) if pages else []


def fit_on(pages: DataFrame, html_col: str = "html") -> Trees:
    """Train on the driver on the different pages of least hash, bounded by number and bytes.

    A page counts whatever its size, so with larger pages there are fewer; of a first one
    beyond the bound, its beginning is taken.
    """
    rows = pages.select(F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("at", F.xxhash64("html"))
    sizes = (
        rows.select("at", F.octet_length("html").alias("size"))
        .groupBy("at").agg(F.max("size").alias("size")).orderBy("at").limit(SAMPLE_PAGES).collect()
    )
    chosen, held = [], 0
    for r in sizes:
        if chosen and held + r["size"] > SAMPLE_BYTES:
            break
        chosen.append(r["at"])
        held += r["size"]
    sample = (
        rows.where(F.col("at").isin(chosen)).withColumn("html", F.substring("html", 1, SAMPLE_BYTES))
        .groupBy("at").agg(F.min("html").alias("html"))
    )
    return train(sorted(r["html"] for r in sample.collect()))


def main_texts(
    df: DataFrame, trees: Trees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of ``df``; null html is empty.

    Repeated rows stay. Other columns of ``df`` are not read. The trees are a few
    hundred kilobytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, _BATCH):
            texts = extract([t or "" for t in batch.column(2).to_pylist()], trees)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ], ["page_id", "url", "text", "n_chars"])

    narrow = df.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).alias("html"),
    )
    return narrow.mapInArrow(run, "page_id long, url string, text string, n_chars long")
