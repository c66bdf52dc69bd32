"""Main-text extraction by a recurrent block labeller.

A page is a sequence of leaf blocks (``blocks``), read whole: a long one in pieces, with the states carried from
piece to piece in both directions.  Each block is read as a vector: its tag path
(tags, class and id words, hashed, the nearest elements also on their own), its words (hashed)
and a few sizes.  A bidirectional LSTM in numpy reads the whole sequence and labels every block
article or not, so a block is judged by the page around it.

The labeller is trained on a bounded sample of the table: ``SAMPLE`` pages are collected, their
blocks are sorted into article and other text by the semantic elements the pages use, and the
texts are laid out anew as pages of many layouts, in which every block's label is known, with
the article and each kind of other text under various tags and class names.  Training is
seeded; equal samples give equal weights.
"""
from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import PATH, leaves, place
from .bpe import Cache
from .common import batches, rows_of, ship, thinned

SAMPLE = 300          # pages the labeller is trained on (documented bound)
SAMPLE_CHARS = 20_000  # only pages up to this long are drawn for training
LAYOUTS = 1_500       # pages laid out for training
NEAR, WORDS, SIZES = 128, 24, 8
DIM = PATH + NEAR + WORDS + SIZES
DEPTH = 16            # a deeper block's depth counts as this; layouts are less deep
HIDDEN = 16
GROUP = 64            # pages labelled together
PIECE = 2_048         # blocks of a page that are held as vectors at once
EPOCHS, RATE = 5, 0.01
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_blocks", pa.int64()), ("n_kept", pa.int64())])
PAGES_DDL = "page_id long, url string, text string, n_blocks long, n_kept long"


def path_places(path: tuple[tuple[str, ...], ...]) -> np.ndarray:
    """Places of a path's names: all elements, and the two nearest on their own."""
    names = {n for e in path for n in e}
    near = {f"{d}{n}" for d, e in enumerate(reversed(path[-2:])) for n in e}
    return np.array(sorted({place(n, PATH) for n in names} | {PATH + place(n, NEAR) for n in near}), np.int64)


class Reader:
    """Pages to matrices, a row per block, with a bounded cache of paths."""

    def __init__(self):
        self.paths = Cache(path_places)

    def page(self, found: list[tuple], start: int = 0, total: int | None = None) -> np.ndarray:
        """A row per block; ``found`` are the blocks from the ``start``-th on of a page with ``total`` blocks (default: all of it)."""
        n, total = len(found), len(found) if total is None else total
        x = np.zeros((n, DIM), np.float32)
        places, hashes, lengths, sizes = [], [], [], []
        for i, (path, text, linked) in enumerate(found):
            places.append(self.paths[path] + i * DIM)
            words = text.lower().encode("utf-8", "surrogatepass").split() or [b""]
            hashes += map(zlib.crc32, words)
            lengths.append(len(words))
            ends = text.count(".") + text.count("!") + text.count("?")
            sizes.append((len(words), len(text), linked, ends, text[-1] in ".!?:;…", text[0].isupper(), (start + i) / max(1, total - 1), len(path)))
        x.ravel()[np.concatenate(places)] = 1
        length, size = np.array(lengths), np.array(sizes, np.float32)
        row = np.repeat(np.arange(n) * WORDS, length)
        counts = np.bincount(row + np.array(hashes) % WORDS, minlength=n * WORDS).reshape(n, WORDS)
        x[:, PATH + NEAR:PATH + NEAR + WORDS] = np.sqrt(counts / length[:, None])
        words, chars, linked, ends = size[:, :4].T
        x[:, -SIZES:] = size
        x[:, -SIZES:-4] = np.stack([np.log1p(words) / 4, np.log1p(chars) / 6, np.minimum(1, linked / chars), np.minimum(1, ends / words * 4)], 1)
        x[:, -1] = np.minimum(x[:, -1], DEPTH) / 10
        return x


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction: input, forget, output gates and candidate in one matrix."""

    def __init__(self, rng):
        self.w = rng.normal(0, 0.15, (DIM + HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1

    def forward(self, x: np.ndarray, keep: bool = False, state: tuple | None = None):
        """x: steps, pages, features; returns the states of all steps (and what training needs).  ``state`` is that of the
        step before, by default nought; ``last`` is that of the last step."""
        steps, pages, _ = x.shape
        h, c = state or (np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32))
        inputs = x.reshape(-1, DIM) @ self.w[:DIM] + self.b
        inputs, out, tape = inputs.reshape(steps, pages, -1), np.empty((steps, pages, HIDDEN), np.float32), []
        for t in range(steps):
            z = inputs[t] + h @ self.w[DIM:]
            gates, cand = sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            i, f, o = np.split(gates, 3, axis=1)
            old, prior = c, h
            c = f * c + i * cand
            th = np.tanh(c)
            h = o * th
            out[t] = h
            if keep:
                tape.append((prior, old, i, f, o, cand, th))
        self.last = h, c
        return out, tape

    def backward(self, x: np.ndarray, tape: list, grad: np.ndarray):
        """Gradients of the weights, given those of the states."""
        dw, db = np.zeros_like(self.w), np.zeros_like(self.b)
        dh = dc = np.zeros(grad.shape[1:], np.float32)
        for t in reversed(range(len(tape))):
            prior, old, i, f, o, cand, th = tape[t]
            dh = dh + grad[t]
            dc = dc + dh * o * (1 - th * th)
            dz = np.concatenate([dc * cand * i * (1 - i), dc * old * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - cand * cand)], axis=1)
            dw[:DIM] += x[t].T @ dz
            dw[DIM:] += prior.T @ dz
            db += dz.sum(0)
            dh, dc = dz @ self.w[DIM:].T, dc * f
        return dw, db


class Labeller:
    """Forward and backward LSTM and a logistic output over both states."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.fore, self.back = Lstm(rng), Lstm(rng)
        self.v, self.a = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.fore.w, self.fore.b, self.back.w, self.back.b, self.v, self.a]

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Steps by pages, forward and reversed within each page's length, and the lengths."""
        n = np.array([len(p) for p in pages])
        x = np.zeros((n.max(), len(pages), DIM), np.float32)
        y = np.zeros_like(x)
        for j, p in enumerate(pages):
            x[:len(p), j], y[:len(p), j] = p, p[::-1]
        return x, y, n

    @staticmethod
    def turned(h: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.zeros_like(h)
        for j, k in enumerate(n):
            out[:k, j] = h[:k, j][::-1]
        return out

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of article for every block of every page."""
        x, y, n = self.padded(pages)
        hf, hb = self.fore.forward(x)[0], self.turned(self.back.forward(y)[0], n)
        p = sigmoid(hf @ self.v[:HIDDEN] + hb @ self.v[HIDDEN:] + self.a)
        return [p[:k, j] for j, k in enumerate(n)]

    def label_long(self, found: list[tuple], read: Reader, piece: int = PIECE) -> np.ndarray:
        """What ``label`` gives for one page, from pieces of it: each direction goes through the page with its state
        carried from piece to piece, and only a number per block is kept."""
        out, n = np.zeros(len(found), np.float32), len(found)
        starts = range(0, n, piece)
        for lstm, v, order in ((self.fore, self.v[:HIDDEN], starts), (self.back, self.v[HIDDEN:], reversed(starts))):
            state, step = None, -1 if lstm is self.back else 1
            for i in order:
                x = read.page(found[i:i + piece], i, n)[::step]
                out[i:i + piece] += (lstm.forward(x[:, None], state=state)[0][:, 0] @ v)[::step]
                state = lstm.last
        return sigmoid(out + self.a)

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 7) -> None:
        """Adam on the mean log loss of blocks, pages of like length together."""
        rng = np.random.default_rng(seed)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        groups = [order[i:i + 24] for i in range(0, len(order), 24)]
        m, s, step = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights], 0
        for _ in range(epochs):
            for g in rng.permutation(len(groups)):
                some = groups[g]
                x, y, n = self.padded([pages[i] for i in some])
                (hf, tf), (hr, tb) = self.fore.forward(x, True), self.back.forward(y, True)
                hb = self.turned(hr, n)
                p = sigmoid(hf @ self.v[:HIDDEN] + hb @ self.v[HIDDEN:] + self.a)
                err = np.zeros_like(p)
                for j, i in enumerate(some):
                    err[:n[j], j] = p[:n[j], j] - labels[i]
                err /= n.sum()
                dv = np.concatenate([np.einsum("tp,tph->h", err, hf), np.einsum("tp,tph->h", err, hb)])
                gf = self.fore.backward(x, tf, err[:, :, None] * self.v[:HIDDEN])
                gb = self.back.backward(y, tb, self.turned(err[:, :, None] * self.v[HIDDEN:], n))
                step += 1
                for w, d, mm, ss in zip(self.weights, (*gf, *gb, dv, err.sum(keepdims=True).reshape(1)), m, s):
                    mm += 0.1 * (d - mm)
                    ss += 0.01 * (d * d - ss)
                    w -= RATE * (mm / (1 - 0.9 ** step)) / (np.sqrt(ss / (1 - 0.99 ** step)) + 1e-8)


# ---- training layouts ----------------------------------------------------------------------

#: Elements that frame each kind of text (tag and class); the labeller is to know them in any mix.
ARTICLE = ["article", "main", "div class=content", "div class=post", "div class=entry-content", "div id=main", "section class=story",
           "div class=article-body", "div itemprop=articleBody", "div class=page-content", "div role=main", "div", "td class=content", "section", ""]
OTHER = {
    "menu": ["nav", "ul class=menu", "div class=navbar", "div id=navigation", "div class=breadcrumbs", "ol class=breadcrumb", "div class=topnav", "div class=pagination"],
    "header": ["header", "div class=header", "div id=masthead", "div class=topbar", "div class=site-title", "div class=logo"],
    "footer": ["footer", "div class=footer", "div id=footer", "div class=copyright", "div class=site-info", "div class=colophon"],
    "sidebar": ["aside", "div class=sidebar", "div id=sidebar", "div class=widget", "div class=related", "div class=recommended", "div class=trending", "div class=tags", "div class=share"],
    "notice": ["div class=notice", "div class=cookie-banner", "div class=alert", "div id=consent", "div class=warning", "div class=popup", "div role=alert", "div class=paywall"],
    "advert": ["div class=ad", "div class=advert", "div class=sponsored", "ins class=adsbygoogle", "div class=promo", "div class=banner", "div id=ads", "div class=advertisement"],
    "form": ["form", "div class=newsletter", "form class=search", "div class=subscribe", "div class=login", "form id=contact"],
    "comments": ["div class=comments", "section id=comments", "ol class=commentlist", "div class=comment", "div class=replies", "ul class=discussion", "div class=comment-list", "article class=comment"],
}
FRAME = ["div class=wrapper", "div class=container", "div id=page", "div", "div class=row", "section"]


def opened(element: str) -> tuple[str, str]:
    if not element:
        return "", ""
    tag, _, rest = element.partition(" ")
    if rest:
        key, _, value = rest.partition("=")
        rest = f' {key}="{value}"'
    return f"<{tag}{rest}>", f"</{tag}>"


class Layouts:
    """Lays texts out as labelled pages; a block's label is found again by its text's number."""

    def __init__(self, article: list[str], other: list[str], seed: int):
        self.rng = random.Random(seed)
        self.article, self.other = article, other

    def words(self, low: int, high: int, kind: str = "any") -> str:
        """Some text of the sample, cut to a number of words; both kinds of text supply both
        labels, so that the labeller can't lean on words alone."""
        source = self.article if kind == "article" or not self.other or self.rng.random() < 0.5 else self.other
        text = self.rng.choice(source).split()
        n = self.rng.randint(low, high)
        i = self.rng.randrange(max(1, len(text) - n + 1))
        return " ".join(text[i:i + n]).replace("&", "&amp;").replace("<", "&lt;") or "x"

    def put(self, out: list, text: str, label: int, tag: str | None = None) -> None:
        a, b = opened(tag) if tag else ("", "")
        out.append((f"{a}{text}{b}", label))

    def listed(self, low: int, high: int, kind: str, linked: float = 0.0, deep: bool = True) -> str:
        """A list of some kind: ``ul``, ``ol``, ``dl``, nested or not, items linked or not."""
        r = self.rng
        words = lambda: f"<a href=x>{self.words(1, 6, kind)}</a>" if r.random() < linked else self.words(low, high, kind)
        n = r.choice([1, 2, 3, 3, 5, 8])
        if r.random() < 0.2:
            return "<dl>" + "".join(f"<dt>{self.words(1, 4, kind)}</dt><dd>{words()}</dd>" for _ in range(n)) + "</dl>"
        tag = r.choice(["ul", "ol"])
        items = "".join(f"<li>{words()}{self.listed(low, high, kind, linked, False) if deep and r.random() < 0.15 else ''}</li>" for _ in range(n))
        return f"<{tag}>{items}</{tag}>"

    def block(self, text: str, kind: str, inner: str) -> str:
        """Text as a block of any tag; article and other text use the same ones, so no tag alone tells them apart."""
        r, k = self.rng, self.rng.random()
        if k < 0.14:
            h = r.choice(["h2", "h2", "h3", "h3", "h4", "h5", "h6"])
            return f"<{h}>{self.words(1, 9, kind)}</{h}>"
        if k < 0.22:
            return self.listed(1, r.choice([3, 12, 40]), kind)
        if k < 0.25:
            return f"<blockquote><p>{text}</p></blockquote>"
        if k < 0.29:
            rows = "".join(f"<tr><{c}>{self.words(1, 6, kind)}</{c}><td>{self.words(1, 9, kind)}</td></tr>" for c in r.choices(["td", "th"], k=r.randint(1, 4)))
            return f"<table>{rows}</table>"
        if k < 0.31:
            return f"<figure><figcaption>{text}</figcaption></figure>"
        if k < 0.33:
            return f"<pre>{text}</pre>"
        if k < 0.36:
            return f"<details><summary>{self.words(1, 6, kind)}</summary><p>{text}</p></details>"
        if k < 0.44:
            return f"<p><b>{text}<br>"
        if k < 0.49:
            return f"<p>{text} <a href=x>{self.words(1, 3)}</a></p>"
        if k < 0.52:
            return "<p>" + " ".join(f"<a href=x>{self.words(1, 4, kind)}</a>" for _ in range(r.randint(1, 4))) + r.choice(["", ".", f" {self.words(1, 5, kind)}."]) + "</p>"
        a, b = opened(inner)
        return f"{a}{text}{b}"

    def story(self) -> list:
        r, out = self.rng, []
        inner = r.choice(["p", "p", "p", "div", "div"])
        if r.random() < 0.85:
            head = f"<h1>{self.words(2, 12, 'article')}</h1>"
            out.append((f"<header>{head}</header>" if r.random() < 0.2 else head, 1))
        for _ in range(r.choice([1, 2, 3, 5, 8, 13, 20])):
            out.append((self.block(self.words(1, r.choice([4, 20, 80, 160]), "article"), "article", inner), 1))
            if r.random() < 0.06:
                out += self.extra(r.choice(["advert", "notice", "sidebar"]))
        return out

    def extra(self, kind: str) -> list:
        r, out = self.rng, []
        a, b = opened(r.choice(OTHER[kind]))
        out.append((a, None))
        if kind in ("menu", "sidebar") and r.random() < 0.8:
            if r.random() < 0.3:
                self.put(out, self.words(1, 4), 0, r.choice(["h2", "h3", "h4", "h5", "h6", "p", "span"]))
            out.append(("<ul>", None))
            out += [(f"<li><a href=x>{self.words(1, 5)}</a></li>", 0) for _ in range(r.randint(2, 9))]
            out.append(("</ul>", None))
        elif kind == "comments":
            for _ in range(r.randint(1, 5)):
                self.put(out, self.words(1, 4), 0, r.choice(["span", "div class=author", "h3", "h4", "h5"]))
                self.put(out, self.words(3, 60), 0, r.choice(["p", "div class=comment-body", "li", "p"]))
        elif kind == "form":
            out += [(f"<label>{self.words(1, 4)}</label><input type=text>", 0), (f"<button>{self.words(1, 3)}</button>", 0)]
            if r.random() < 0.4:
                out.append((f"<select><option>{self.words(1, 2)}</option><option>{self.words(1, 2)}</option></select>", 0))
        else:
            for _ in range(r.randint(1, 3)):
                text = self.words(1, r.choice([6, 15, 40]))
                if r.random() < 0.3 and kind in ("sidebar", "notice", "advert"):
                    out.append((self.block(text, "any", r.choice(["p", "div"])), 0))
                elif r.random() < 0.1:
                    out.append((self.listed(1, 6, "any", 0.7), 0))
                else:
                    self.put(out, f"&copy; {text}" if kind == "footer" and r.random() < 0.5 else text, 0,
                             r.choice([None, "p", "p", "div", "h2", "h3", "h4", "h5", "span", *["h1"] * 3 * (kind == "header")]))
                out.append(("<hr>", None))
        out.append((b, None))
        return out

    def page(self) -> tuple[str, list[int]]:
        """HTML and the labels of its blocks in order."""
        r, out = self.rng, [("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>", None)]
        frames = [opened(r.choice(FRAME)) for _ in range(r.choice([0, 0, 1, 2]))]
        out += [(a, None) for a, _ in frames]
        for kind, chance in (("notice", 0.25), ("header", 0.35), ("menu", 0.75), ("advert", 0.4), ("sidebar", 0.2), ("form", 0.15)):
            if r.random() < chance:
                out += self.extra(kind)
        a, b = opened(r.choice(ARTICLE[:1] * 8 + ARTICLE))
        out += [(a, None), *(self.story() if r.random() > 0.03 else []), (b, None)]
        for kind, chance in (("advert", 0.25), ("sidebar", 0.35), ("comments", 0.35), ("form", 0.25), ("notice", 0.1), ("footer", 0.8)):
            if r.random() < chance:
                out += self.extra(kind)
        out += [(b, None) for _, b in reversed(frames)]
        text, want = "", []
        for piece, label in out:
            text += piece
            if label is not None:
                want += [label] * len(list(leaves(piece)))
        return text + "</body></html>", want


def sort_blocks(pages: list[str]) -> tuple[list[str], list[str]]:
    """Texts of the sample under an article's element, and the others."""
    article, other = [], []
    for page in pages:
        for path, text, _ in leaves(page):
            tags = {e[0] for e in path}
            (article if tags & {"article", "main"} and not tags & {"nav", "aside", "footer", "form"} else other).append(text)
    return article or other or ["x"], other


def train_labeller(pages: list[str], layouts: int = LAYOUTS, seed: int = 7) -> tuple[Labeller, float]:
    """A labeller trained on layouts of the sample's texts, and its block accuracy on layouts
    held out (one in ten)."""
    make, read, model = Layouts(*sort_blocks(pages), seed), Reader(), Labeller(seed)
    x, y = [], []
    while len(x) < layouts:
        text, want = make.page()
        found = list(leaves(text))
        if found and len(found) == len(want):
            x.append(read.page(found))
            y.append(np.array(want, np.float32))
    held = layouts // 10
    model.train(x[held:], y[held:], seed=seed)
    right = [np.mean((p > 0.5) == w) for p, w in zip(model.label(x[:held]), y[:held])] if held else [1.0]
    return model, float(np.mean(right))


# ---- extraction ----------------------------------------------------------------------------

def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html; others are not read): page_id, url, text (article
    blocks joined by a blank line, empty if none), n_blocks, n_kept.

    Null or empty html has no block; repeated rows and null ids stay; whole pages are read, block
    by block, and nothing is cut.  The weights are broadcast (their size is fixed).
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    drawn = (thinned(rows, rows.count(), sample, "page_id", "url").filter(F.length("html").between(1, SAMPLE_CHARS)).orderBy(F.xxhash64("url", "page_id"), "html").select("html").limit(sample))
    model, _ = train_labeller(sorted(r[0] for r in drawn.collect()))
    shared = spark.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, read = shared.value, Reader()

        def labelled(held):
            some = [i for i, h in enumerate(held) if h[2]]
            some.sort(key=lambda i: len(held[i][2]))
            marks = {}
            at = 0
            while at < len(some):         # pages of like length together, bounded by their blocks with those that fill up
                n, longest = 1, len(held[some[at]][2])
                while at + n < len(some) and (n + 1) * len(held[some[at + n]][2]) <= 2 * PIECE:
                    longest = len(held[some[at + n]][2])
                    n += 1
                part = some[at:at + n]
                if longest > PIECE:
                    marks |= {i: labeller.label_long(held[i][2], read) for i in part}
                else:
                    marks |= zip(part, labeller.label([read.page(held[i][2]) for i in part]))
                at += n
            for i, (page_id, url, found) in enumerate(held):
                kept = [b[1] for b, p in zip(found, marks.get(i, ())) if p > 0.5]
                yield page_id, url, "\n\n".join(kept), len(found), len(kept)

        def texts():
            held, size = [], 0
            for batch in it:
                for page_id, url, page in rows_of(batch, "page_id", "url", "html", step=64):
                    same: dict = {}        # equal paths are held once
                    held.append((page_id, url, [(same.setdefault(path, path), text, linked) for path, text, linked in leaves(page)]))
                    size += len(page or "")
                    if len(held) == GROUP or size > 1 << 22:
                        yield from labelled(held)
                        held, size = [], 0
            yield from labelled(held)

        yield from batches(texts(), PAGES, lambda r: len(r[2]))

    return rows.mapInArrow(run, PAGES_DDL)


def main_text(extracted: DataFrame) -> DataFrame:
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
