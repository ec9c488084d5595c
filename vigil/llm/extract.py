"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks in page order. Each block is described by its
tag path (tags, class and id words, hashed), its words (hashed counts) and a
few figures. A bidirectional LSTM in numpy reads the whole sequence and
labels every block as main text or not, so a block's label depends on all of
the page.

The labeller is trained on a bounded sample of the pages themselves: blocks
inside article or main elements and outside navigation, forms and the like
are main text; the sampled blocks are also set into other layouts (other
containers, side bars, notices, reader comments), where the labels are known
by construction."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sample_by_hash

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: raw text: no markup up to the end tag, and no visible text
RAW = frozenset("script style textarea title iframe".split())
#: elements of other languages: there a slash closes a tag, and RAW names are ordinary
FOREIGN = frozenset(("svg", "math"))
#: elements whose text a page does not show as text, anywhere and in FOREIGN only
UNSEEN = frozenset(("template", "select"))
UNSEEN_FOREIGN = frozenset("script style title desc metadata annotation annotation-xml".split())
BLOCKS = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
                    "nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
#: a start tag of the key ends an open element of the values, up to a container
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
# Words that name the parts of a page.
MAIN_TAGS = frozenset(("article", "main"))
SIDE_TAGS = frozenset(("nav", "footer", "aside", "form", "header", "button", "dialog", "menu", "head"))
MAIN_NAMES = ("article", "content", "post", "entry", "story", "main", "body", "text")
SIDE_NAMES = {
    "menu": ("menu", "nav", "navbar", "breadcrumb", "topbar"), "header": ("header", "banner", "masthead", "top"),
    "footer": ("footer", "copyright", "bottom", "legal"), "sidebar": ("sidebar", "widget", "related", "aside", "promo"),
    "notice": ("notice", "cookie", "consent", "popup", "alert", "newsletter", "modal"),
    "advert": ("ad", "ads", "advert", "sponsored", "sponsor", "banner"),
    "comment": ("comments", "comment", "replies", "discussion", "respond"),
    "form": ("form", "search", "login", "signup", "subscribe"), "share": ("share", "social", "tags", "pagination"),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attr>(?>[^>\"']++|\"[^\"]*\"|'[^']*')*+)/?>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attr2>[^>]*)(?:>|\Z)|[^<]+|<", re.S)
_NAME = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


def _names(attr: str) -> tuple[str, ...]:
    if "=" not in attr:
        return ()
    return tuple(w for m in _NAME.finditer(attr) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower()))


class Block:
    """A leaf block: text, its path of (tag, names), and link characters."""

    __slots__ = ("text", "path", "links")

    def __init__(self, text: str, path: tuple, links: int):
        self.text, self.path, self.links = text, path, links


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks of visible text, white space folded. Raw text,
    templates, choices of a form and what svg and math do not draw are left
    out; text of math, svg, object and noscript is text like any other."""
    stack: list[tuple[str, tuple[str, ...]]] = []
    hides: list[bool] = []  # elements of the stack whose text is not shown
    out: list[Block] = []
    parts: list[str] = []
    links, in_link, hidden, foreign = 0, 0, 0, 0
    at, end = 0, len(page)

    def flush():
        nonlocal parts, links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(stack), links))
        parts, links = [], 0

    def pop(depth: int):
        nonlocal in_link, hidden, foreign
        in_link -= sum(t == "a" for t, _ in stack[depth:])
        foreign -= sum(t in FOREIGN for t, _ in stack[depth:])
        hidden -= sum(hides[depth:])
        del stack[depth:], hides[depth:]

    def drawn() -> int:
        """Place of the svg or math element that the next tag belongs to, or -1."""
        for depth in range(len(stack) - 1, -1, -1) if foreign else ():
            if stack[depth][0] == "foreignobject":
                break
            if stack[depth][0] in FOREIGN:
                return depth
        return -1

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            s = m[0]
            if hidden <= 0 and (s[0] != "<" or s == "<"):
                parts.append(s)
                if in_link > 0:
                    links += len(s)
            continue
        tag = tag.lower()
        closing = bool(m["end"] or m["end2"])
        inside = drawn()
        if tag in BLOCKS and inside >= 0:  # a block ends an open svg or math
            pop(inside)
            inside = drawn()
        if tag in RAW and not closing and inside < 0:
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in BLOCKS:
            flush()
        if tag == "br":
            parts.append(" ")
        if tag in VOID or (tag in RAW and inside < 0):
            continue
        if not closing and m[0].endswith("/>") and (inside >= 0 or tag in FOREIGN):
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    pop(depth)
                    break
            continue
        if tag in BLOCKS:  # a paragraph ends where a block begins; inline elements in it end too
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ("p", "select"):
                    pop(depth)
                    break
                if stack[depth][0] in BLOCKS or stack[depth][0] in ("object", "template"):
                    break
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in IMPLIED.get(tag, ()):
                pop(depth)
                break
            if stack[depth][0] in ("ul", "ol", "table", "dl", "div", "article", "section"):
                break
        stack.append((tag, _names(m["attr"] or m["attr2"] or "")))
        hides.append(tag in UNSEEN or (inside >= 0 and tag in UNSEEN_FOREIGN))
        hidden += hides[-1]
        foreign += tag in FOREIGN
        in_link += tag == "a"
    flush()
    return out


# ----------------------------------------------------------------- features

PATH, WORDS, FIGURES = 96, 32, 7
WIDTH = PATH + WORDS + FIGURES
#: padded blocks of the pages that are labelled together, and steps of them whose inputs are multiplied at once
CELLS, STRETCH = 16_384, 512
#: characters of html that are parsed before their blocks are labelled
PAGE_CHARS = 4_000_000


@lru_cache(maxsize=200_000)
def _bucket(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple) -> np.ndarray:
    v = np.zeros(PATH, np.float32)
    for depth, (tag, names) in enumerate(path):
        if tag in ("html", "body"):
            continue
        v[_bucket("t:" + tag, PATH)] = 1
        for n in names:
            v[_bucket("n:" + n, PATH)] = 1
        if depth == len(path) - 1:
            v[_bucket("leaf:" + tag, PATH)] = 1
    return v


def page_features(blocks: list[Block]) -> np.ndarray:
    """One row per block of a page."""
    x = np.zeros((len(blocks), WIDTH), np.float32)
    for i, b in enumerate(blocks):
        words = b.text.split(" ")
        x[i, :PATH] = _path_vector(b.path)
        counts = np.bincount([_bucket(w, WORDS) for w in words], minlength=WORDS)
        x[i, PATH:PATH + WORDS] = counts / len(words)
        t = b.text
        x[i, PATH + WORDS:] = (
            np.log1p(len(t)) / 8, min(b.links / len(t), 1.0), t.count(".") / len(words), t.count(",") / len(words),
            i / len(blocks), np.log1p(len(blocks)) / 6, t[-1] in ".!?")
    return x


# -------------------------------------------------------------------- model

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output; arrays are time first."""

    def __init__(self, hidden: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p["W" + d] = (rng.standard_normal((WIDTH + hidden, 4 * hidden)) * 0.1).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1  # remember at first
            self.p["b" + d] = bias
        self.p["V"] = (rng.standard_normal(2 * hidden) * 0.1).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)

    def _run(self, x, mask, d):
        """Hidden states in reading order of direction ``d``, and a tape."""
        steps, n, _ = x.shape
        h = np.zeros((n, self.h), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((steps, n, self.h), np.float32)
        tape = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = np.concatenate([x[t], h], 1)
            g = z @ self.p["W" + d] + self.p["b" + d]
            i, f, o = (_sigmoid(g[:, k * self.h:(k + 1) * self.h]) for k in range(3))
            u = np.tanh(g[:, 3 * self.h:])
            m = mask[t][:, None]
            new = f * c + i * u
            tc = np.tanh(new)
            tape.append((t, z, i, f, o, u, c, tc, m))
            c = np.where(m, new, c)
            h = np.where(m, o * tc, h)
            out[t] = h
        return out, tape

    def scores(self, x, mask):
        hf, tf = self._run(x, mask, "f")
        hb, tb = self._run(x, mask, "b")
        both = np.concatenate([hf, hb], 2)
        return both @ self.p["V"] + self.p["c"], (both, tf, tb)

    def gradients(self, x, mask, y):
        s, (both, tf, tb) = self.scores(x, mask)
        p = _sigmoid(s)
        ds = ((p - y) * mask / max(1, mask.sum())).astype(np.float32)
        grad = {"V": np.einsum("tn,tnh->h", ds, both), "c": np.array([ds.sum()], np.float32)}
        dboth = ds[:, :, None] * self.p["V"]
        for d, tape, part in (("f", tf, dboth[:, :, :self.h]), ("b", tb, dboth[:, :, self.h:])):
            w, b = np.zeros_like(self.p["W" + d]), np.zeros_like(self.p["b" + d])
            dh = np.zeros((x.shape[1], self.h), np.float32)
            dc = np.zeros_like(dh)
            for t, z, i, f, o, u, c, tc, m in reversed(tape):
                dh = dh + part[t]
                go, gn = dh * tc * m, dc * m + dh * o * (1 - tc * tc) * m
                g = np.concatenate([gn * u * i * (1 - i), gn * c * f * (1 - f), go * o * (1 - o), gn * i * (1 - u * u)], 1)
                w += z.T @ g
                b += g.sum(0)
                back = g @ self.p["W" + d].T
                dh = np.where(m, back[:, -self.h:], dh)
                dc = np.where(m, gn * f, dc)
            grad["W" + d], grad["b" + d] = w, b
        return grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, rate: float = 0.01,
              seed: int = 3) -> None:
        """Adam over pages (features, labels), a few of like length a step."""
        rng = np.random.default_rng(seed)
        pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
        batches = [pages[i:i + 32] for i in range(0, len(pages), 32)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                x, mask, y = pad([p[0] for p in batches[k]], [p[1] for p in batches[k]])
                step += 1
                for name, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    self.p[name] -= rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)

    def _outputs(self, x: np.ndarray, sizes: np.ndarray, d: str) -> np.ndarray:
        """What direction ``d`` adds to the scores of pages (time first,
        padded; the longest first), without a tape: of each step one number a
        page stays. A page leaves the matrices where it ends."""
        w, steps = self.p["W" + d], len(x)
        weight = self.p["V"][:self.h] if d == "f" else self.p["V"][self.h:]
        out = np.zeros(x.shape[:2], np.float32)
        h = np.zeros((x.shape[1], self.h), np.float32)
        c = np.zeros_like(h)
        starts = range(0, steps, STRETCH)
        for lo in starts if d == "f" else reversed(starts):
            seen = x[lo:lo + STRETCH] @ w[:WIDTH] + self.p["b" + d]
            order = range(len(seen))
            for t in order if d == "f" else reversed(order):
                n = int(np.searchsorted(-sizes, -(lo + t)))  # pages of more than lo + t blocks
                g = seen[t, :n] + h[:n] @ w[WIDTH:]
                gates = _sigmoid(g[:, :3 * self.h])
                i, f, o = (gates[:, k * self.h:(k + 1) * self.h] for k in range(3))
                c[:n] = f * c[:n] + i * np.tanh(g[:, 3 * self.h:])
                h[:n] = o * np.tanh(c[:n])
                out[lo + t, :n] = h[:n] @ weight
        return out

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text per block and page. Pages of like length
        run together, as many as ``CELLS`` padded blocks hold; a longer page
        runs alone."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: -len(pages[i]))
        lo = 0
        while lo < len(order):
            some = order[lo:lo + max(1, CELLS // len(pages[order[lo]]))]
            lo += len(some)
            sizes = np.array([len(pages[i]) for i in some])
            x, _, _ = pad([pages[i] for i in some])
            s = self._outputs(x, sizes, "f") + self._outputs(x, sizes, "b") + self.p["c"]
            for n, i in enumerate(some):
                out[i] = _sigmoid(s[:len(pages[i]), n])
        return out


def pad(xs, ys=None):
    steps, n = max(map(len, xs)), len(xs)
    x = np.zeros((steps, n, WIDTH), np.float32)
    mask, y = np.zeros((steps, n), bool), np.zeros((steps, n), np.float32)
    for i, a in enumerate(xs):
        x[:len(a), i] = a
        mask[:len(a), i] = True
        if ys is not None:
            y[:len(a), i] = ys[i]
    return x, mask, y


# ----------------------------------------------------------------- training

def known_label(path: tuple, named: bool = False) -> int | None:
    """1: main text, 0: not, by the elements that a block lies in; None on
    pages that do not say. ``named``: elements with a class, id or role of
    main text, and none of another part, count as well."""
    inside = False
    for tag, names in path:
        if tag in MAIN_TAGS:
            inside = True
        if named and tag not in ("html", "body") and any(n in MAIN_NAMES for n in names) and not any(
                n in words for n in names for words in SIDE_NAMES.values()):
            inside = True
        side = any(n in words for n in names for words in SIDE_NAMES.values()) and not any(
            n in MAIN_NAMES for n in names)
        if side or (tag in SIDE_TAGS and not (inside and tag == "header")):
            return 0
    return 1 if inside else None


def known_labels(pages: list[list[Block]]) -> list[list[int | None]]:
    """Labels of the pages' blocks: by article and main elements, on a page
    without such text by names. Where no page says what its main text is, all
    text that is not known to be something else takes its part."""
    known = []
    for page in pages:
        y = [known_label(b.path) for b in page]
        known.append(y if 1 in y else [known_label(b.path, named=True) for b in page])
    if not any(1 in y for y in known):
        known = [[1 if v is None else v for v in y] for y in known]
    return known


def layouts(pages: list[list[Block]], seed: int = 5) -> Iterator[tuple[str, list[int]]]:
    """Pages made of the sampled blocks in other layouts, with labels."""
    rng = np.random.default_rng(seed)
    pick = lambda x: x[int(rng.integers(len(x)))]
    known = known_labels(pages)
    side_text = [b.text for p, y in zip(pages, known, strict=True) for b, v in zip(p, y, strict=True) if v != 1] or ["more"]
    main_text = [b.text for p, y in zip(pages, known, strict=True) for b, v in zip(p, y, strict=True) if v == 1] or ["text"]
    esc = lambda s: html.escape(s, quote=False)
    for page, y in zip(pages, known, strict=True):
        main = [b for b, v in zip(page, y, strict=True) if v == 1]
        if not main:
            continue
        items: list[tuple[str, list[int]]] = []

        def side(kind: str, items=items):
            tag = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}.get(kind)
            named = f'div class="{pick(SIDE_NAMES[kind])}{pick(["", " box", " wrap", "-inner"])}"'
            start = tag if tag and rng.random() < 0.6 else named
            if kind == "comment":
                start = pick([named, named.replace("div", "section"), f'div id="{pick(SIDE_NAMES[kind])}"'])
            n = int(rng.integers(1, 6))
            texts = [pick(main_text if rng.random() < (0.8 if kind == "comment" else 0.25) else side_text)
                     for _ in range(n)]
            if kind == "menu":
                body = "<ul>" + "".join(f'<li><a href="#">{esc(" ".join(t.split()[:3]))}</a></li>' for t in texts) + "</ul>"
            else:
                body = "".join(f"<p>{esc(t)}</p>" for t in texts)
            items.append((f"<{start}>{body}</{start.split()[0]}>", [0] * n))

        for kind in ("menu", "header", "notice", "advert"):
            if rng.random() < 0.5:
                side(kind)
        name = pick(MAIN_NAMES)
        box = pick(["article", "main", "article", f'div class="{name}"', f'div id="{name}"', f'section class="{name}"',
                    'div role="main"', f'article class="{name}"'])
        inner, labels = "", []
        for i, b in enumerate(main):
            tag = b.path[-1][0] if b.path[-1][0] in ("h1", "h2", "h3", "li", "blockquote") else "p"
            inner += f"<{tag}>{esc(b.text)}</{tag}>"
            labels.append(1)
            if rng.random() < 0.15 and i:
                k = len(items)
                side(pick(["advert", "share", "sidebar", "notice"]))
                inner, labels = inner + items[k][0], labels + items.pop()[1]
        if rng.random() < 0.3:
            k = len(items)
            side("comment")
            inner, labels = inner + items[k][0], labels + items.pop()[1]
        items.append((f"<{box}>{inner}</{box.split()[0]}>", labels))
        for kind in ("comment", "sidebar", "share", "form", "advert", "footer"):
            if rng.random() < 0.45:
                side(kind)
        yield ("<html><body>" + "".join(i[0] for i in items) + "</body></html>", [y for i in items for y in i[1]])


def made_pages(n: int = 100, seed: int = 9) -> list[list[Block]]:
    """Pages of an article, a menu and a footer in invented words."""
    rng = np.random.default_rng(seed)

    def text(words: int) -> str:
        return " ".join("".join(rng.choice(list("aeioulnrst"), rng.integers(2, 9))) for _ in range(words))

    return [leaf_blocks(f"<nav><a>{text(2)}</a></nav><article><h1>{text(5)}</h1>" + "".join(
        f"<p>{text(int(rng.integers(15, 60)))}.</p>" for _ in range(int(rng.integers(2, 7))))
        + f"</article><footer>{text(6)}</footer>") for _ in range(n)]


def train(pages: list[str], epochs: int = 8) -> Labeller:
    """Labeller of the sampled pages and of layouts made of their blocks; of
    made pages alone where no sampled page has text that may be main text."""
    parsed = [leaf_blocks(p) for p in pages]
    known = known_labels(parsed)
    if not any(1 in y for y in known):
        parsed = made_pages()
        known = known_labels(parsed)
    data = []
    for blocks, y in zip(parsed, known, strict=True):
        if 1 in y:
            data.append((page_features(blocks), np.array([v or 0 for v in y], np.float32)))
    for turn in range(2):
        for text, labels in layouts(parsed, seed=5 + turn):
            blocks = leaf_blocks(text)
            if len(blocks) == len(labels):
                data.append((page_features(blocks), np.array(labels, np.float32)))
    model = Labeller()
    if data:
        model.train(data, epochs)
    return model


# -------------------------------------------------------------------- Spark

def extract(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", sample: int = 400,
            threshold: float = 0.5) -> DataFrame:
    """Per row: ``key``, ``url``, ``text`` (blocks of main text, joined by an
    empty line) and ``n_chars``.

    Where sampled pages have no article or main element, names of classes,
    ids and roles say what they hold; where none says, all of their text
    outside known other parts (or, without any, made pages) trains the labeller.

    Null and empty html and pages without main text give an empty text; the
    whole page is read; repeated rows and null keys stay; an empty table gives
    an empty one; other columns are ignored. ``sample``: pages, chosen by a
    hash of their html, that the driver trains on (a bound; those of more
    than a million characters are left out of training only)."""
    spark = df.sparkSession
    model = train(sample_by_hash(df, page, sample, F.length(page).between(1, 1_000_000)))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            whole = batch["_html"].fillna("")
            ends = np.cumsum([len(h) for h in whole]) // PAGE_CHARS  # pages of a few MB at a time
            for _, part in batch.assign(_html=whole).groupby(ends, sort=False) if len(batch) else ():
                pages = [leaf_blocks(h) if h else [] for h in part["_html"]]
                labels = m.label([page_features(p) for p in pages])
                texts = ["\n\n".join(b.text for b, p in zip(blocks, label, strict=True) if p >= threshold)
                         for blocks, label in zip(pages, labels, strict=True)]
                yield pd.DataFrame({"_key": part["_key"], "_url": part["_url"], "text": texts,
                                    "n_chars": [len(t) for t in texts]})

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"), F.col(page).alias("_html"))
    out = out.mapInPandas(run, f"_key {kind}, _url string, text string, n_chars bigint")
    return out.select(F.col("_key").alias(key), F.col("_url").alias(url), "text", "n_chars")
