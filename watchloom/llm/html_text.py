"""Main text of HTML pages by a recurrent block labeller.

A page is read into its leaf blocks: runs of text between block boundaries, each with
its tag path (tags, classes and ids of the open elements). A bidirectional LSTM in
numpy reads the sequence of blocks, each as a learned sum over its hashed path
tokens, a hashed vector of its words and a few shapes, and labels every block with
the whole page as context. Blocks labelled main are the page's text.

Pages carry no labels, so the network learns from two bounded sources: layouts
written by ``layouts`` (menus, banners, notices, forms, comments and so on around and
inside articles of many kinds) and a sample of the pages themselves, labelled by what
their element and class names say. Path tokens are dropped at random in training, so
that neighbours and shape must carry the decision where names say nothing.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About so many pages of the table, drawn by a hash of their id, are learned from, and so many written layouts.
SAMPLE_PAGES, LAYOUTS = 160, 320
#: Training reads windows of so many blocks; labelling reads whole pages.
TRAIN_BLOCKS = 40
EPOCHS, RATE, HIDDEN, EMBED, BUCKETS, WORDS = 8, 0.012, 16, 20, 1024, 16
SHAPES = 6
#: A path deeper than this keeps its outer and its inner half; the text of every block stays.
DEPTH = 512
SEED = 7

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|noscript|template|iframe|textarea"
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BARRIER = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
#: The inside of a tag. Quotes count only where a value begins and if they close; nothing is read twice but after a quote
#: that does not close, of which a page has at most one of each sort.
_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|))*+"""
_PIECE = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b{_ATTRS}>.*?(?:</(?P=raw)\s*+>|\Z)|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>{_ATTRS})(?:>|\Z)|(?P<text>[^<]++|<)", re.S | re.I)
_SVG = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<end>/?)svg(?=[\s/>])(?P<attrs>{_ATTRS})(?:>|\Z)", re.S | re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d")
_PART = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    path: tuple[str, ...]  # tokens of the open elements, outermost first; an element starts with "<tag"
    text: str
    linked: int  # characters inside links


def _after_svg(page: str, start: int) -> int:
    """Where the svg element that begins at ``start`` ends: at its own "/>", or where all svg elements opened in it are closed."""
    depth = 0
    for m in _SVG.finditer(page, start):
        if m["end"] is None:
            continue
        if m["end"]:
            depth -= 1
        elif not m["attrs"].endswith("/"):
            depth += 1
        if depth <= 0:
            return m.end()
    return len(page)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; character references decoded, white space single, blank ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    opened: Counter[str] = Counter()  # of the stack, so that an end tag without its element looks for none
    held: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                path = stack if len(stack) <= DEPTH else stack[: DEPTH // 2] + stack[-DEPTH // 2:]
                out.append(Block(tuple(t for _, own in path for t in own), text, min(linked, len(text))))
            held.clear()
        linked = 0

    def close(start: int) -> None:
        opened.subtract(tag for tag, _ in stack[start:])
        del stack[start:]

    past = 0
    while m := _PIECE.match(page, past):
        past = m.end()
        if (text := m["text"]) is not None:
            held.append(text)
            if in_link:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "svg" and not m["end"]:
            past = _after_svg(page, m.start())
            continue
        if tag == "a":
            in_link = not m["end"]
        elif tag == "br":
            held.append(" ")
        if tag not in _BLOCK:
            continue
        flush()
        in_link = False
        if m["end"]:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            continue
        if stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if tag in _CLOSES and any(opened[t] for t in _CLOSES[tag]):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _BARRIER[tag]:
                    break
                if stack[k][0] in _CLOSES[tag]:
                    close(k)
                    break
        if tag == "body":
            stack[:] = [s for s in stack if s[0] == "html"]
            opened.clear()
            opened["html"] = len(stack)
        if tag not in _VOID and not (m["attrs"] or "").rstrip().endswith("/"):
            names = [w.lower() for found in _NAMED.findall(m["attrs"] or "") for w in _PART.findall(" ".join(found))]
            stack.append((tag, (f"<{tag}", *names)))
            opened[tag] += 1
    flush()
    return out


def _bucket(token: str) -> int:
    return xxhash.xxh32_intdigest(token) % BUCKETS


class _Places(dict):
    """Word to its place in a vector of twice WORDS: one half counts up, the other down."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = xxhash.xxh32_intdigest(word)
        self[word] = place = h % WORDS + (WORDS if h & 0x80000000 else 0)
        return place


_PLACES = _Places()


def features(page: list[Block]) -> tuple[list[list[int]], np.ndarray]:
    """Hashed path tokens of every block, and its word vector and shapes."""
    paths, dense = [], np.zeros((len(page), WORDS + SHAPES))
    for k, block in enumerate(page):
        last = max((i for i, t in enumerate(block.path) if t[0] == "<"), default=0)
        paths.append(sorted({*map(_bucket, block.path), *(_bucket("$" + t) for t in block.path[last:])}))
        words = block.text.lower().split()
        counts = np.bincount(np.fromiter(map(_PLACES.__getitem__, words), dtype=np.int64, count=len(words)), minlength=2 * WORDS)
        vector = (counts[:WORDS] - counts[WORDS:]).astype(float)
        dense[k, :WORDS] = vector / (1 + np.sqrt(vector @ vector))
        n = len(block.text)
        dense[k, WORDS:] = (
            np.log1p(len(words)) / 4, block.linked / n, sum(block.text.count(c) for c in ".,!?;:") / max(1, len(words)),
            len(_DIGITS.findall(block.text)) / n, k / len(page), float(block.text[-1] in ".!?"))
    return paths, dense


@dataclass
class Network:
    """Weights by name: path embedding, one LSTM for each direction, output."""

    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        size = EMBED + WORDS + SHAPES
        w = {"path": rng.normal(0, 0.3, (BUCKETS, EMBED)), "out": rng.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)}
        for side in "fb":
            w[f"x{side}"] = rng.normal(0, size ** -0.5, (size, 4 * HIDDEN))
            w[f"h{side}"] = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
            w[f"c{side}"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])  # the forget gate starts open
        return Network(w)

    def inputs(self, paths: list[list[list[int]]], dense: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(time, page, input) and a mask of real blocks; pages are padded to the longest."""
        longest = max(map(len, paths))
        x = np.zeros((longest, len(paths), EMBED + WORDS + SHAPES))
        mask = np.zeros((longest, len(paths)))
        for b, (p, d) in enumerate(zip(paths, dense)):
            for t, tokens in enumerate(p):
                if tokens:
                    x[t, b, :EMBED] = self.w["path"][tokens].mean(axis=0)
            x[: len(p), b, EMBED:] = d
            mask[: len(p), b] = 1
        return x, mask

    def side(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        wh = self.w[f"h{side}"]
        gates = x @ self.w[f"x{side}"] + self.w[f"c{side}"]
        steps = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
        h, c = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        out, kept = np.zeros((*x.shape[:2], HIDDEN)), []
        for t in steps:
            z = gates[t] + h @ wh
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            f, i, o = s[:, :HIDDEN], s[:, HIDDEN: 2 * HIDDEN], s[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            before = (h, c)
            c2 = f * c + i * g
            tc = np.tanh(c2)
            h, c = m * o * tc + (1 - m) * h, m * c2 + (1 - m) * c
            out[t] = h
            kept.append((t, f, i, o, g, tc, m, before))
        return out, kept

    def label(self, paths: list[list[list[int]]], dense: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text of every block of every page."""
        if not paths:
            return []
        x, mask = self.inputs(paths, dense)
        h = np.concatenate([self.side(x, mask, s)[0] for s in "fb"], axis=2)
        p = 1 / (1 + np.exp(-np.clip(h @ self.w["out"] + self.w["bias"], -30, 30)))
        return [p[: len(own), b] for b, own in enumerate(paths)]

    def gradient(self, paths, dense, targets) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the batch's blocks, back through both directions."""
        x, mask = self.inputs(paths, dense)
        runs = {s: self.side(x, mask, s) for s in "fb"}
        h = np.concatenate([runs[s][0] for s in "fb"], axis=2)
        p = 1 / (1 + np.exp(-np.clip(h @ self.w["out"] + self.w["bias"], -30, 30)))
        y = np.zeros_like(p)
        for b, t in enumerate(targets):
            y[: len(t), b] = t
        d = (p - y) * mask / mask.sum()
        grad = {"out": np.einsum("tbh,tb->h", h, d), "bias": np.array([d.sum()])}
        dx = np.zeros_like(x)
        for k, s in enumerate("fb"):
            dh_all = d[:, :, None] * self.w["out"][k * HIDDEN: (k + 1) * HIDDEN]
            wh = self.w[f"h{s}"]
            gh = np.zeros_like(wh)
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN))
            dh, dc = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
            for t, f, i, o, g, tc, m, (h0, c0) in reversed(runs[s][1]):
                dh = dh + dh_all[t]
                dhm = dh * m
                dc2 = (dc * m) + dhm * o * (1 - tc ** 2)
                dz = np.concatenate([dc2 * c0 * f * (1 - f), dc2 * g * i * (1 - i), dhm * tc * o * (1 - o), dc2 * i * (1 - g ** 2)], axis=1)
                dz_all[t] = dz
                gh += h0.T @ dz
                dh, dc = dz @ wh.T + dh * (1 - m), dc2 * f + dc * (1 - m)
            grad[f"h{s}"], grad[f"c{s}"] = gh, dz_all.sum(axis=(0, 1))
            grad[f"x{s}"] = np.einsum("tbi,tbj->ij", x, dz_all, optimize=True)
            dx += dz_all @ self.w[f"x{s}"].T
        path = np.zeros_like(self.w["path"])
        for b, page in enumerate(paths):
            for t, tokens in enumerate(page):
                if tokens:
                    path[tokens] += dx[t, b, :EMBED] / len(tokens)
        grad["path"] = path
        return grad


#: What element and class names say about a block; the innermost that says something decides.
BOILERPLATE = ("head title nav menu navbar navigation breadcrumb breadcrumbs header masthead banner footer aside sidebar widget related ad ads advert advertisement sponsor "
               "sponsored promo cookie cookies consent notice alert popup modal subscribe newsletter signup form search login select option button label comment comments "
               "commentlist reply replies disqus respond share social copyright toolbar pagination pager tags").split()
MAIN = "article main content post entry story body text articlebody".split()
_SAYS = {**{w: 0 for w in BOILERPLATE}, **{w: 1 for w in MAIN}}


def named_label(path: tuple[str, ...]) -> int | None:
    """1 or 0 where the names in the path tell, else None. What stands in boilerplate stays boilerplate."""
    found = None
    for token in path:
        if token == "<body":
            continue
        says = _SAYS.get(token.lstrip("<"))
        if says is not None:
            found = says if found is None or says == 0 or found == 1 else found
    return found


def layouts(n: int, rng: np.random.Generator) -> list[tuple[list[Block], list[int]]]:
    """Written pages with the label of every block."""
    syllables = ["an", "er", "to", "mi", "la", "con", "ver", "sch", "tion", "ly", "qu", "ed", "in", "os", "re", "ph"]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def words(low: int, high: int) -> str:
        k = int(np.exp(rng.uniform(np.log(low), np.log(high + 1))))
        found = ["".join(pick(syllables) for _ in range(int(rng.integers(1, 5)))) for _ in range(max(1, k))]
        return " ".join(found).capitalize()

    def sentence(low: int, high: int) -> str:
        return words(low, high) + pick([".", ".", ".", "!", "?", ""])

    def element(kind: str, *names: str) -> tuple[str, ...]:
        return (f"<{kind}", *names)

    pages = []
    for _ in range(n):
        page: list[tuple[Block, int]] = []

        def add(path, text, label, link=0.0, page=page) -> None:
            page.append((Block(tuple(path), text, int(len(text) * link)), label))

        root = element("html")
        body = root + element("body") + (pick([(), element("div", "page"), element("div", "wrapper"), element("div", "container")]))

        def boiler(at, kind, add=add) -> None:
            if kind == "menu":
                box = pick([element("nav"), element("nav", "main", "menu"), element("div", "nav"), element("div", "menu"), element("div", "breadcrumbs"), element("header") + element("nav")])
                for _ in range(int(rng.integers(2, 9))):
                    add(at + box + pick([element("ul") + element("li"), (), element("ul", "menu") + element("li", "item")]), words(1, 3), 0, 1.0)
            elif kind == "header":
                box = pick([element("header"), element("header", "site", "header"), element("div", "header"), element("div", "masthead")])
                add(at + box + pick([element("h1"), element("div", "logo"), element("p")]), words(1, 6), 0, pick([0.0, 1.0]))
                if rng.random() < 0.5:
                    add(at + box + element("p"), sentence(3, 12), 0)
            elif kind == "footer":
                box = pick([element("footer"), element("div", "footer"), element("div", "copyright"), element("footer", "site")])
                for _ in range(int(rng.integers(1, 4))):
                    add(at + box + pick([(), element("p"), element("ul") + element("li")]), pick(["© ", ""]) + sentence(2, 25), 0, pick([0.0, 0.0, 1.0]))
            elif kind == "side":
                box = pick([element("aside"), element("div", "sidebar"), element("div", "widget"), element("div", "related"), element("section", "related", "posts")])
                for _ in range(int(rng.integers(1, 6))):
                    add(at + box + pick([element("p"), element("ul") + element("li"), element("h3"), element("div")]), sentence(2, 30), 0, pick([0.0, 1.0]))
            elif kind == "ad":
                box = pick([element("div", "ad"), element("div", "ads"), element("div", "advert"), element("div", "sponsored"), element("div", "promo"), element("div", "banner"), element("aside", "ad")])
                add(at + box + pick([(), element("p")]), sentence(3, 40), 0, pick([0.0, 0.5]))
            elif kind == "notice":
                box = pick([element("div", "cookie", "notice"), element("div", "cookie"), element("div", "consent"), element("div", "notice"), element("div", "alert"), element("div", "newsletter"), element("div", "popup"), element("section", "notice")])
                add(at + box + pick([(), element("p")]), sentence(5, 40), 0)
            elif kind == "form":
                box = element("form") + pick([(), element("fieldset"), element("div", "search"), element("p")])
                for _ in range(int(rng.integers(1, 4))):
                    add(at + box, words(1, 12), 0)
            elif kind == "comments":
                box = pick([element("section", "comments"), element("div", "comments"), element("div", "comments") + element("div", "comment"), element("ol", "commentlist") + element("li", "comment"), element("ul", "comments") + element("li"), element("section", "comments") + element("article", "comment")])
                for _ in range(int(rng.integers(1, 7))):
                    add(at + box + pick([element("p"), (), element("div", "comment", "body") + element("p")]), sentence(2, 50), 0)
            elif kind == "share":
                add(at + pick([element("div", "share"), element("ul", "social") + element("li"), element("div", "tags")]), words(1, 6), 0, 1.0)

        if rng.random() < 0.9:
            add(root + element("head") + element("title"), words(2, 12), 0)
        for kind in ("notice", "header", "menu", "ad", "side", "form"):
            if rng.random() < {"menu": 0.8, "header": 0.5}.get(kind, 0.3):
                boiler(body, kind)
        main = pick([element("article"), element("article"), element("main"), element("main") + element("article"), element("div", "content"), element("div", "post"), element("div", "entry", "content"), element("section", "story"), element("div", "article", "body"), element("div"), element("div", "main"), element("td")])
        if rng.random() < 0.8:
            add(body + main + element(pick(["h1", "h1", "h2"])), words(2, 14), 1)
        count = int(np.exp(rng.uniform(0, 3.2)))
        for k in range(count):
            add(body + main + pick([element("p")] * 8 + [element("h2"), element("ul") + element("li"), element("blockquote"), element("blockquote") + element("p"), element("pre"), element("table") + element("tr") + element("td"), element("div"), ()]), sentence(1, 120), 1, pick([0.0] * 6 + [0.2]))
            if rng.random() < 0.04:
                boiler(body + main, pick(["ad", "side", "notice", "form", "share"]))
        for kind in ("share", "comments"):
            if rng.random() < 0.35:
                boiler(body + main, kind)
        for kind in ("comments", "side", "ad", "form", "menu", "notice"):
            if rng.random() < 0.3:
                boiler(body, kind)
        if rng.random() < 0.85:
            boiler(body, "footer")
        pages.append(([b for b, _ in page], [y for _, y in page]))
    return pages


def train(pages: list[str], seed: int = SEED) -> Network:
    """Fit the network on written layouts and on the given pages (see the module's text); the same input gives the same weights."""
    rng = np.random.default_rng(seed)
    examples = layouts(LAYOUTS, rng)
    for page in pages:
        found = blocks(page)
        labels = [named_label(b.path) for b in found]
        if None not in labels and 1 in labels:
            examples.append((found, labels))
    rows = []
    for found, labels in examples:
        paths, dense = features(found)
        rows.append((paths, dense, np.array(labels, dtype=float)))
    net = Network.fresh(rng)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step, batch = 0, 32
    total = EPOCHS * -(-len(rows) // batch)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            paths, dense, targets = [], [], []
            for k in order[at: at + batch]:
                p, d, y = rows[k]
                start = int(rng.integers(max(1, len(p) - TRAIN_BLOCKS + 1)))
                part = slice(start, start + TRAIN_BLOCKS)
                drop = rng.random() * 0.3
                paths.append([[t for t in own if rng.random() >= drop] for own in p[part]])
                dense.append(d[part])
                targets.append(y[part])
            step += 1
            rate = RATE * min(1.0, 1.5 * (1 - step / (total + 1)) + 0.05)
            for k, g in net.gradient(paths, dense, targets).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.w[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return net


def texts(pages: list[str], net: Network, threshold: float = 0.5) -> list[str]:
    """Main text of every page: the blocks labelled main, one per line."""
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = [k for k in sorted(range(len(pages)), key=lambda k: len(found[k])) if found[k]]
    at = 0
    while at < len(order):
        # Pages of like length together; a very long page alone.
        size = max(1, min(64, 20_000 // len(found[order[min(at + 63, len(order) - 1)]])))
        some = order[at: at + size]
        at += size
        made = [features(found[k]) for k in some]
        for k, p in zip(some, net.label([m[0] for m in made], [m[1] for m in made])):
            out[k] = "\n".join(b.text for b, v in zip(found[k], p) if v >= threshold)
    return out


def learn(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Network:
    """Train on about ``sample`` pages of the table, none of 200,000 characters or more; the network's size does not depend on it."""
    usable = pages.select("page_id", "html").filter("page_id is not null and html is not null and length(html) < 200000")
    total = usable.count()
    if total > sample:
        usable = usable.filter(F.pmod(F.xxhash64("page_id", F.lit(3)), F.lit(1 << 30)) < int((1 << 30) * sample / total))
    drawn = sorted((r["page_id"], r["html"]) for r in usable.select("page_id", "html").collect())
    return train([h for _, h in drawn])


def extract(pages: DataFrame, net: Network) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``, from the whole html.

    Null or blank pages have an empty text; ``noscript`` and ``template``, which no reader
    sees, count as scripts. Long pages are read in one forward pass. Null ids and urls
    stay null, repeated rows each give a row. Only ``page_id``, ``url`` and ``html`` are read, so further
    columns may have any name. An empty table gives no row. ``n_chars`` counts code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = texts([h or "" for h in part.column("html").to_pylist()], net)
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
