"""Main text of web pages: a bidirectional LSTM labels every block of text with its whole document as context."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches

#: Buckets of hashed path tokens and of hashed words, and plain numbers, that describe a block.
PATHS, WORDS, PLAIN = 256, 64, 5
#: Cells of each direction.
HIDDEN = 16
#: Pages made up for training, pages sampled from the table beside them, and most characters of one of those.
MADE_PAGES, SAMPLE_PAGES, SAMPLE_CHARS = 400, 100, 20_000
EPOCHS, RATE = 40, 0.01
#: Blocks that are labelled at a time.
CELLS = 1 << 14

#: Elements that end the block before them and begin another.
_BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
_RAW = r"script|style|template|noscript|textarea|title|svg|iframe|object"
#: Attributes; where a quote stays open, all up to the next end of a tag.  A drawing that closes itself has no content.
_ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_TOKEN = re.compile(rf"(?is)<!--.*?(?:-->|$)|<svg\b{_ATTRIBUTES}/>|<({_RAW})\b{_ATTRIBUTES}>.*?(?:</\1\s*>|$)|<(/?)([a-z][a-z0-9:-]*)({_ATTRIBUTES}|[^>]*)>|<[!?][^>]*>|([^<]+|<)")
_NAMES = re.compile(r"""(?is)\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"\s+")
#: An element of the key closes open ones of its values.
_CLOSES = {"p": ("p",), "li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
_CLOSE_P = _BLOCKS - {"p", "body", "html", "li", "td", "th", "tr", "option", "button"}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int = 0


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """The element's tag, and the parts of its class, id and role, each also by its first four letters."""
    out = [tag]
    for m in _NAMES.finditer(attributes) if "=" in attributes else ():
        for part in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", m[1] or m[2] or m[3] or "").lower()):
            if part:
                out += ("." + part, "." + part[:4])
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """The page's runs of text between block elements, in order, with the names of the elements around them.

    Comments and the content of scripts, styles, titles and the like are no text.  Missing end tags are put up with.
    """
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked = anchors = 0

    def flush() -> None:
        nonlocal linked
        if text:
            own = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if own:
                found.append(Block(own, tuple(x for _, names in stack for x in names), linked))
            text.clear()
        linked = 0

    for m in _TOKEN.finditer(page):
        if m[5] is not None:
            text.append(m[5])
            linked += len(m[5]) if anchors else 0
        elif m[3] is None:
            text.append("" if m[1] is None else " ")
        else:
            tag = m[3].lower()
            if tag in _BLOCKS:
                flush()
            elif tag == "br":
                text.append(" ")
            if m[2]:
                places = [i for i, (t, _) in enumerate(stack) if t == tag]
                if places:
                    del stack[places[-1] :]
                    anchors = sum(t == "a" for t, _ in stack)
            elif tag not in _VOID and not m[4].endswith("/"):
                closes = _CLOSES.get(tag, ("p",) if tag in _CLOSE_P else ())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in closes:
                        del stack[i:]
                        break
                    if stack[i][0] in _BLOCKS and stack[i][0] not in closes:
                        break
                stack.append((tag, _names(tag, m[4])))
                anchors = sum(t == "a" for t, _ in stack)
    flush()
    return found


_bucket: dict[str, int] = {}


def _path_row(path: tuple[str, ...], known: dict[tuple[str, ...], np.ndarray] = {}) -> np.ndarray:  # noqa: B006  a cache
    if path not in known:
        if len(known) > 50_000:
            known.clear()
        row = np.zeros(PATHS, dtype=np.float32)
        for name in path:
            if name not in _bucket:
                _bucket[name] = zlib.crc32(name.encode()) % PATHS
            row[_bucket[name]] = 1
        known[path] = row
    return known[path]


def features(pages: list[list[Block]]) -> np.ndarray:
    """A row for each block of all pages: hashed path, hashed words, and length, links, end mark and place in its page."""
    own = [b for page in pages for b in page]
    x = np.zeros((len(own), PATHS + WORDS + PLAIN), dtype=np.float32)
    if not own:
        return x
    x[:, :PATHS] = [_path_row(b.path) for b in own]
    for w in tokens.words(pa.array([b.text for b in own], pa.string()), tokens.ALNUM):
        rows = w.rows + w.first
        cells = rows * WORDS + (w.hashes >> np.uint64(58)).astype(np.int64)
        x[:, PATHS : PATHS + WORDS] += np.bincount(cells, minlength=len(own) * WORDS).reshape(len(own), WORDS)
    x[:, PATHS : PATHS + WORDS] /= 1 + x[:, PATHS : PATHS + WORDS].sum(axis=1, keepdims=True)
    size = np.array([len(b.text) for b in own])
    x[:, -5] = np.log1p(size) / 8
    x[:, -4] = np.minimum([b.linked for b in own] / np.maximum(size, 1), 1)
    x[:, -3] = [b.text[-1] in ".!?:;…\"”" for b in own]
    x[:, -2] = np.concatenate([np.linspace(0, 1, len(p)) for p in pages if p])
    x[:, -1] = 1
    return x


@dataclass
class Network:
    """For either direction input weights, recurrent weights and biases of the four gates; output weights and bias."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    offset: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.float32))

    def parts(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, *self.biases, self.out, self.offset]


def new_network(size: int = PATHS + WORDS + PLAIN, hidden: int = HIDDEN) -> Network:
    draw = np.random.default_rng(11)
    part = lambda *shape, s: (draw.normal(0, s, shape)).astype(np.float32)
    bias = np.zeros(4 * hidden, dtype=np.float32)
    bias[hidden : 2 * hidden] = 1
    return Network([part(size, 4 * hidden, s=0.1) for _ in "lr"], [part(hidden, 4 * hidden, s=0.2) for _ in "lr"], [bias.copy() for _ in "lr"], part(2 * hidden, s=0.2))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(net: Network, d: int, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states, pages x blocks x cells, of one direction; masked blocks leave the state as it is."""
    n, longest, _ = x.shape
    size = net.recurrent[d].shape[0]
    drive = x @ net.inputs[d] + net.biases[d]
    h = c = np.zeros((n, size), dtype=np.float32)
    states = np.zeros((n, longest, size), dtype=np.float32)
    for t in range(longest) if d == 0 else range(longest - 1, -1, -1):
        g = drive[:, t] + h @ net.recurrent[d]
        i, f, o, u = _sigmoid(g[:, :size]), _sigmoid(g[:, size : 2 * size]), _sigmoid(g[:, 2 * size : 3 * size]), np.tanh(g[:, 3 * size :])
        on = mask[:, t, None]
        was_h, was_c = h, c
        c = np.where(on, f * c + i * u, c)
        h = np.where(on, o * np.tanh(c), h)
        states[:, t] = h
        if keep is not None:
            keep.append((t, i, f, o, u, was_h, was_c, c, on))
    return states


def probabilities(net: Network, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    both = np.concatenate([_run(net, d, x, mask) for d in (0, 1)], axis=2)
    return _sigmoid(both @ net.out + net.offset)


def _gradients(net: Network, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy over all blocks, by backpropagation through either direction's steps."""
    size = net.recurrent[0].shape[0]
    kept: list[list] = [[], []]
    both = np.concatenate([_run(net, d, x, mask, kept[d]) for d in (0, 1)], axis=2)
    error = np.where(mask, _sigmoid(both @ net.out + net.offset) - y, 0) / mask.sum()
    inputs, recurrent, biases = [], [], []
    for d in (0, 1):
        dx, dr, db = np.zeros_like(net.inputs[d]), np.zeros_like(net.recurrent[d]), np.zeros_like(net.biases[d])
        dh = dc = np.zeros((len(x), size), dtype=np.float32)
        for t, i, f, o, u, was_h, was_c, c, on in reversed(kept[d]):
            dh = dh + error[:, t, None] * net.out[d * size : (d + 1) * size]
            th = np.tanh(c)
            now = np.where(on, dc + dh * o * (1 - th * th), 0)
            g = np.where(on, np.concatenate([now * u * i * (1 - i), now * was_c * f * (1 - f), dh * th * o * (1 - o), now * i * (1 - u * u)], axis=1), 0)
            dx += x[:, t].T @ g
            dr += was_h.T @ g
            db += g.sum(axis=0)
            dc = np.where(on, now * f, dc)
            dh = np.where(on, g @ net.recurrent[d].T, dh)
        inputs.append(dx)
        recurrent.append(dr)
        biases.append(db)
    return [*inputs, *recurrent, *biases, np.einsum("ntk,nt->k", both, error), error.sum(keepdims=True).reshape(1)]


def _padded(pages: list[list[Block]]):
    """(page numbers, features, mask) of pages of like length."""
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    first = 0
    while first < len(order):
        last = first + 1
        while last < len(order) and (last + 1 - first) * len(pages[order[last]]) <= CELLS:
            last += 1
        own = [pages[i] for i in order[first:last]]
        flat, longest = features(own), len(own[-1])
        x, mask = np.zeros((len(own), longest, flat.shape[1]), dtype=np.float32), np.zeros((len(own), longest), dtype=bool)
        for k, p in enumerate(own):
            mask[k, : len(p)] = True
        x[mask] = flat
        yield order[first:last], x, mask
        first = last


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS) -> Network:
    """Adam over minibatches of labelled pages; the same pages give the same network."""
    net, draw = new_network(), np.random.default_rng(5)
    one, two, step = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()], 0
    for _ in range(epochs):
        order = draw.permutation(len(pages))
        for k in range(0, len(order), 50):
            own = [pages[i] for i in order[k : k + 50]]
            for rows, x, mask in _padded([b for b, _ in own]):
                y = np.zeros(mask.shape, dtype=np.float32)
                y[mask] = np.concatenate([own[r][1] for r in rows])
                step += 1
                for p, m, v, g in zip(net.parts(), one, two, _gradients(net, x, mask, y)):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return net


#: Private characters around the main parts of a made page.
_OPEN, _CLOSE = "\ue000", "\ue001"
#: Names that page authors give to what is no main text, and to what is.
BOILERPLATE = (
    "ad ads advert advertisement banner sponsor sponsored promo promotion cookie cookies consent notice alert gdpr sidebar side widget related recommended menu navigation navbar nav "
    "breadcrumb breadcrumbs topbar masthead header footer copyright comment comments respond discussion disqus reply share social newsletter subscribe signup login search popup modal pagination tags"
).split()
MAIN = "content article post entry story main body text page".split()
_PAGE_WORDS = "the of and to in that is was for on with as at by from it an be this have der die und das von zu ein le la les des et un que los las el una por con".split()


def made_pages(n: int = MADE_PAGES) -> list[tuple[list[Block], list[int]]]:
    """Pages put together by rule from the names above and random words, each block with its label."""
    draw = np.random.default_rng(3)
    pick = lambda xs: xs[int(draw.integers(len(xs)))]

    def words(least: int, most: int, stop: bool) -> str:
        own = [pick(_PAGE_WORDS) if draw.random() < 0.4 else "".join(chr(97 + int(c)) for c in draw.integers(0, 26, int(draw.integers(2, 10)))) for _ in range(int(draw.integers(least, most)))]
        return " ".join(own).capitalize() + ("." if stop else "")

    def element(tag: str, inner: str, name: str | None) -> str:
        style = draw.random()
        return f"<{tag}{'' if not name else f' class={chr(34)}{name}{chr(34)}' if style < 0.7 else f' id={chr(34)}{name}{chr(34)}'}>{inner}</{tag}>"

    def named(names: list[str]) -> str:
        own = pick(names)
        return own if draw.random() < 0.6 else f"{own}-{pick(['box', 'wrap', 'list', 'area', 'inner', 'top', 'left'])}"

    def aside() -> str:
        kind = draw.random()
        if kind < 0.4:
            items = [f'<a href="/{k}">{words(1, 4, False)}</a>' for k in range(int(draw.integers(2, 8)))]
            inner = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if draw.random() < 0.7 else " ".join(items)
        elif kind < 0.7:
            inner = "".join(f"<p>{words(3, 40, True)}</p>" for _ in range(int(draw.integers(1, 4))))
        elif kind < 0.85:
            inner = words(2, 25, bool(draw.random() < 0.6))
        else:
            inner = f"<div>{words(1, 3, False)}</div><p>{words(3, 30, True)}</p><button>{words(1, 2, False)}</button>"
        tag = pick(["nav", "header", "footer", "aside", "form"]) if draw.random() < 0.45 else pick(["div", "section", "ul", "p"])
        return element(tag, inner, named(BOILERPLATE) if tag in ("div", "section", "ul", "p") or draw.random() < 0.3 else None)

    pages = []
    for _ in range(n):
        inner = [f"<h1>{words(2, 10, False)}</h1>"] if draw.random() < 0.9 else []
        for _ in range(int(draw.integers(1, 9))):
            kind = draw.random()
            if kind < 0.7:
                link = f' <a href="/x">{words(1, 4, False)}</a> {words(2, 6, True)}' if draw.random() < 0.2 else ""
                inner.append(f"<p>{words(2, 60, True)}{link}</p>" if draw.random() < 0.8 else f"<p><b>{words(3, 40, True)}<br>")
            elif kind < 0.8:
                inner.append(f"<h2>{words(1, 6, False)}</h2>")
            elif kind < 0.9:
                inner.append("<ul>" + "".join(f"<li>{words(2, 12, bool(draw.random() < 0.5))}</li>" for _ in range(int(draw.integers(2, 5)))) + "</ul>")
            else:
                inner.append(f"<blockquote>{words(5, 30, True)}</blockquote>")
        marked = [f"{_OPEN}{x}{_CLOSE}" for x in inner]
        for _ in range(int(draw.integers(0, 2))):
            marked.insert(int(draw.integers(1, len(marked) + 1)), aside())
        tag = pick(["article", "main", "div", "section"])
        body = element(tag, "".join(marked), named(MAIN) if tag in ("div", "section") or draw.random() < 0.3 else None)
        outer = [aside() for _ in range(int(draw.integers(1, 5)))] + [body] + [aside() for _ in range(int(draw.integers(1, 5)))]
        page = "".join(outer)
        if draw.random() < 0.4:
            page = element("div", page, pick(["wrapper", "container", "site", "page", "layout"]))
        pages.append(_labelled(f"<html><head><title>x</title></head><body>{page}</body></html>"))
    return pages


def _labelled(page: str) -> tuple[list[Block], list[int]]:
    """Blocks of a made page whose main parts stand between two private characters, which go."""
    own, y, inside = [], [], False
    for b in blocks(page):
        inside = inside or _OPEN in b.text
        label = int(inside)
        if _CLOSE in b.text and b.text.rfind(_CLOSE) > b.text.rfind(_OPEN):
            inside = False
        text = b.text.replace(_OPEN, "").replace(_CLOSE, "").strip()
        if text:
            own.append(Block(text, b.path, b.linked))
            y.append(label)
    return own, y


def _supposed(page: list[Block]) -> list[int] | None:
    """Labels of a sampled page that marks its article as such; none where it doesn't."""
    if not any("article" in b.path or "main" in b.path for b in page):
        return None
    no = {"nav", "footer", "aside", "form", *("." + x for x in BOILERPLATE)}
    return [int(("article" in b.path or "main" in b.path) and not no & set(b.path)) for b in page]


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Network:
    """The network, from made pages and a bounded sample of `pages` that mark their article with an element of its own."""
    own = pages.select("html").where(F.col("html").isNotNull() & (F.length("html") <= SAMPLE_CHARS)).orderBy(F.xxhash64("html"), "html").limit(sample)
    taught = made_pages()
    for r in own.collect():
        page = blocks(r.html)
        if page and (y := _supposed(page)):
            taught.append((page, y))
    return train(taught)


def main_text(net: Network, pages: list[str | None]) -> list[str]:
    found = [blocks(p or "") for p in pages]
    out = [""] * len(pages)
    for rows, x, mask in _padded(found):
        p = probabilities(net, x, mask)
        for k, row in enumerate(rows):
            out[row] = " ".join(b.text for b, q in zip(found[row], p[k]) if q >= 0.5)
    return out


def extract(pages: DataFrame, net: Network) -> DataFrame:
    """`pages` with the main text of each whole html in `text`, and its length in code points in `n_chars`.

    Null and empty pages, and pages without text, give an empty text, and no pages no rows.  Pages are labelled one by
    one, so repeated rows and other columns don't matter; columns of those names are replaced.  A page is read whole
    whatever its length; its blocks' features, some 1300 bytes a block, are held at once.  Broken markup is put up with:
    an open quote ends with the tag, missing end tags are supplied, and an open script goes to the page's end.
    """
    arrow_batches(pages.sparkSession, 500)
    shared = pages.sparkSession.sparkContext.broadcast(net)
    own = pages.drop("text", "n_chars")

    def run(batches):
        for batch in batches:
            texts = main_text(shared.value, batch.column("html").to_pylist())
            added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "text", "n_chars"])

    return own.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in own.schema)}, text string, n_chars long")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages`."""
    return extract(pages.select("page_id", "url", "html"), fit(pages)).select("page_id", "url", "text", "n_chars")
