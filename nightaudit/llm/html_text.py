"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read by the standard library's HTML parser into leaf blocks: stretches of text that no block element divides,
in page order, with character references decoded and white space turned into single spaces. Scripts, styles, templates,
comments and the head give no block. A block's features are its ancestor tags, the words of its ancestors' class, id and
role names, and its text (length, share of links, final stop, signs of boilerplate). The field has two labels, main text
or not; its weights are trained by maximum likelihood (forward-backward in numpy, all training pages side by side) on
labelled pages, and Viterbi decoding takes the best sequence for a page. The main blocks, joined by line feeds, are the
page's text; nothing is dropped or capped beside the blocks labelled otherwise.

Training pages carry ``data-main`` on elements of the main text; :mod:`html_pages` draws a fixed set of varied layouts,
and :func:`train` takes any others. Training is a fixed cost on the driver; pages are labelled where they are read, one
at a time, without a shuffle.

Defined results: a null or empty html, or one without main text, gives an empty text; malformed markup is read as the
parser takes it, with implied end tags; repeated rows are extracted row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.llm.common import table
from nightaudit.llm.html_pages import labelled_pages

#: Elements of HTML by their role for blocks.
BLOCK_TAGS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
                       "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre "
                       "search section select summary table tbody td textarea tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What may stand in a head; any other start tag, and text, ends an open head.
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
SILENT_TAGS = frozenset("script style template noscript head title svg iframe".split())
BOX_TAGS = frozenset("article main section nav aside header footer form div".split())
#: Stands around main text without an element of its own on drawn pages.
MARK_TAG = "x-main"
#: An open element of these ends where one of the group begins, unless a container of the group stands between.
IMPLIED_END = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
               "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
               "option": ({"option"}, {"select"})}

_NAME_PARTS = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("text", "features", "main")

    def __init__(self, text: str, features: tuple[str, ...], main: bool):
        self.text, self.features, self.main = text, features, main


class _Frame:
    """What the open elements from the root to one of them say about a block in it. Made from the frame above in the time
    that the element's own names take; nothing is copied where an element adds nothing."""
    __slots__ = ("said", "leaf", "box", "inner", "linked", "main", "features")

    def __init__(self, above: _Frame | None, tag: str, names: tuple[str, ...], main: bool, known: frozenset | None):
        new = [f"in:{tag}"] if tag not in ("html", "body", MARK_TAG, "") else []
        new += [f"name:{w}" for w in names if len(w) > 1]
        said = above.said if above else frozenset()
        new = {f for f in new if f not in said and (known is None or f in known)}
        self.said = said | new if new else said
        self.leaf = tag if tag in BLOCK_TAGS else above.leaf if above else ""
        self.box = tag if tag in BOX_TAGS else above.box if above else ""
        self.inner = names[0] if names else above.inner if above else None
        self.linked = tag == "a" or bool(above and above.linked)
        self.main = main or bool(above and above.main)
        self.features: tuple[str, ...] | None = None

    def own_features(self) -> tuple[str, ...]:
        if self.features is None:
            out = {*self.said, f"leaf:{self.leaf}", f"box:{self.box}"}
            if self.inner:
                out.add(f"inner:{self.inner}")
            self.features = tuple(sorted(out))
        return self.features


class _Blocks(HTMLParser):
    """Collects leaf blocks. The stack holds (tag, frame, silent) of the open elements. ``known``: the features that a
    trained field has; names that it does not know are not kept."""

    def __init__(self, known: frozenset | None = None):
        super().__init__(convert_charrefs=True)
        self.known = known
        self.root = _Frame(None, "", (), False, known)
        self.stack: list[tuple] = []
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []
        self.silent = 0
        self.above: _Frame | None = None

    def _frame(self) -> _Frame:
        return self.stack[-1][1] if self.stack else self.root

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            frame = self.above or self.root
            self.blocks.append(Block(text, frame.own_features() + _text_features(text, self.linked), frame.main))
        self.parts, self.linked, self.above = [], 0, None

    def _pop(self, n: int) -> None:
        for tag, _, silent in self.stack[n:]:
            self.silent -= silent
            self.open[tag] -= 1
        del self.stack[n:]

    def _end_head(self) -> None:
        """Ends a head that stands open, unless one of its own elements (title, noscript, ...) is open in it."""
        inner = next((n for n in range(len(self.stack) - 1, -1, -1) if self.stack[n][2]), None)
        if inner is not None and self.stack[inner][0] == "head":
            self._pop(inner)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent and tag not in HEAD_TAGS:
            self._end_head()
        block = tag in BLOCK_TAGS
        if block:
            self._end_block()
            self._imply(tag)
        if tag in VOID_TAGS:
            if tag == "br":
                self.parts.append(" ")
            return
        names, main = (), False
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += tuple(_NAME_PARTS.findall(value.lower()))
            elif key == "data-main":
                main = True
        silent = tag in SILENT_TAGS
        self.silent += silent
        self.open[tag] = self.open.get(tag, 0) + 1
        self.stack.append((tag, _Frame(self._frame(), tag, names, main, self.known), silent))

    def _imply(self, tag: str) -> None:
        for n in range(len(self.stack) - 1, -1, -1):  # a block element ends an open paragraph
            open_ = self.stack[n][0]
            if open_ == "p":
                self._pop(n)
                break
            if open_ in BLOCK_TAGS:
                break
        if tag in IMPLIED_END:
            ends, walls = IMPLIED_END[tag]
            for n in range(len(self.stack) - 1, -1, -1):
                if self.stack[n][0] in ends:
                    self._pop(n)
                    if tag != "tr":
                        break
                elif self.stack[n][0] in walls:
                    break
        if self.silent and tag == "body":
            self._pop(next((n for n, e in enumerate(self.stack) if e[2]), len(self.stack)))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag in ("svg", "math", "script", "style", "iframe", "object", "canvas", "audio", "video"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self._end_block()
        if not self.open.get(tag):
            return
        for n in range(len(self.stack) - 1, -1, -1):
            if self.stack[n][0] == tag:
                self._pop(n)
                break

    def handle_data(self, data: str) -> None:
        if self.silent and not data.isspace():
            self._end_head()
        if self.silent:
            return
        if self.above is None and not data.isspace():
            self.above = self._frame()
        self.parts.append(data)
        if self._frame().linked:
            self.linked += len(data)


def _text_features(text: str, linked: int) -> tuple[str, ...]:
    out = [f"len:{min(int(np.log2(len(text) + 1)), 9)}", f"link:{min(4, int(4 * linked / len(text) + 0.5))}"]
    if text[-1] in ".!?\"'»”…":
        out.append("stop")
    if "©" in text:
        out.append("copyright")
    return tuple(out)


def blocks_of(html: str | None, known: frozenset | None = None) -> list[Block]:
    reader = _Blocks(known)
    reader.feed(html or "")
    reader.close()
    reader._end_block()
    return reader.blocks


class Crf:
    """Two labels (0 other, 1 main), binary features, weights for each label, transitions and first labels."""

    def __init__(self, features: dict[str, int]):
        self.features, self.known = features, frozenset(features)
        n = len(features)
        self.params = {"emit": np.zeros((n, 2)), "move": np.zeros((2, 2)), "first": np.zeros(2)}

    def _indices(self, block: Block) -> list[int]:
        return [i for i in map(self.features.get, block.features) if i is not None]

    def fit(self, pages: list[list[Block]], steps: int = 200, l2: float = 2e-4) -> "Crf":
        pages = [p for p in pages if p]
        n, longest = len(pages), max(map(len, pages), default=0)
        if not n:
            return self
        total = sum(map(len, pages))
        x = np.zeros((total, len(self.features)))
        y = np.zeros((n, longest), int)
        real = np.zeros((n, longest), bool)
        row = 0
        for k, page in enumerate(pages):
            for t, b in enumerate(page):
                x[row, self._indices(b)] = 1
                y[k, t], real[k, t] = int(b.main), True
                row += 1
        gold = np.eye(2)[y] * real[:, :, None]
        gold_moves = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v = {k: np.zeros_like(a) for k, a in self.params.items()}
        for step in range(1, steps + 1):
            p = self.params
            score = np.zeros((n, longest, 2))
            score[real] = x @ p["emit"]
            alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            alpha[:, 0] = p["first"] + score[:, 0]
            for t in range(1, longest):
                alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + p["move"], axis=1) + score[:, t]
                alpha[:, t] = np.where(real[:, t, None], alpha[:, t], alpha[:, t - 1])
            for t in range(longest - 2, -1, -1):
                back = np.logaddexp.reduce(p["move"] + (score[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
                beta[:, t] = np.where(real[:, t + 1, None], back, 0)
            z = np.logaddexp.reduce(alpha[:, -1], axis=1)
            at = np.exp(alpha + beta - z[:, None, None]) * real[:, :, None]
            pair = np.exp(alpha[:, :-1, :, None] + p["move"] + (score + beta)[:, 1:, None, :] - z[:, None, None, None])
            moves = (pair * real[:, 1:, None, None]).sum(axis=(0, 1))
            g = {"emit": x.T @ (at - gold)[real] / total + l2 * p["emit"], "move": (moves - gold_moves) / total,
                 "first": (at[:, 0] - gold[:, 0]).sum(axis=0) / total}
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                p[k] = p[k] - 0.1 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def decode(self, page: list[Block]) -> list[int]:
        """The best label sequence (Viterbi)."""
        emit, move = self.params["emit"], self.params["move"].tolist()
        back, best = [], self.params["first"].tolist()
        for t, b in enumerate(page):
            idx = self._indices(b)
            s0, s1 = emit[idx].sum(axis=0).tolist() if idx else (0.0, 0.0)
            if t:
                from0 = (best[0] + move[0][0], best[1] + move[1][0])
                from1 = (best[0] + move[0][1], best[1] + move[1][1])
                back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
                best = [max(from0) + s0, max(from1) + s1]
            else:
                best = [best[0] + s0, best[1] + s1]
        if not page:
            return []
        labels = [int(best[1] > best[0])]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def train(pages: list[str] | None = None) -> Crf:
    """A field trained on labelled pages (those of :mod:`html_pages` by default); features that occur once are left
    out."""
    read = [blocks_of(h) for h in (labelled_pages() if pages is None else pages)]
    count: dict[str, int] = {}
    for page in read:
        for b in page:
            for f in b.features:
                count[f] = count.get(f, 0) + 1
    return Crf({f: i for i, f in enumerate(sorted(f for f, n in count.items() if n > 1))}).fit(read)


def main_text(crf: Crf, html: str | None) -> str:
    page = blocks_of(html, crf.known)
    return "\n".join(b.text for b, main in zip(page, crf.decode(page)) if main)


def _extracted(batches: Iterator[pa.RecordBatch], crf: Crf) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            b = whole.slice(at, 200)
            texts = [main_text(crf, h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, crf: Crf | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    crf = crf or train()
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(
        lambda it: _extracted(it, crf), "page_id long, url string, text string, n_chars long")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op6_html_extraction": op6_html_extraction}
