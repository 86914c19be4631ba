"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks in page order. For each block, a vector is read from its tag path (tags, class and id words, roles),
from its words, both hashed, and from a few counts. A bidirectional LSTM reads the vectors of the whole page in
both directions, so a block is judged by all that stands around it, and labels every block as article or not.

The network is small and trained here: on the driver, from a bounded sample of pages (``SAMPLE_PAGES`` of at most
``SAMPLE_CHARS`` characters). Pages have no labels, so a teacher labels the sample by markup that says what it is (``article``,
``nav``, ``footer``, classes like ``ad`` or ``comments``). Each sample page is also shown with its layout varied: wrappers renamed
or taken away, and blocks of other kinds put in, with words of the sample. What the network then sees is not only the markup of
the pages at hand. Markup that no page shows (scripts, styles, heads, forms' controls) is dropped by rule.

Character references are decoded, white space in a block becomes one space, inline tags don't end a block. Null and empty pages have no
text. Broken markup is read as far as it goes. Repeated rows are read alike. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import hash_spans, map_batches, mix, prefix_sums, word_edges

SAMPLE_PAGES = 256
SAMPLE_CHARS = 40_000
PATH_SLOTS, WORD_SLOTS, COUNTS = 256, 64, 8
HIDDEN = 16

# Elements by what they do to text.
DROPPED = frozenset("script style head template noscript textarea select option button svg iframe object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr br math mi mn mo mrow msup msub mfrac msqrt mtext".split()
)
CLOSES_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
# Markup that says what a block is, as the teacher reads it.
OTHER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
OTHER_NAMES = tuple(
    "ad ads advert advertisement banner breadcrumb comment comments cookie consent disclaimer discussion footer login masthead menu modal nav "
    "navbar navigation newsletter notice pagination popup promo promoted related reply replies respond share sharing sidebar signup "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
MAIN_TAGS = frozenset(("article", "main"))
MAIN_NAMES = tuple("article content entry main post story body text".split())

_split_names = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Block:
    path: list[str]
    text: str
    linked: int = 0


class Blocks(HTMLParser):
    """Leaf blocks of a page: text between block-level tags, with the tags and names that stand around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str]]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.found: list[Block] = []

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            path = [name for tag, names in self.open if tag not in INLINE for name in names]
            self.found.append(Block(path, text, self.linked))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE:
            self.end_block()
            if any(t == "p" for t, _ in self.open):
                self.close("p", INLINE)
            if tag in CLOSES_ITSELF:
                self.close_any(CLOSES_ITSELF[tag])
        if tag in VOID:
            self.parts.append(" ")
            return
        names = [f"<{tag}>"]
        for key, value in attrs:
            if key in ("class", "id", "role", "itemprop") and value:
                names += [part.lower() for part in _split_names.findall(value)]
        self.open.append((tag, names))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def close(self, tag: str, through: frozenset[str]) -> bool:
        """Close the innermost ``tag`` if only elements of ``through`` stand inside it."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return True
            if self.open[i][0] not in through:
                return False
        return False

    def close_any(self, tags: set[str]) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                del self.open[i:]
                return
            if self.open[i][0] in ("ul", "ol", "dl", "table", "select"):
                return

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_block()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                # An inline end tag never closes a block element.
                if tag not in INLINE or all(t in INLINE for t, _ in self.open[i:]):
                    del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if not any(tag in DROPPED for tag, _ in self.open):
            self.parts.append(data)
            if any(tag == "a" for tag, _ in self.open):
                self.linked += len(data)


def blocks_of(html: str) -> list[Block]:
    parser = Blocks()
    parser.feed(html)
    HTMLParser.close(parser)
    parser.end_block()
    return parser.found


# Vectors


def _slot(token: str, size: int) -> int:
    return xxhash.xxh32_intdigest(token) % size


_slots: dict[str, int] = {}


def path_slot(name: str) -> int:
    if name not in _slots:
        if len(_slots) > 100_000:
            _slots.clear()
        _slots[name] = _slot(name, PATH_SLOTS)
    return _slots[name]


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed path, the share of its words in each hash slot, counts. All words of all blocks are hashed at once."""
    out = np.zeros((len(blocks), PATH_SLOTS + WORD_SLOTS + COUNTS), np.float32)
    if not blocks:
        return out
    ends = np.cumsum([len(b.text.lower().encode("utf-8", "surrogatepass")) + 1 for b in blocks])
    data, starts, stops = word_edges("\n".join(b.text for b in blocks))
    hashes = mix(hash_spans(prefix_sums(data), starts, stops) ^ (stops - starts).astype(np.uint64))
    owner = np.searchsorted(ends, starts, side="right")
    counts = np.bincount(owner, minlength=len(blocks))
    slots = (hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
    np.add.at(out, (owner, PATH_SLOTS + slots), (1 / counts[owner]).astype(np.float32))
    for i, block in enumerate(blocks):
        for name in block.path:
            out[i, path_slot(name)] = 1
        n = len(block.text)
        out[i, -COUNTS:] = (
            1, np.log1p(counts[i]) / 4, np.log1p(n) / 6, block.linked / n, block.text[-1] in ".!?:;…\"»”", block.text[0].isupper(),
            "©" in block.text or "|" in block.text, i / len(blocks),
        )
    return out


# Network


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Two LSTMs, one per direction, and a logistic output on both states and the block's own vector."""

    w: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, inputs: int, hidden: int = HIDDEN, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w[f"x{side}"] = rng.normal(0, 0.1, (inputs, 4 * hidden)).astype(np.float32)
            w[f"h{side}"] = rng.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1
            w[f"c{side}"] = bias
        w["o"] = rng.normal(0, 0.1, 2 * hidden + inputs).astype(np.float32)
        w["c"] = np.zeros(1, np.float32)
        return cls(w)

    def run(self, x: np.ndarray, live: np.ndarray, side: str) -> list[tuple]:
        """States of one direction; x is (steps, pages, inputs), a page's state moves only where ``live``."""
        hidden = self.w[f"h{side}"].shape[0]
        h = c = np.zeros((x.shape[1], hidden), np.float32)
        states = []
        drive = x @ self.w[f"x{side}"] + self.w[f"c{side}"]
        for t in range(len(x)):
            z = drive[t] + h @ self.w[f"h{side}"]
            i, f, o = (sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in range(3))
            g = np.tanh(z[:, 3 * hidden :])
            before_h, before_c = h, c
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            on = live[t][:, None]
            h, c = np.where(on, h, before_h), np.where(on, c, before_c)
            states.append((h, i, f, o, g, squashed, before_h, before_c, on))
        return states

    def logits(self, pages: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        steps = max(map(len, pages))
        inputs = len(self.w["o"]) - 2 * self.w["hf"].shape[0]
        x = np.zeros((steps, len(pages), inputs), np.float32)
        live = np.zeros((steps, len(pages)), bool)
        for k, page in enumerate(pages):
            x[: len(page), k], live[: len(page), k] = page, True
        ahead = self.run(x, live, "f")
        behind = self.run(x[::-1], live[::-1], "b")
        both = np.concatenate([np.stack([s[0] for s in ahead]), np.stack([s[0] for s in behind])[::-1], x], 2)
        return both @ self.w["o"] + self.w["c"], both, live, x, ahead, behind

    def gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, by back-propagation through both directions."""
        logits, both, live, x, ahead, behind = self.logits(pages)
        target = np.zeros(logits.shape, np.float32)
        for k, label in enumerate(labels):
            target[: len(label), k] = label
        error = np.where(live, sigmoid(logits) - target, 0) / max(1, live.sum())
        hidden = self.w["hf"].shape[0]
        out = {"o": np.einsum("tp,tpd->d", error, both), "c": error.sum(keepdims=True).ravel()}
        spread = error[:, :, None] * self.w["o"]
        for side, states, x_side, back in (("f", ahead, x, spread[:, :, :hidden]), ("b", behind, x[::-1], spread[::-1, :, hidden : 2 * hidden])):
            dh = dc = np.zeros((len(pages), hidden), np.float32)
            dz = np.zeros((len(states), len(pages), 4 * hidden), np.float32)
            for t in range(len(states) - 1, -1, -1):
                _, i, f, o, g, squashed, _, before_c, on = states[t]
                down = np.where(on, dh + back[t], 0)
                dcell = np.where(on, dc + down * o * (1 - squashed**2), 0)
                parts = (dcell * g * i * (1 - i), dcell * before_c * f * (1 - f), down * squashed * o * (1 - o), dcell * i * (1 - g**2))
                dz[t] = np.concatenate(parts, 1)
                dh = np.where(on, dz[t] @ self.w[f"h{side}"].T, dh)
                dc = np.where(on, dcell * f, dc)
            out[f"x{side}"] = np.einsum("tpi,tpz->iz", x_side, dz, optimize=True)
            out[f"h{side}"] = np.einsum("tph,tpz->hz", np.stack([s[6] for s in states]), dz, optimize=True)
            out[f"c{side}"] = dz.sum((0, 1))
        return out

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 10, rate: float = 0.01, seed: int = 3) -> Network:
        """Adam over batches of pages of like length."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        order, step = np.argsort([len(p) for p in pages], kind="stable"), 0
        batches = [order[i : i + 16] for i in range(0, len(order), 16)]
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                step += 1
                some = batches[k]
                for name, g in self.gradients([pages[i] for i in some], [labels[i] for i in some]).items():
                    g = g + 1e-5 * self.w[name]
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    pace = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.w[name] = self.w[name] - (pace * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray], most: int = 50_000) -> list[np.ndarray]:
        """True for blocks of the article; pages of like length run side by side, up to ``most`` blocks (or one page) at once."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
        while order:
            some = [order.pop()]
            while order and (len(some) + 1) * len(pages[some[0]]) <= most:
                some.append(order.pop())
            logits = self.logits([pages[i] for i in some])[0]
            for k, i in enumerate(some):
                out[i] = logits[: len(pages[i]), k] > 0
        return out


# Teacher and sample


def teacher(block: Block) -> bool:
    """What the markup around a block says: inner marks of other matter go before an outer mark of the article."""
    names = set(block.path)
    if any(f"<{t}>" in names for t in OTHER_TAGS) or names.intersection(OTHER_NAMES):
        return False
    main = any(f"<{t}>" in names for t in MAIN_TAGS) or bool(names.intersection(MAIN_NAMES))
    if "<header>" in names and not main:
        return False
    return main or (len(block.text.split()) >= 12 and block.linked < 0.3 * len(block.text))


def varied(blocks: list[Block], rng: np.random.Generator, words: list[str]) -> tuple[list[Block], list[bool]]:
    """The page with its layout varied, and labels: wrappers renamed, other matter put in."""
    labels = [teacher(b) for b in blocks]
    wrapper = [["<article>"], ["<main>"], ["<main>", "<article>"], ["<div>", str(rng.choice(MAIN_NAMES))], ["<div>", str(rng.choice(MAIN_NAMES)), "<section>"]]
    main = wrapper[rng.integers(len(wrapper))]
    inner = [
        ["<p>"], ["<p>"], ["<ul>", "<li>"], ["<ol>", "<li>"], ["<blockquote>", "<p>"], ["<section>", "<p>"], ["<h2>"], ["<h3>"], ["<pre>"],
        ["<table>", "<tr>", "<td>"], ["<figure>", "<figcaption>"], ["<div>"], ["<dl>", "<dd>"],
    ]

    def saying(least: int, most: int) -> str:
        return " ".join(words[k] for k in rng.integers(len(words), size=rng.integers(least, most)))

    def other() -> list[Block]:
        kind, name = rng.integers(6), str(rng.choice(OTHER_NAMES))
        inside = main if rng.random() < 0.5 else []
        base = ["<html>", "<body>", *inside]
        if kind == 0:
            tag = str(rng.choice(["<nav>", "<header>", "<footer>", "<menu>"]))
            base = ["<html>", "<body>"] if tag == "<header>" else base
            return [Block([*base, tag, "<ul>", "<li>"], t, len(t)) for t in (saying(1, 4) for _ in range(rng.integers(2, 7)))]
        if kind == 1:
            return [Block([*base, "<aside>", "<p>"], saying(3, 60)) for _ in range(rng.integers(1, 4))]
        if kind == 2:
            return [Block([*base, "<form>", str(rng.choice(["<p>", "<div>", "<fieldset>"]))], saying(1, 20))]
        tag = str(rng.choice(["<div>", "<section>", "<ul>", "<ol>"]))
        leaf = str(rng.choice(["<p>", "<div>", "<li>", "<h3>"]))
        return [Block([*base, tag, name, leaf], saying(2, 70), 0) for _ in range(rng.integers(1, 5))]

    out, marks = [], []
    rename = rng.random() < 0.6
    for block, label in zip(blocks, labels):
        while rng.random() < 0.12:
            new = other()
            out += new
            marks += [False] * len(new)
        if label and rename:
            leaf = [block.path[-1]] if rng.random() < 0.4 else inner[rng.integers(len(inner))]
            text = block.text if rng.random() < 0.7 else saying(1, 12)
            block = Block(["<html>", "<body>", *main, *leaf], text, 0)
        out.append(block)
        marks.append(label)
    return out, marks


def sample(pages: DataFrame) -> list[str]:
    """At most ``SAMPLE_PAGES`` pages: the one with the smallest hash of each slot."""
    order = F.xxhash64("html")
    rows = pages.where(F.col("html").isNotNull()).select(order.alias("at"), F.substring("html", 1, SAMPLE_CHARS).alias("html"))
    picked = rows.groupBy(F.pmod("at", F.lit(SAMPLE_PAGES)).alias("slot")).agg(F.min(F.struct("at", "html")).alias("one"))
    return [r["one"]["html"] for r in picked.orderBy("slot").collect()]


def train(pages: list[str], seed: int = 17) -> Network:
    rng = np.random.default_rng(seed)
    inputs = PATH_SLOTS + WORD_SLOTS + COUNTS
    read = [b for b in map(blocks_of, pages) if b]
    words = [w for b in read for block in b for w in block.text.split()][:50_000] or ["-"]
    shown, labels = [], []
    for blocks in read:
        parts = [blocks[i : i + 60] for i in range(0, len(blocks), 60)]
        for part in parts:
            shown.append(vectors(part))
            labels.append(np.array([teacher(b) for b in part], np.float32))
        for _ in range(3):
            first = rng.integers(len(parts))
            changed, marks = varied(parts[first], rng, words)
            shown.append(vectors(changed))
            labels.append(np.array(marks, np.float32))
    network = Network.fresh(inputs)
    return network.fit(shown, labels) if shown else network


def main_text(pages: DataFrame) -> DataFrame:
    """Article text of every page: page_id, url, text, n_chars, and how many blocks were read and kept."""
    network = pages.sparkSession.sparkContext.broadcast(train(sample(pages)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks = [blocks_of(h or "") for h in batch.column("html").to_pylist()]
        labels = network.value.label([vectors(b) for b in blocks])
        texts = ["\n".join(b.text for b, keep in zip(bs, ls) if keep) for bs, ls in zip(blocks, labels)]
        columns = [
            pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(b) for b in blocks], pa.int64()),
            pa.array([int(k.sum()) for k in labels], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *columns], names=names)

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks long, n_kept long"
    names = [part.split()[0] for part in schema.split(", ")]
    return map_batches(pages.select("page_id", "url", "html"), run, schema)

