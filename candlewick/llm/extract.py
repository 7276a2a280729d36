"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks: runs of text between block-level tags. Each has two vectors,
one hashed from the tags above it (names, classes, ids), one from its words. A bidirectional LSTM
in numpy reads the whole sequence, so every block is labelled in the light of all others, and the
blocks labelled as content are the page's text.

The labeller is trained here, on pages whose structure says what is content: a bounded sample of
the given pages that mark their article, and pages composed from the same words in other layouts.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh32_intdigest

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset("script style noscript template svg math iframe object canvas select option textarea audio video head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_SAME = {"p": "p", "li": "li", "option": "option", "tr": "tr", "td": "td", "th": "td", "dd": "dd", "dt": "dd"}
#: All that a head may hold; any other element ends an open one, and text does too.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head".split())
#: Raw elements that a slash at the end of their tag closes.
SELF_CLOSED = frozenset("svg iframe".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_LABEL = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe")}
_NAME_PART = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order: text between block-level tags, references decoded, white space made one blank.

    A line break ends a block. Scripts, styles, comments and other silent elements give none. Unclosed and stray tags do no harm.
    """
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    pieces: list[str] = []

    def end_block() -> None:
        text = " ".join(entities.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            found.append(Block(text, tuple(name for _, name in stack)))

    def close_from(depth: int) -> None:
        nonlocal silent
        silent -= sum(name in SILENT for name, _ in stack[depth:])
        del stack[depth:]

    at, silent = 0, 0
    for match in iter(lambda: _TOKEN.search(page, at), None):
        if silent and stack[-1][0] == "head" and not page[at : match.start()].isspace() and match.start() > at:
            close_from(len(stack) - 1)
        if not silent and match.start() > at:
            pieces.append(page[at : match.start()])
        at = match.end()
        tag = match.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if match.group("close"):
            if tag in INLINE:
                continue
            end_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close_from(depth)
                    break
            continue
        if stack and stack[-1][0] == "head" and tag not in IN_HEAD:
            close_from(len(stack) - 1)
        if tag in INLINE:
            continue
        end_block()
        if tag in VOID:
            continue
        same = CLOSED_BY_SAME.get(tag)
        if same and stack and CLOSED_BY_SAME.get(stack[-1][0]) == same:
            close_from(len(stack) - 1)
        elif stack and stack[-1][0] == "p":  # a block-level element ends an open paragraph
            close_from(len(stack) - 1)
        if tag in SELF_CLOSED and (match.group("attrs") or "").rstrip().endswith("/"):
            continue
        if tag in _RAW_END:
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else len(page)
            continue
        attrs = match.group("attrs") or ""
        if attrs.rstrip().endswith("/") and tag not in ("p", "div"):
            continue
        labels = " ".join(a or b or c for a, b, c in _LABEL.findall(attrs))
        stack.append((tag, f"{tag} {labels.lower()}".strip()))
        silent += tag in SILENT
    if silent and stack[-1][0] == "head" and page[at:].strip():
        close_from(len(stack) - 1)
    if not silent and at < len(page):
        pieces.append(page[at:])
    end_block()
    return found


@dataclass
class Settings:
    path_dim: int = 64
    word_dim: int = 32
    hidden: int = 16
    epochs: int = 10
    rate: float = 0.015
    #: Given pages to learn from at most, and characters of one of them at most; and pages composed for training.
    sample_pages: int = 200
    sample_chars: int = 60_000
    composed: int = 500
    #: Blocks of a sequence in training; in use, sequences are whole.
    train_blocks: int = 60
    seed: int = 11


_NUMBERS = 10


def vectors(blocks: list[Block], settings: Settings) -> np.ndarray:
    """One row per block: hashed tag path, hashed words, and a few plain numbers."""
    out = np.zeros((len(blocks), settings.path_dim + settings.word_dim + _NUMBERS), dtype=np.float32)
    paths: dict[tuple[str, ...], np.ndarray] = {}
    known: dict[str, int] = {}
    for row, block in enumerate(blocks):
        path = paths.get(block.path)
        if path is None:
            path = paths[block.path] = np.zeros(settings.path_dim, dtype=np.float32)
            for depth, name in enumerate(reversed(block.path)):
                tag, _, labels = name.partition(" ")
                for part in (tag, *(tag + "." + x for x in _NAME_PART.findall(labels)), *("." + x for x in _NAME_PART.findall(labels))):
                    h = xxh32_intdigest(part)
                    path[h % settings.path_dim] += (1.0 if h & 0x10000 else -1.0) * max(0.8**depth, 0.2)
        out[row, : settings.path_dim] = path
        words = block.text.split()
        size = len(words)
        bag = [0.0] * settings.word_dim
        share = size**-0.5
        for word, times in Counter(words).items():
            h = known.get(word)
            if h is None:
                h = known[word] = xxh32_intdigest(word.lower())
            bag[h % settings.word_dim] += (share if h & 0x10000 else -share) * times
        out[row, settings.path_dim : settings.path_dim + settings.word_dim] = bag
        last = block.text[-1]
        tag = block.path[-1].partition(" ")[0] if block.path else ""
        out[row, -_NUMBERS:] = (
            min(np.log1p(size) / 6, 1.5), size <= 3, size >= 15, last in ".!?:;…", "©" in block.text or "|" in block.text,
            tag in ("p", "pre", "blockquote"), tag[:1] == "h" and tag[1:].isdigit(), tag in ("li", "td", "th", "dd", "dt"),
            min(len(block.path) / 10, 1.5), row / max(len(blocks) - 1, 1),
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


@dataclass
class Labeller:
    """Bidirectional LSTM over blocks with a logistic output."""

    settings: Settings
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, settings: Settings) -> Labeller:
        rng = np.random.default_rng(settings.seed)
        n, h = settings.path_dim + settings.word_dim + _NUMBERS, settings.hidden
        weights = {}
        for side in ("f", "b"):
            weights["x" + side] = rng.normal(0, n**-0.5, (n, 4 * h))
            weights["h" + side] = rng.normal(0, h**-0.5, (h, 4 * h))
            weights["c" + side] = np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)]
        weights["o"] = rng.normal(0, (2 * h) ** -0.5, 2 * h)
        weights["d"] = np.zeros(1)
        return cls(settings, {k: v.astype(np.float32) for k, v in weights.items()})

    def _scan(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States of one direction for a padded batch (pages, blocks, features)."""
        w, u, c = self.weights["x" + side], self.weights["h" + side], self.weights["c" + side]
        pages, steps, _ = x.shape
        h = self.settings.hidden
        pre = x @ w + c
        state, cell = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
        out = np.zeros((pages, steps, h), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + state @ u
            i, f, o = (_sigmoid(z[:, j * h : (j + 1) * h]) for j in range(3))
            g = np.tanh(z[:, 3 * h :])
            m = mask[:, t : t + 1]
            new_cell = f * cell + i * g
            bent = np.tanh(new_cell)
            if keep is not None:
                keep.append((t, state, cell, i, f, o, g, bent, m))
            cell = m * new_cell + (1 - m) * cell
            state = m * (o * bent) + (1 - m) * state
            out[:, t] = state
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        trace = {"f": None, "b": None} if keep is None else {"f": [], "b": []}
        both = np.concatenate([self._scan(x, mask, side, trace[side]) for side in ("f", "b")], axis=2)
        p = _sigmoid(both @ self.weights["o"] + self.weights["d"])
        if keep is not None:
            keep |= {"trace": trace, "both": both}
        return p

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of a padded batch, through time in both directions."""
        kept: dict = {}
        p = self.forward(x, mask, kept)
        d = ((p - y) * mask / max(mask.sum(), 1)).astype(np.float32)
        grads = {"o": np.einsum("pt,pth->h", d, kept["both"]), "d": np.array([d.sum()], np.float32)}
        back = d[:, :, None] * self.weights["o"]
        h = self.settings.hidden
        for number, side in enumerate(("f", "b")):
            u = self.weights["h" + side]
            own = back[:, :, number * h : (number + 1) * h]
            gz = np.zeros((*mask.shape, 4 * h), np.float32)
            gu = np.zeros_like(u)
            dstate, dcell = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
            for t, state, cell, i, f, o, g, bent, m in reversed(kept["trace"][side]):
                dstate = dstate + own[:, t]
                dh, dc = dstate * m, dcell * m
                inner = dc + dh * o * (1 - bent**2)
                z = np.concatenate([inner * g * i * (1 - i), inner * cell * f * (1 - f), dh * bent * o * (1 - o), inner * i * (1 - g**2)], axis=1)
                gz[:, t] = z
                gu += state.T @ z
                dstate = dstate * (1 - m) + z @ u.T
                dcell = dcell * (1 - m) + inner * f
            grads["h" + side] = gu
            grads["x" + side] = np.tensordot(x, gz, axes=([0, 1], [0, 1]))
            grads["c" + side] = gz.sum(axis=(0, 1))
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32)
    mask = np.zeros((len(pages), steps), np.float32)
    for row, page in enumerate(pages):
        x[row, : len(page)], mask[row, : len(page)] = page, 1
    return x, mask


def train(pages: list[np.ndarray], labels: list[np.ndarray], settings: Settings) -> Labeller:
    """Adam on the cross entropy of all blocks, in batches of pages of like length."""
    model = Labeller.new(settings)
    rng = np.random.default_rng(settings.seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    full = [i for i in range(len(pages)) if len(pages[i])]
    step = 0
    for epoch in range(settings.epochs):
        order = sorted(full, key=lambda i: (len(pages[i]) // 8, rng.random()))
        batches = [order[low : low + 16] for low in range(0, len(order), 16)]
        for number in rng.permutation(len(batches)):
            rows = batches[number]
            x, mask = _padded([pages[i] for i in rows])
            y = np.zeros_like(mask)
            for at, i in enumerate(rows):
                y[at, : len(labels[i])] = labels[i]
            step += 1
            rate = settings.rate * (1 - epoch / settings.epochs) + 1e-4
            for name, grad in model.gradients(x, mask, y).items():
                grad = np.clip(grad, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.99 * second[name] + 0.01 * grad**2
                move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
                model.weights[name] = model.weights[name] - np.float32(rate) * move.astype(np.float32)
    return model


def label(model: Labeller, pages: list[list[Block]], most_blocks: int = 12_000) -> list[np.ndarray]:
    """Probability of content for every block of every page; pages of like length are run together, within a bound of blocks."""
    out = [np.zeros(0)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    low = 0
    while low < len(order):
        high = low + 1
        while high < len(order) and len(pages[order[high]]) * (high + 1 - low) <= most_blocks:
            high += 1
        rows = order[low:high]
        x, mask = _padded([vectors(pages[i], model.settings) for i in rows])
        p = model.forward(x, mask)
        for at, i in enumerate(rows):
            out[i] = p[at, : len(pages[i])]
        low = high
    return out


# Names that layouts commonly give to what is and is not content, for the composed training pages.
_CONTENT_NAMES = ["content", "main-content", "post", "post-body", "entry-content", "article-body", "story", "text", "page-content", "main"]
_OTHER_NAMES = {
    "nav": ["nav", "navbar", "menu", "main-menu", "breadcrumb", "topbar", "navigation", "tabs", "pagination"],
    "header": ["header", "site-header", "masthead", "banner", "logo", "branding"],
    "footer": ["footer", "site-footer", "copyright", "bottom", "legal", "colophon"],
    "aside": ["sidebar", "widget", "related", "related-posts", "recommended", "tags", "share", "social", "promo", "trending"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "banner-ad", "adsense"],
    "notice": ["cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "overlay"],
    "form": ["search", "login", "signup", "contact-form", "searchform", "newsletter-form"],
    "comments": ["comments", "comment", "comment-list", "comment-body", "respond", "discussion", "replies", "disqus"],
}


def compose(rng: np.random.Generator, sentences: list[str]) -> tuple[str, list[bool]]:
    """A page in a layout of its own, and for each of its blocks whether it is content."""
    parts: list[str] = []
    truth: list[bool] = []

    def some(low: int, high: int) -> str:
        words = " ".join(sentences[int(rng.integers(len(sentences)))] for _ in range(int(rng.integers(1, 4)))).split()
        n = int(rng.integers(low, high + 1))
        return " ".join((words * (n // max(len(words), 1) + 1))[:n]) or "text"

    def put(content: bool, text: str, tag: str = "p", attrs: str = "") -> None:
        blocks = 1 if text.split() else 0
        if rng.random() < 0.15 and len(text) > 12:
            cut = text.find(" ", len(text) // 2)
            if cut > 0:
                text = text[:cut] + rng.choice(["<b>", "<a href='#'>", "<em>", "<span class='x'>"]) + text[cut:]
        close = "" if tag in ("p", "li") and rng.random() < 0.1 else f"</{tag}>"
        parts.append(f"<{tag}{attrs}>{entities.escape(text, quote=False) if '<' not in text else text}{close}")
        truth.extend([content] * blocks)

    def box(kind: str) -> None:
        name = str(rng.choice(_OTHER_NAMES[kind]))
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        tag = tag if rng.random() < 0.5 else "div"
        bare = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5
        parts.append(f"<{tag}>" if bare else f'<{tag} {rng.choice(["class", "id"])}="{name}">')
        if kind in ("nav",) or kind in ("aside", "footer") and rng.random() < 0.4:
            parts.append("<ul>")
            for _ in range(int(rng.integers(2, 9))):
                parts.append("<li>")
                put(False, some(1, 4), "a" if rng.random() < 0.5 else "span")
                parts.append("</li>")
            parts.append("</ul>")
        elif kind == "form":
            put(False, some(1, 6), "label")
            parts.append("<input type='text'>")
            put(False, some(1, 2), "button")
        elif kind == "comments":
            put(False, some(1, 3), str(rng.choice(["h2", "h3", "h4"])))
            for _ in range(int(rng.integers(1, 7))):
                parts.append('<div class="comment">' if rng.random() < 0.6 else "<article>" if rng.random() < 0.3 else "<div>")
                tag_ended = parts[-1][1:].split(">")[0].split(" ")[0]
                if rng.random() < 0.6:
                    put(False, some(1, 4), "div")
                put(False, some(4, 50))
                parts.append(f"</{tag_ended}>")
        else:
            for _ in range(int(rng.integers(1, 4))):
                put(False, some(2, 30), str(rng.choice(["p", "div", "h3", "span"])) if rng.random() < 0.7 else "p")
                if parts[-1].startswith("<span"):
                    parts.append("<br>")
        parts.append(f"</{tag}>")

    before = [k for k in ("header", "nav", "notice", "ad", "form") if rng.random() < 0.55]
    after = [k for k in ("comments", "aside", "ad", "form", "notice", "footer") if rng.random() < 0.55]
    for kind in before:
        box(kind)
    outer = rng.random()
    if outer < 0.45:
        opening, closing = "<article>", "</article>"
    elif outer < 0.6:
        opening, closing = "<main>", "</main>"
    else:
        opening, closing = f'<div {rng.choice(["class", "id"])}="{rng.choice(_CONTENT_NAMES)}">', "</div>"
    if rng.random() < 0.2:
        opening, closing = "<main>" + opening, closing + "</main>"
    parts.append(opening)
    if rng.random() < 0.85:
        put(True, some(2, 14), str(rng.choice(["h1", "h1", "h2"])))
    for _ in range(int(rng.integers(1, 14))):
        kind = rng.random()
        if kind < 0.72:
            put(True, some(1, 90))
        elif kind < 0.8:
            put(True, some(2, 8), str(rng.choice(["h2", "h3"])))
        elif kind < 0.86:
            parts.append("<ul>")
            for _ in range(int(rng.integers(2, 6))):
                put(True, some(2, 20), "li")
            parts.append("</ul>")
        elif kind < 0.9:
            put(True, some(5, 40), "blockquote")
        elif kind < 0.94:
            parts.append("<table><tr>")
            for _ in range(int(rng.integers(1, 4))):
                put(True, some(1, 6), "td")
            parts.append("</tr></table>")
        else:
            box(str(rng.choice(["ad", "aside", "notice"])))
    parts.append(closing)
    for kind in after:
        box(kind)
    return "<html><body>" + "".join(parts) + "</body></html>", truth


_MARKED = ("article", "main")
_NEVER = ("nav", "footer", "aside", "form", "header")


def marked_content(blocks: list[Block]) -> np.ndarray | None:
    """Labels that a page's own markup gives: inside its article or main element; None if it has neither."""
    inside = [any(name.partition(" ")[0] in _MARKED for name in block.path) for block in blocks]
    if not any(inside):
        return None
    other = [any(name.partition(" ")[0] in _NEVER or " ad" in name or "comment" in name for name in block.path) for block in blocks]
    return np.array([a and not b for a, b in zip(inside, other, strict=True)], dtype=np.float32)


def fit(sample: list[str], settings: Settings) -> Labeller:
    """Train the labeller on given pages that mark their content and on composed pages of their words."""
    rng = np.random.default_rng(settings.seed)
    pages, labels, sentences = [], [], []
    for page in sample:
        blocks = blocks_of(page)
        sentences += [block.text for block in blocks]
        truth = marked_content(blocks)
        if truth is not None:
            pages.append(blocks)
            labels.append(truth)
    sentences = sentences or ["one two three four five six seven.", "eight nine ten."]
    for _ in range(settings.composed):
        page, truth = compose(rng, sentences)
        blocks = blocks_of(page)
        if len(blocks) == len(truth):
            pages.append(blocks)
            labels.append(np.array(truth, dtype=np.float32))
    most = settings.train_blocks
    inputs, wanted = [], []
    for blocks, truth in zip(pages, labels, strict=True):
        made = vectors(blocks, settings)
        if len(made) > most:  # keep both ends, where content begins and ends
            made, truth = np.r_[made[: most // 2], made[-most // 2 :]], np.r_[truth[: most // 2], truth[-most // 2 :]]
        inputs.append(made)
        wanted.append(truth)
    return train(inputs, wanted, settings)


def extract_text(
    pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url"), id_column: str = "page_id", settings: Settings | None = None
) -> DataFrame:
    """Main text of every page: the columns ``keep``, ``text`` (content blocks joined by line feeds), ``n_chars``, ``n_blocks``.

    Whole pages are read, none is cut. Null and empty pages and pages without content give the empty text. The labeller is
    trained on the driver from at most ``sample_pages`` pages (the same on every run) and sent to the tasks; its size is
    fixed by the settings. Repeated rows each give a row; an empty table gives none; columns not in ``keep`` are not read.
    """
    settings = settings or Settings()
    markup = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    # The sample is drawn by hashes alone; only the pages drawn are then fetched, each once.
    marked = pages.select(markup.alias("html"), F.xxhash64(F.col(id_column).cast("string"), markup).alias("h"))
    marked = marked.filter(F.length("html").between(1, settings.sample_chars))
    drawn = [row["h"] for row in marked.select("h").distinct().orderBy("h").limit(settings.sample_pages).collect()]
    found = marked.filter(F.col("h").isin(drawn)).groupBy("h").agg(F.min("html").alias("html")).collect()
    model = fit([row["html"] for row in sorted(found)], settings)
    shared = pages.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller(settings, shared.value)
        for batch in batches:
            texts: list[str] = []
            counts: list[int] = []
            waiting: list[list[Block]] = []
            held = 0

            def flush():
                for blocks, p in zip(waiting, label(own, waiting), strict=True):
                    kept = [block.text for block, good in zip(blocks, p >= 0.5, strict=True) if good]
                    texts.append("\n".join(kept))
                    counts.append(len(kept))
                waiting.clear()

            for value in batch.column(batch.num_columns - 1):
                blocks = blocks_of(value.as_py())
                waiting.append(blocks)
                held += len(blocks)
                if held >= 4000:
                    flush()
                    held = 0
            flush()
            sizes = [len(text) for text in texts]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = pages.select(*[F.col(c) for c in keep], markup.alias("_html"))
    new = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_blocks", T.LongType())]
    schema = T.StructType([*rows.schema.fields[:-1], *new])
    return rows.mapInArrow(run, schema)
