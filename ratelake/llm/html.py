"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

A page becomes the sequence of its text blocks in page order. Each block has features of the tags around
it, their class and id words, and its text; neighbours share a transition. The field is trained with numpy
on labelled pages and decoded by Viterbi. Every page is one row and is read, decoded and written by the task
that holds it, so nothing is exchanged; only the fit sees a bounded sample.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import table

#: Pages of the table that a fit may see, the least by a hash of id and html, and the blocks of each.
SAMPLE, SAMPLE_BLOCKS = 400, 400
EPOCHS = 25

#: Elements that tell main text from other text in the pages written for the fit.
ON, OFF = "x-main", "x-other"
#: Elements that end a block of text before and behind them.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol option p pre "
    f"section select summary table tbody td textarea tfoot th thead title tr ul {ON} {OFF}".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page, up to their end tag, and those of them that cannot hold their like.
RAW = ("script", "style", "noscript", "template", "svg", "textarea", "iframe", "select", "title")
ALONE = ("noscript", "textarea", "iframe", "select", "title")
#: Without an end tag: those that end with their parent, those that a block ends too, and those that hold what is up to the next tag.
TO_PARENT, TO_BLOCK, TO_TAG = ("noscript", "template", "svg", "select"), ("svg", "select"), ("script", "style")
#: Blocks that may stand in a `select`.
CHOICES = ("option", "hr", "legend")
#: Elements that a new one of the same kind ends, up to the element named.
CLOSES = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SCOPES = frozenset(f"{ON} {OFF} ul ol menu dl table select article section div main aside nav header footer form body".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


def blocks(page: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """The text blocks of a page in order: text with white space made single, and its open elements.

    Elements are (tag, class, id and role words). Tags that are never closed end with their parent, a
    paragraph also at the next block. Comments, scripts, styles and the like are no text. Of these, one that
    closes itself (`<svg/>`) holds nothing. Where no end tag follows before the next of its kind, `svg`, `select`,
    `template` and `noscript` end with their parent, the first two also before a block, `script` and `style` before
    the next tag, and `title`, `textarea` and `iframe` hold nothing: no text of the page is lost behind them.
    """
    tags: dict[str, tuple[list[int], list[int]]] = {}

    def raw_end(name: str, at: int) -> int | None:
        """Where the end tag of a raw element that begins before `at` ends; the page is searched once for each name."""
        if name not in tags:
            marks = list(re.finditer(rf"<(/?){name}\b[^>]*>", page, re.I))
            tags[name] = [m.start() for m in marks if not m[1]], [m.end() for m in marks if m[1]]
        starts, ends = tags[name]
        i = bisect_left(ends, at)
        if i == len(ends):
            return None
        if name in ALONE:
            j = bisect_left(starts, at)
            if j < len(starts) and starts[j] < ends[i]:
                return None
        return ends[i]

    found: list[tuple[str, list[tuple[str, str]]]] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    at = 0

    def end_block() -> None:
        whole = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if whole and not any(tag in TO_PARENT for tag, _ in stack):
            found.append((whole, list(stack)))

    def close(names: tuple[str, ...], within: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    while True:
        match = TOKEN.search(page, at)
        text.append(page[at : match.start() if match else len(page)])
        if not match:
            break
        at = match.end()
        name = match.group(2)
        if name is None:
            continue
        name, closing = name.lower(), match.group(1)
        if not closing and name in RAW:
            after = raw_end(name, at)
            empty = match.group(3).endswith("/") and name == "svg"
            if after is not None and not empty:
                at = after
            elif name in TO_TAG:
                tag = re.compile("<[/A-Za-z!]").search(page, at)
                at = tag.start() if tag else len(page)
            elif name in TO_PARENT and not empty:
                end_block()
                stack.append((name, ""))
            text.append(" ")
            continue
        if name in BLOCKS and name not in CHOICES:
            first = next((i for i, (tag, _) in enumerate(stack) if tag in TO_BLOCK), None)
            if first is not None:
                text.clear()
                del stack[first:]
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCKS:
            end_block()
        if closing:
            close((name,))
        elif name not in VOID and not match.group(3).endswith("/"):
            if name in CLOSES:
                close(CLOSES[name], SCOPES - {name})
            elif name in BLOCKS:
                close(("p",), SCOPES)
            words = " ".join("".join(v[1:]) for v in ATTRIBUTE.findall(match.group(3)))
            stack.append((name, words.lower()))
    end_block()
    return found


def features(page: list[tuple[str, list[tuple[str, str]]]]) -> list[list[int]]:
    """Hashes of each block's features."""
    last = max(len(page) - 1, 1)
    rows = []
    for i, (text, path) in enumerate(page):
        names = [tag for tag, _ in path]
        own = {"always", f"leaf={names[-1] if names else ''}", f"place={min(4, 5 * i // (last + 1))}"}
        own.update(f"in={name}" for name in names)
        for _, words in path:
            own.update(f"named={w}" for w in WORDS.findall(words))
        size = len(text)
        linked = any(name in ("a", "button", "label") for name in names)
        own.add(f"size={min(6, size.bit_length())}")
        own.add(f"linked={linked}")
        own.add(f"ends={text[-1] in '.!?:;…'}")
        own.add(f"upper={text[:1].isupper()}")
        if "©" in text or "·" in text:
            own.add("marks")
        rows.append([zlib.crc32(f.encode()) for f in own])
    return rows


# --- labelled pages ---

#: Kinds of elements that hold no main text, with what opens them, fixed values; {} is filled with text.
FRAMES = [
    "<nav><ul><li><a href='/a'>{}</a></li><li><a href='/b'>{}</a></li></ul></nav>", "<div class='menu'><a href='/c'>{}</a> <a href='/d'>{}</a></div>",
    "<header><h2>{}</h2><p>{}</p></header>", "<div id='header' class='site-header'><span>{}</span></div>",
    "<div class='navbar'><a>{}</a></div>", "<div class='breadcrumb'><a>{}</a> <a>{}</a></div>",
    "<div class='ad'>{}</div>", "<div class='advert banner'><p>{}</p></div>", "<div class='ads sponsored promo'>{}</div>",
    "<aside><h3>{}</h3><p>{}</p></aside>", "<div class='sidebar'><p>{}</p><ul><li>{}</li></ul></div>", "<div id='related'><p>{}</p></div>",
    "<div class='cookie-notice'><p>{}</p><button>{}</button></div>", "<div class='notice'>{}</div>", "<div role='alert' class='consent popup'>{}</div>",
    "<form action='/s'><label>{}</label><button>{}</button></form>", "<div class='newsletter subscribe'><p>{}</p></div>", "<div class='share social'><a>{}</a></div>",
]
TAILS = [
    "<section class='comments'><h3>{}</h3><div class='comment'><p>{}</p></div></section>", "<div id='comments'><p>{}</p><p>{}</p></div>",
    "<ul class='comment-list replies'><li>{}</li></ul>", "<footer>&copy; {} &middot; {}</footer>", "<div class='footer'><p>{}</p></div>", "<div id='footer' class='copyright'>{}</div>",
]
MAINS = [
    "<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div id='main' class='article post'>{}</div>",
    "<main><article class='story entry'>{}</article></main>", "<div role='main' class='body text'>{}</div>", "<section class='post-content'>{}</section>",
]


def written_pages(lines: list[str], count: int, seed: int = 11) -> list[tuple[list, list[int]]]:
    """Labelled pages in many layouts, written from text lines: blocks, and 1 where one is main text."""
    random = np.random.default_rng(seed)
    made = []

    def line(longest: int) -> str:
        words = lines[random.integers(len(lines))].split()
        return entities.escape(" ".join(words[: random.integers(1, longest)])) or "text"

    def frame(kinds: list[str]) -> str:
        kind = kinds[random.integers(len(kinds))]
        return re.sub(r"\{\}", lambda _: line(60 if random.random() < 0.3 else 12), kind)

    for _ in range(count):
        body = [f"<h1>{line(12)}</h1>"] * int(random.random() < 0.8)
        for _ in range(random.integers(1, 9)):
            tag = ("p", "p", "p", "p", "h2", "li", "blockquote", "td")[random.integers(8)]
            words = line(80 if tag != "h2" else 10)
            if tag == "p" and random.random() < 0.25:
                words = f"<b>{words}</b>" if random.random() < 0.5 else f"{words} <a href='/x'>{line(5)}</a>"
            body.append(f"<{tag}>{words}" + f"</{tag}>" * int(random.random() < 0.9))
            if random.random() < 0.08:
                body.append(f"<{OFF}>{frame(FRAMES)}</{OFF}>")
        main = MAINS[random.integers(len(MAINS))]
        main = main.replace("{}", f"<{ON}>{''.join(body)}</{ON}>")
        above = "".join(frame(FRAMES) for _ in range(random.integers(1, 5)))
        below = "".join(frame(TAILS + FRAMES) for _ in range(random.integers(1, 4)))
        cut, labels = [], []
        for text, path in blocks(f"<html><body>{above}{main}{below}</body></html>"):
            marks = {tag for tag, _ in path}
            labels.append(int(ON in marks and OFF not in marks))
            cut.append((text, [(tag, words) for tag, words in path if tag not in (ON, OFF)]))
        made.append((cut, labels))
    return made


def found_pages(pages: list[str]) -> list[tuple[list, list[int]]]:
    """Pages of the table that mark their one article: what is in it and in no frame is main text."""
    frames = ("nav", "aside", "footer", "header", "form", "button")
    named = re.compile(r"(^|[^a-z])(ad|ads|advert|banner|comments?|sidebar|menu|notice|cookie|share|promo)([^a-z]|$)")
    made = []
    for page in pages:
        cut = blocks(page)
        labels = [
            int(
                any(tag in ("article", "main") for tag, _ in path)
                and not any(tag in frames or named.search(words) for tag, words in path)
            )
            for _, path in cut
        ]
        if any(labels):
            made.append((cut, labels))
    return made


# --- the field ---


class Field:
    """A linear-chain field with two labels: weights by feature hash and label, and transitions."""

    def __init__(self, weights: dict[int, tuple[float, float]], moves: list[list[float]]):
        self.weights, self.moves = weights, moves

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The likeliest labels, by Viterbi; ties go to label 0."""
        get, none, moves = self.weights.get, (0.0, 0.0), self.moves
        best, back = (0.0, 0.0), []
        for i, row in enumerate(rows):
            zero = one = 0.0
            for feature in row:
                a, b = get(feature, none)
                zero += a
                one += b
            if i == 0:
                best = (zero, one)
                continue
            steps = []
            scores = []
            for label, own in ((0, zero), (1, one)):
                stay, come = best[0] + moves[0][label], best[1] + moves[1][label]
                steps.append(int(come > stay))
                scores.append(own + max(stay, come))
            back.append(steps)
            best = (scores[0], scores[1])
        labels = [int(best[1] > best[0])] if rows else []
        for steps in reversed(back):
            labels.append(steps[labels[-1]])
        return labels[::-1]


def train(pages: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3, seed: int = 5) -> Field:
    """Fits the field to pages, each the features of its blocks and their labels, by maximum likelihood.

    Steps are adaptive; forward and backward run over many pages at once.
    """
    rows = [own for own, _ in pages]
    names = sorted({f for page in rows for row in page for f in row})
    place = {f: i for i, f in enumerate(names)}
    weights, moves = np.zeros((len(names), 2)), np.zeros((2, 2))
    sums = np.full((len(names), 2), 1e-8), np.full((2, 2), 1e-8)
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for some in np.array_split(random.permutation(len(pages)), max(1, len(pages) // 64)):
            length = max(len(rows[p]) for p in some)
            own = np.zeros((len(some), length, 2))
            there = np.zeros((len(some), length), bool)
            truth = np.zeros((len(some), length), int)
            cells, columns = [], []
            for k, p in enumerate(some):
                truth[k, : len(rows[p])] = pages[p][1]
                there[k, : len(rows[p])] = True
                for i, row in enumerate(rows[p]):
                    cells += [k * length + i] * len(row)
                    columns += [place[f] for f in row]
            cells, columns = np.array(cells), np.array(columns)
            for label in (0, 1):
                own[:, :, label] = np.bincount(cells, weights[columns, label], len(some) * length).reshape(-1, length)
            forward, backward = np.zeros_like(own), np.zeros_like(own)
            forward[:, 0] = own[:, 0]
            for i in range(1, length):
                step = np.logaddexp.reduce(forward[:, i - 1, :, None] + moves, axis=1) + own[:, i]
                forward[:, i] = np.where(there[:, i, None], step, forward[:, i - 1])
            total = np.logaddexp.reduce(forward[:, -1], axis=1)
            for i in range(length - 2, -1, -1):
                step = np.logaddexp.reduce(moves + (own[:, i + 1] + backward[:, i + 1])[:, None, :], axis=2)
                backward[:, i] = np.where(there[:, i + 1, None], step, 0.0)
            likely = np.exp(forward + backward - total[:, None, None]) * there[:, :, None]
            slope = (likely - np.eye(2)[truth] * there[:, :, None]).reshape(-1, 2) / len(some)
            change = np.stack([np.bincount(columns, slope[cells, label], len(names)) for label in (0, 1)], 1) + decay * weights
            turn = np.zeros((2, 2))
            for i in range(1, length):
                pair = forward[:, i - 1, :, None] + moves + (own[:, i] + backward[:, i])[:, None, :] - total[:, None, None]
                here = there[:, i]
                turn += np.exp(pair[here]).sum(0)
                np.subtract.at(turn, (truth[here, i - 1], truth[here, i]), 1)
            turn = turn / len(some) + decay * moves
            for value, grad, square in ((weights, change, sums[0]), (moves, turn, sums[1])):
                square += grad**2
                value -= rate * grad / np.sqrt(square)
    return Field({f: (float(a), float(b)) for f, (a, b) in zip(names, weights, strict=True)}, moves.tolist())


def fit(pages: DataFrame, sample: int = SAMPLE, longest: int = SAMPLE_BLOCKS) -> Field:
    """The field from written pages, and at most `sample` pages of the table that mark their article.

    Pages are cut and labelled in tasks. Of a page, the first `longest` blocks come to the driver, as features and
    labels, and a few lines for the written pages, cut to 60 words.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(0).to_pylist():
                for cut, labels in found_pages([raw.decode("utf-8", "replace")]):
                    lines = [" ".join(text.split()[:60])[:600] for text, _ in cut[:20]]
                    rows.append((features(cut)[:longest], labels[:longest], lines))
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            kinds = [pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["features", "labels", "lines"])

    # Keys are chosen first, so no page goes through the task that sorts; a page that is repeated counts once.
    keyed = pages.filter("html is not null").select(F.xxhash64("page_id", "html").alias("_key"), F.col("html").cast("binary").alias("html"))
    keys = keyed.select("_key").distinct().orderBy("_key").limit(sample)
    chosen = keyed.join(F.broadcast(keys), "_key").dropDuplicates(["_key"]).select("html")
    rows = sorted(
        chosen.mapInArrow(work, "features array<array<long>>, labels array<long>, lines array<string>").collect(),
        key=lambda r: (r["lines"], r["labels"]),
    )
    lines = [line for r in rows[:100] for line in r["lines"]] or ["Some words of plain text, written as a line."]
    written = [(features(cut), labels) for cut, labels in written_pages(lines, 400)]
    return train([(r["features"], r["labels"]) for r in rows] + written)


def main_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row: the main text of its whole html.

    Reads page_id, url and html; a NULL or empty html, and one without main text, gives an empty text.
    Rows map one to one, and repeated pages give repeated rows. Blocks are joined by one newline.
    """
    field = field or fit(pages)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for raw in batch.column(2):
                cut = blocks(raw.as_py().decode("utf-8", "replace"))
                labels = field.decode(features(cut))
                texts.append("\n".join(text for (text, _), label in zip(cut, labels, strict=True) if label))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    read = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).cast("binary").alias("html")
    )
    return read.mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return main_text(table(spark, sf_dir, "pages"))
