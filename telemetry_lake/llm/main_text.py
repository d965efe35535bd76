"""Main text of pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi."""

from __future__ import annotations

import html
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.pages import Block, blocks

# Elements that are no part of an article although they may stand in one; HTML's own names.
ASIDE = {"nav", "aside", "footer", "form", "header", "button", "select", "textarea", "menu", "dialog"}


def block_features(block: Block) -> list[str]:
    """What the field sees of one block: the elements around it and the shape of its text."""
    text, size = block.text, len(block.text)
    out = ["bias", f"size {min(size.bit_length(), 12)}", f"linked {round(4 * min(1.0, block.linked / max(1, size)))}"]
    out += [f"in {t}" for t in set(block.tags)]
    out += [f"named {n}" for n in set(block.names)]
    last = next((t for t in reversed(block.tags) if t not in ("b", "i", "em", "strong", "span", "a")), "none")
    out.append(f"leaf {last}")
    out.append("stop" if text[-1] in ".!?…。" else "no stop")
    if "©" in text or "copyright" in text.lower():
        out.append("copyright")
    out.append(f"spaces {min(text.count(' '), 40).bit_length()}")
    return out


@dataclass
class Field:
    """Weights of a two-state chain (1: main text): per feature the state's advantage, and per step and start."""

    weights: dict[str, float]
    steps: np.ndarray  # from state, to state
    start: float

    def decode(self, found: Sequence[Block]) -> list[bool]:
        """The likeliest states of all blocks together."""
        if not found:
            return []
        get = self.weights.get
        gains = [sum(get(f, 0.0) for f in block_features(b)) for b in found]
        (s00, s01), (s10, s11) = self.steps.tolist()
        zero, one = 0.0, self.start + gains[0]
        back: list[tuple[int, int]] = []
        for gain in gains[1:]:
            from_zero = 0 if zero + s00 >= one + s10 else 1
            from_one = 0 if zero + s01 >= one + s11 else 1
            back.append((from_zero, from_one))
            zero, one = max(zero + s00, one + s10), max(zero + s01, one + s11) + gain
        state = int(one > zero)
        states = [state]
        for step in reversed(back):
            state = step[state]
            states.append(state)
        return [s == 1 for s in reversed(states)]


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-4) -> Field:
    """Maximum likelihood with weight decay, by gradients from the forward and backward sums of all pages at once."""
    names = sorted({f for seen, _ in pages for block in seen for f in block})
    index = {f: i for i, f in enumerate(names)}
    longest = max(len(seen) for seen, _ in pages)
    count = len(pages)
    states = np.zeros((count, longest), int)
    real = np.zeros((count, longest), bool)
    at, owner = [], []
    for p, (seen, truth) in enumerate(pages):
        real[p, : len(seen)] = True
        states[p, : len(seen)] = truth
        for t, block in enumerate(seen):
            at += [index[f] for f in block]
            owner += [p * longest + t] * len(block)
    at, owner = np.array(at), np.array(owner)
    total = real.sum()
    size = len(names)
    w, first, second = np.zeros(size + 5), np.zeros(size + 5), np.zeros(size + 5)
    moves = real[:, 1:]
    true_steps = np.array(
        [((states[:, :-1] == a) & (states[:, 1:] == b) & moves).sum() for a in (0, 1) for b in (0, 1)], float
    )
    for number in range(1, rounds + 1):
        gain = np.bincount(owner, w[at], count * longest).reshape(count, longest)
        local = np.stack([np.zeros_like(gain), gain], -1)
        steps = w[size : size + 4].reshape(2, 2)
        ahead = np.zeros((count, longest, 2))
        ahead[:, 0] = local[:, 0] + np.array([0.0, w[size + 4]])
        for t in range(1, longest):
            ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + steps, axis=1) + local[:, t]
        behind = np.zeros((count, longest, 2))
        for t in range(longest - 2, -1, -1):
            onward = np.logaddexp.reduce(steps + (local[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(real[:, t + 1, None], onward, 0.0)
        joint = ahead + behind
        whole = np.logaddexp.reduce(joint, axis=2, keepdims=True)
        chance = np.exp(joint - whole)[..., 1]
        error = np.where(real, chance - states, 0.0).ravel()
        slope = decay * w
        slope[:size] += np.bincount(at, error[owner], size) / total
        pair = ahead[:, :-1, :, None] + steps + (local[:, 1:] + behind[:, 1:])[:, :, None, :]
        expected = np.exp(pair - whole[:, 1:, :, None])
        slope[size : size + 4] += ((expected * moves[..., None, None]).sum((0, 1)).ravel() - true_steps) / total
        slope[size + 4] += (chance[:, 0] - states[:, 0]).sum() / total
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= rate * (first / (1 - 0.9**number)) / (np.sqrt(second / (1 - 0.999**number)) + 1e-8)
    return Field(dict(zip(names, w[:size].tolist())), w[size : size + 4].reshape(2, 2), float(w[size + 4]))


def labelled(page: str | None) -> tuple[list[list[str]], list[int]] | None:
    """Blocks of a page with an ``article`` (or ``main``) element, labelled by HTML's own elements; else nothing."""
    found = blocks(page)
    own = next((e for e in ("article", "main") if any(e in b.tags for b in found)), None)
    if own is None:
        return None
    truth = []
    for block in found:
        inside = block.tags[block.tags.index(own) :] if own in block.tags else ()
        truth.append(int(bool(inside) and not ASIDE & set(inside)))
    return [block_features(b) for b in found], truth


# Parts of the drawn layouts: what may hold an article, and what may stand around or in it. ``{}`` is for text.
HOLDERS = (
    "<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="main"><div>{}</div></div>',
    '<div class="post"><div class="entry">{}</div></div>', '<div class="article-body">{}</div>',
    '<main role="main"><article class="story">{}</article></main>', '<section class="text">{}</section>',
    "<div>{}</div>", "<table><tr><td>{}</td></tr></table>",
)
PARAGRAPHS = ("<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}</b></p>", "<blockquote>{}</blockquote>", "<li>{}</li>", "<h2>{}</h2>", "<h1>{}</h1>", "<pre>{}</pre>", "<td>{}</td>")
AROUND = (
    '<nav><ul><li><a href="/">{}</a></li><li><a href="/x">{}</a></li><li><a href="/y">{}</a></li></ul></nav>',
    '<div class="menu"><a href="/">{}</a> <a href="/x">{}</a></div>', '<ul id="navigation"><li><a href="/">{}</a></li></ul>',
    '<div class="breadcrumbs"><a href="/">{}</a> / <a href="/x">{}</a></div>',
    "<header><h1>{}</h1><p>{}</p></header>", '<div id="header"><a href="/">{}</a><p>{}</p></div>',
    '<div class="banner"><p>{}</p></div>', '<div id="masthead">{}</div>',
    '<aside><h3>{}</h3><p>{}</p></aside>', '<div class="sidebar"><h3>{}</h3><ul><li><a href="/">{}</a></li></ul><p>{}</p></div>',
    '<div class="related"><h3>{}</h3><a href="/">{}</a></div>', '<div class="widget"><p>{}</p></div>',
    '<div class="ad">{}</div>', '<div class="ads"><p>{}</p></div>', '<div class="advert"><p>{}</p></div>',
    '<div class="advertisement">{}</div>', '<div id="ad-top"><p>{}</p></div>', '<div class="sponsored"><p>{}</p></div>',
    '<div class="promo"><p>{}</p><a href="/">{}</a></div>', "<ins>{}</ins>",
    '<div class="cookie-notice"><p>{}</p><button>{}</button></div>', '<div class="notice">{}</div>',
    '<div id="cookie-banner"><p>{}</p></div>', '<div role="alert"><p>{}</p></div>', '<div class="consent gdpr"><p>{}</p></div>',
    '<div class="popup modal"><p>{}</p></div>', "<dialog><p>{}</p></dialog>",
    '<form><label>{}</label><input name="q"><button>{}</button></form>', '<form class="newsletter"><p>{}</p><textarea>{}</textarea></form>',
    '<div class="subscribe"><p>{}</p></div>', '<div class="share social"><a href="/">{}</a></div>',
    '<section class="comments"><h3>{}</h3><div class="comment"><p>{}</p></div><div class="comment"><p>{}</p></div></section>',
    '<div id="comments"><p>{}</p><p>{}</p></div>', '<ol class="comment-list"><li><p>{}</p></li></ol>',
    '<section id="disqus" class="discussion"><p>{}</p></section>', '<div class="reply replies"><p>{}</p></div>',
    "<footer><p>&copy; {}</p></footer>", '<div id="footer"><p>Copyright {}</p><a href="/">{}</a></div>', '<div class="copyright">&copy; {}</div>',
)


def drawn(texts: Sequence[str], random: np.random.Generator) -> tuple[list[list[str]], list[int]]:
    """A page laid out anew from texts of real blocks, with its labels: what stands in the holder is main text."""

    def pick() -> str:
        return html.escape(texts[int(random.integers(len(texts)))])

    def short() -> str:
        return " ".join(pick().split()[: int(random.integers(1, 9))])

    def aside() -> str:
        part = AROUND[int(random.integers(len(AROUND)))]
        while "{}" in part:
            part = part.replace("{}", short() if random.random() < 0.6 else pick(), 1)
        return part

    mark = "main text mark"
    body = []
    for _ in range(int(random.integers(1, 9))):
        shape = PARAGRAPHS[0] if random.random() < 0.6 else PARAGRAPHS[int(random.integers(len(PARAGRAPHS)))]
        body.append(shape.format(f"{mark} {pick() if random.random() < 0.8 else short()}"))
        if random.random() < 0.3:
            body.append(aside())
    if random.random() < 0.3:
        body.append(aside())
    holder = HOLDERS[int(random.integers(len(HOLDERS)))].format("".join(body))
    before = "".join(aside() for _ in range(int(random.integers(0, 4))))
    after = "".join(aside() for _ in range(int(random.integers(0, 4))))
    if random.random() < 0.3:
        holder = f'<div class="wrapper container page">{holder}</div>'
    found = blocks(f"<html><body>{before}{holder}{after}</body></html>")
    truth = [int(b.text.startswith(mark)) for b in found]
    for block, own in zip(found, truth):
        if own:
            block.text = block.text[len(mark) :].strip() or "."
    return [block_features(b) for b in found], truth


def train(
    pages: DataFrame,
    sample: int = 200,
    layouts: int = 1000,
    page_chars: int = 100_000,
    page_blocks: int = 200,
    seed: int = 5,
) -> Field | None:
    """A field from about ``sample`` of the pages (all, if there are fewer), picked by a hash of their content.

    Pages with an article are labelled by their elements. Their blocks are also laid out anew in ``layouts`` drawn
    pages of other kinds, labelled by how they were drawn, so that the field does not hang on one template. The sample
    is bounded: training reads ``page_chars`` characters and ``page_blocks`` blocks of a page at most (extraction reads
    all). No text, no field.
    """
    known = pages.filter(F.col("html").isNotNull()).select("html").withColumn(
        "_h", F.xxhash64("html")
    )
    # One row per content, so that many copies of a page are not the whole sample; the limit is on training alone.
    # Only hashes of all pages are shuffled; whole pages are those of the sample.
    hashes = [r[0] for r in known.select("_h").distinct().orderBy("_h").limit(sample).collect()]
    picked = known.filter(F.col("_h").isin(hashes)).groupBy("_h").agg(F.first(F.substring("html", 1, page_chars)).alias("html"))
    chosen = [r["html"] for r in picked.orderBy("_h").collect()]
    rows = [found for page in chosen if (found := labelled(page)) and found[0]]
    texts = [b.text for page in chosen for b in blocks(page)]
    if not texts:
        return None
    random = np.random.default_rng(seed)
    rows += [found for _ in range(layouts) if (found := drawn(texts, random))[0]]
    return fit([(seen[:page_blocks], truth[:page_blocks]) for seen, truth in rows])


def main_text(page: str | None, field: Field | None) -> str:
    found = blocks(page)
    keep = field.decode(found) if field else [False] * len(found)
    return " ".join(b.text for b, own in zip(found, keep) if own)


def extract(pages: DataFrame, field: Field | None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row: the blocks decoded as main text, joined by one space.

    A null or empty page has an empty text and no characters. Repeated rows give a row each. Only ``page_id``, ``url``
    and ``html`` are read, the page as a whole.
    """
    sent = pages.sparkSession.sparkContext.broadcast(field)

    def extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h, sent.value) for h in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    kind = dict(pages.dtypes)["page_id"]
    out = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    return out.mapInPandas(extracted, f"page_id {kind}, url string, text string, n_chars bigint")
