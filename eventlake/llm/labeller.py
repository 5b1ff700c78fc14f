"""A bidirectional LSTM in numpy that labels the blocks of a page, and its training.

The input of a block is a vector of hashed steps of its tag path, hashed words and a few measures. One
LSTM reads the blocks of a document forwards, one backwards, so each label sees the whole document.
"""

from __future__ import annotations

import io
import math
import zlib
from dataclasses import dataclass
from random import Random

import numpy as np

from eventlake.llm.blocks import Block, Path, blocks_of

PATH_SIZE, WORD_SIZE, MEASURES = 384, 64, 8
INPUT = PATH_SIZE + WORD_SIZE + MEASURES


@dataclass(frozen=True)
class LabellerConfig:
    hidden: int = 20
    epochs: int = 10
    batch: int = 32
    rate: float = 0.01
    seed: int = 5
    #: Pages made from templates, per page of the sample.
    made_per_page: int = 3


_buckets: dict[tuple[str, int], int] = {}


def bucket(word: str, size: int) -> int:
    found = _buckets.get((word, size))
    if found is None:
        if len(_buckets) > 500_000:
            _buckets.clear()
        found = _buckets[word, size] = zlib.crc32(word.encode("utf-8", "replace")) % size
    return found


def path_places(before: tuple[int, str], node: Path) -> tuple[int, str]:
    """The hashed steps of a path as the bits of a number, and its last tag."""
    bits, above = before
    tag, *names = node.step.split(" ")
    for name in names:
        bits |= 1 << bucket("." + name, PATH_SIZE)
    return bits | 1 << bucket("<" + tag, PATH_SIZE) | 1 << bucket(above + ">" + tag, PATH_SIZE), tag


def depth(before: int, node: Path) -> int:
    return before + 1


def inputs(blocks: list[Block], low: int = 0, high: int | None = None) -> np.ndarray:
    """One row per block of a page, of those from `low` to `high`."""
    own = blocks[low:high]
    x = np.zeros((len(own), INPUT), np.float32)
    for i, block in enumerate(own):
        row = x[i]
        bits, last = block.way.noted("places", path_places, (0, "^")) if block.way else (0, "^")
        steps = block.way.noted("depth", depth, 0) if block.way else 0
        row[:PATH_SIZE] = np.unpackbits(np.frombuffer(bits.to_bytes(PATH_SIZE // 8, "little"), np.uint8), bitorder="little")
        row[bucket("leaf " + last, PATH_SIZE)] = 1
        words = block.text.split(" ")
        hits = np.fromiter((bucket(w, WORD_SIZE) for w in words), np.int64, len(words))
        row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.bincount(hits, minlength=WORD_SIZE) / math.sqrt(len(words)) / 4
        size = len(block.text)
        row[PATH_SIZE + WORD_SIZE :] = (
            math.log1p(size) / 8, math.log1p(len(words)) / 6, block.linked, block.text[-1] in ".!?", (low + i) / len(blocks),
            block.text.count(".") / (len(words) + 1), steps / 10, 1,
        )
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Weights and passes. Sequences of a batch are padded at the end; `mask` is 1 where a block is."""

    NAMES = ("wf", "uf", "wb", "ub", "vo", "bo")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, cfg: LabellerConfig) -> Labeller:
        rng, h = np.random.default_rng(cfg.seed), cfg.hidden
        w = {n: rng.normal(0, 0.08, (INPUT, 4 * h)) for n in ("wf", "wb")} | {n: rng.normal(0, 0.15, (h, 4 * h)) for n in ("uf", "ub")}
        for n in ("wf", "wb"):
            w[n][-1, h : 2 * h] += 1  # an open forget gate; the last input is always 1
        w |= {"vo": rng.normal(0, 0.2, (2 * h, 1)), "bo": np.zeros(1)}
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.weights)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Labeller:
        with np.load(io.BytesIO(data)) as stored:
            return cls({n: stored[n] for n in cls.NAMES})

    def _run(
        self, x: np.ndarray, mask: np.ndarray, w: str, u: str, order: range, state: tuple | None = None, trace: list | None = None
    ) -> tuple[np.ndarray, tuple]:
        """The output of each step and the last state; `trace` takes what the gradients need."""
        n, steps, _ = x.shape
        size = self.weights[u].shape[0]
        z = x @ self.weights[w]
        h, c = state or (np.zeros((n, size), np.float32), np.zeros((n, size), np.float32))
        out = np.zeros((n, steps, size), np.float32)
        for t in order:
            g = z[:, t] + h @ self.weights[u]
            i, f, o = sigmoid(g[:, :size]), sigmoid(g[:, size : 2 * size]), sigmoid(g[:, 2 * size : 3 * size])
            a, m = np.tanh(g[:, 3 * size :]), mask[:, t, None]
            new = f * c + i * a
            th = np.tanh(new)
            if trace is not None:
                trace.append((t, h, c, i, f, o, a, th, m))
            # Padding hands the state on unchanged, so the backward reader starts at the true end.
            h, c = m * o * th + (1 - m) * h, m * new + (1 - m) * c
            out[:, t] = h
        return out, (h, c)

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        steps = x.shape[1]
        forward, _ = self._run(x, mask, "wf", "uf", range(steps))
        backward, _ = self._run(x, mask, "wb", "ub", range(steps - 1, -1, -1))
        return (np.concatenate([forward, backward], 2) @ self.weights["vo"])[:, :, 0] + self.weights["bo"]

    def long_scores(self, blocks: list[Block], slice_: int) -> np.ndarray:
        """`scores` of one page, in slices: one reader after the other hands its state from slice to slice, and only a number per block is kept."""
        size = self.weights["uf"].shape[0]
        out = np.full(len(blocks), self.weights["bo"][0], np.float32)
        lows = list(range(0, len(blocks), slice_))
        for name, rows, order in (("f", self.weights["vo"][:size], lows), ("b", self.weights["vo"][size:], lows[::-1])):
            state = None
            for low in order:
                x = inputs(blocks, low, low + slice_)[None]
                steps = range(x.shape[1])
                hidden, state = self._run(x, np.ones(x.shape[:2], np.float32), "w" + name, "u" + name, steps if name == "f" else steps[::-1], state)
                out[low : low + x.shape[1]] += (hidden[0] @ rows)[:, 0]
        return out

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        steps, w = x.shape[1], self.weights
        kept_f, kept_b = [], []
        forward, _ = self._run(x, mask, "wf", "uf", range(steps), trace=kept_f)
        backward, _ = self._run(x, mask, "wb", "ub", range(steps - 1, -1, -1), trace=kept_b)
        both = np.concatenate([forward, backward], 2)
        d = ((sigmoid((both @ w["vo"])[:, :, 0] + w["bo"]) - y) * mask / mask.sum())[:, :, None].astype(np.float32)
        size = w["uf"].shape[0]
        out = {"vo": (both * d).sum((0, 1))[:, None], "bo": d.sum(keepdims=False).reshape(1)}
        dh = d @ w["vo"].T
        for name, kept, part in (("f", kept_f, dh[:, :, :size]), ("b", kept_b, dh[:, :, size:])):
            u = w["u" + name]
            dz, du = np.zeros((*x.shape[:2], 4 * size), np.float32), np.zeros_like(u)
            back_h, back_c = np.zeros((len(x), size), np.float32), np.zeros((len(x), size), np.float32)
            for t, h, c, i, f, o, a, th, m in reversed(kept):
                g = part[:, t] + back_h
                dc = m * (g * o * (1 - th * th) + back_c)
                dg = np.concatenate([dc * a * i * (1 - i), dc * c * f * (1 - f), m * g * th * o * (1 - o), dc * i * (1 - a * a)], 1)
                dz[:, t] = dg
                du += h.T @ dg
                back_h = dg @ u.T + (1 - m) * g
                back_c = dc * f + (1 - m) * back_c
            out["w" + name] = np.tensordot(x, dz, ([0, 1], [0, 1]))
            out["u" + name] = du
        return out

    def label(self, pages: list[list[Block]], budget: int = 60_000, slice_: int = 4_096) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length are read together, `budget` blocks at a time, and longer ones than `slice_`
        alone, in slices."""
        answers: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        low = 0
        while low < len(order):
            if len(pages[order[low]]) > slice_:
                answers[order[low]] = self.long_scores(pages[order[low]], slice_) > 0
                low += 1
                continue
            high = low + 1
            while high < len(order) and len(pages[order[high]]) <= slice_ and (high + 1 - low) * len(pages[order[high]]) <= budget:
                high += 1
            own = order[low:high]
            x, mask = padded([inputs(pages[i]) for i in own])
            for i, row in zip(own, self.scores(x, mask)):
                answers[i] = row[: len(pages[i])] > 0
            low = high
        return answers


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((len(rows), steps, INPUT), np.float32), np.zeros((len(rows), steps), np.float32)
    for i, row in enumerate(rows):
        x[i, : len(row)], mask[i, : len(row)] = row, 1
    return x, mask


MAIN = ("article", "main")
#: Names of elements and classes beside the main text (the teacher's rule and the names of the templates).
ASIDE = {
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs toc", "header": "header masthead banner topbar head",
    "footer": "footer bottom copyright legal colophon", "aside": "aside sidebar widget related recommended trending",
    "notice": "cookie consent notice gdpr alert popup modal", "ad": "ad ads advert advertisement sponsor sponsored promo promoted",
    "form": "form subscribe newsletter signup login search", "comments": "comment comments reply replies discussion respond disqus",
    "share": "share social follow tags meta byline",
}
ASIDE_NAMES = frozenset(" ".join(ASIDE.values()).split())
#: Elements beside the main text; these count as tags only, not as words of a class.
ASIDE_TAGS = frozenset("nav menu header head footer aside form search title button select option label noscript iframe meta".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT_NAMES = (
    "content", "post", "entry", "story", "body", "text", "article-body", "post-content", "entry-content", "main-content", "page-content", "story-body",
)


def teacher(block: Block) -> bool | None:
    """The label of a block of a page that says where its main text is; None where it doesn't.

    Names of a `main` and of the outermost `article` say what is in them (has-comments), not that they stand beside;
    an article in an article (a comment) is judged by its names. The words title and meta of a heading say nothing.
    """
    main, aside, _ = block.way.noted("teacher", said, (False, False, False)) if block.way else (False, False, False)
    return not aside if main else False if aside else None


def said(before: tuple[bool, bool, bool], node: Path) -> tuple[bool, bool, bool]:
    """Whether a path has led into main text, beside it, and into an article."""
    main, aside, article = before
    tag, *names = node.step.split(" ")
    main = main or tag in MAIN or not set(MAIN).isdisjoint(names)
    found = ASIDE_NAMES.intersection(names)
    if tag == "main" or (tag == "article" and not article):
        found = frozenset()
    elif tag in HEADINGS and main:
        found -= {"meta"}
    return main, aside or bool(found) or tag in ASIDE_TAGS, article or tag == "article"


def bare(blocks: list[Block]) -> list[Block]:
    """The blocks of a page as if it did not say where its main text is: no names, and plain elements for `article` and `main`."""

    def plain(above: Path | None, node: Path) -> Path:
        tag = node.step.split(" ")[0]
        return Path(above, "div" if tag in MAIN else tag)

    return [Block(b.text, b.way.noted("bare", plain, None) if b.way else None, b.linked) for b in blocks]


def made_page(rng: Random, main: list[str], rest: list[str]) -> tuple[list[Block], list[bool]]:
    """A page in a random layout: main texts in one container, others around and inside it."""
    out: list[str] = []
    marks: list[tuple[str, bool]] = []

    def text(words: str, label: bool) -> str:
        marks.append((words, label))
        return words.replace("&", "&amp;").replace("<", "&lt;")

    def some(low: int, high: int) -> list[str]:
        """Texts of other pages, cut to the length that parts beside the main text have."""
        cut = []
        for t in rng.choices(rest, k=rng.randint(low, high)):
            words = t.split(" ")
            start = rng.randrange(len(words))
            cut.append(" ".join(words[start : start + rng.choice((1, 1, 2, 3, 5, 8, 15, 30, 60))]))
        return cut

    def beside(kind: str) -> str:
        names = ASIDE[kind].split()
        name = rng.choice(names)
        tag = kind if kind in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.6 else rng.choice(("div", "section", "div", "ul"))
        attribute = rng.choice((f' class="{name}"', f' id="{name}"', f' class="{name} {rng.choice(names)}-{rng.choice(("box", "list", "wrap", "x"))}"'))
        if tag == kind and rng.random() < 0.6:
            attribute = ""
        if tag == "ul" or kind == "nav":
            inner = "".join(f'<li><a href="/x">{text(t, False)}</a></li>' for t in some(2, 7))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "comments":
            inner = (f"<h3>{text(some(1, 1)[0], False)}</h3>" if rng.random() < 0.5 else "") + "".join(
                f'<div class="{rng.choice(("comment", "reply", "comment-body"))}"><p>{text(t, False)}</p></div>' if rng.random() < 0.6 else f"<p>{text(t, False)}</p>"
                for t in some(1, 5) + rng.choices(rest, k=rng.randint(0, 2))
            )
        elif kind == "form":
            inner = "".join(f"<label>{text(t, False)}</label><input>" for t in some(1, 3)) + f"<button>{text(some(1, 1)[0], False)}</button>"
        else:
            inner = "".join(
                rng.choice(("<p>{}</p>", "<div><a href='#'>{}</a></div>", "<h4>{}</h4>", "<span>{}</span><hr>")).format(text(t, False))
                for t in some(1, 4)
            )
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def body() -> str:
        kept = []
        for i, t in enumerate(main):
            # A text of its own, then perhaps something that doesn't belong to it.
            form = "<h1>{}</h1>" if i == 0 and rng.random() < 0.7 else rng.choice(("<p>{}</p>",) * 8 + ("<p><b>{}</b>", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<div>{}</div>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>"))
            kept.append(form.format(text(t, True)))
            if rng.random() < 0.08:
                kept.append(beside(rng.choice(("ad", "share", "form", "aside", "notice"))))
        return "".join(kept)

    out.append(f"<html><head><title>{text(main[0][:60], False)}</title></head><body>")
    wrapped = rng.random() < 0.4
    out += ["<div class='wrapper'>"] * wrapped
    out += [beside(k) for k in ("notice", "header", "nav", "ad", "form") if rng.random() < 0.5]
    tag, name = rng.choice(("article", "article", "main", "div", "div", "section")), rng.choice(CONTENT_NAMES)
    attribute = f' {rng.choice(("class", "id"))}="{name}"' if tag in ("div", "section") or rng.random() < 0.4 else ""
    outer = rng.choice(("", "", "main", "div"))
    out.append((f"<{outer}>" if outer else "") + f"<{tag}{attribute}>" + body())
    inside = [beside(k) for k in ("share", "comments", "form") if rng.random() < 0.2]
    out += inside + [f"</{tag}>" + (f"</{outer}>" if outer else "")]
    out += [beside(k) for k in ("aside", "comments", "ad", "form", "notice", "footer") if rng.random() < 0.5]
    out.append("</body></html>")
    blocks = blocks_of("".join(out))
    labels, at = [], 0
    for block in blocks:  # every text is one block, in order of the page
        wanted = " ".join(block.text.split())
        found = next((j for j in range(at, len(marks)) if " ".join(marks[j][0].split()) == wanted), None)
        labels.append(marks[found][1] if found is not None else False)
        at = found + 1 if found is not None else at
    return blocks, labels


def train(pages: list[str], cfg: LabellerConfig = LabellerConfig()) -> Labeller:
    """Fits a labeller to pages whose own marks tell their main text, and to pages made from their texts."""
    return train_blocks([blocks_of(p) for p in pages], cfg)


def excerpt(blocks: list[Block], size: int, seed: int) -> list[Block]:
    """The blocks of a page, or of a long one whole blocks up to `size` bytes of text (at least one), in page order.

    They are drawn in runs of 64, the length that training reads; the first run has main text if the page marks any.
    """
    if sum(len(b.text.encode()) for b in blocks) <= size:
        return blocks
    starts = list(range(0, len(blocks), 64))
    Random(seed).shuffle(starts)
    starts.sort(key=lambda low: not any(teacher(b) for b in blocks[low : low + 64]))
    rest = starts[1:]
    Random(seed + 1).shuffle(rest)
    first = next((i for i in range(starts[0], min(starts[0] + 64, len(blocks))) if teacher(blocks[i])), starts[0])
    taken, used = {first}, len(blocks[first].text.encode())
    for low in [starts[0], *rest]:
        for i in range(low, min(low + 64, len(blocks))):
            more = len(blocks[i].text.encode())
            if i not in taken and used + more <= size:
                taken.add(i)
                used += more
    return [blocks[i] for i in sorted(taken)]


def train_blocks(parsed: list[list[Block]], cfg: LabellerConfig = LabellerConfig()) -> Labeller:
    """`train` for pages that are cut into blocks already."""
    rng = Random(cfg.seed)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    mains: list[list[str]] = []
    rest = [b.text for page in parsed for b in page] or ["text"]
    for page in parsed:
        labels = [teacher(b) for b in page]
        if True in labels and None not in labels:
            rows += [(inputs(own), np.array(labels, np.float32)) for own in (page, bare(page))]
            mains.append([b.text for b, own in zip(page, labels) if own])
    mains = mains or [[t] for t in rest]
    for main in mains:
        for _ in range(cfg.made_per_page):
            blocks, labels = made_page(rng, main[: rng.randint(1, 24)], rest)
            rows.append((inputs(blocks), np.array(labels, np.float32)))
    rows = [(x[i : i + 64], y[i : i + 64]) for x, y in rows for i in range(0, len(x), 64)]
    model = Labeller.fresh(cfg)
    first = {n: np.zeros_like(w) for n, w in model.weights.items()}
    second = {n: np.zeros_like(w) for n, w in model.weights.items()}
    step = 0
    for epoch in range(cfg.epochs):
        rng.shuffle(rows)
        batches = [sorted(rows[i : i + cfg.batch * 8], key=lambda r: len(r[0])) for i in range(0, len(rows), cfg.batch * 8)]
        for group in batches:
            for low in range(0, len(group), cfg.batch):
                own = group[low : low + cfg.batch]
                x, mask = padded([r[0] for r in own])
                y = np.zeros(mask.shape, np.float32)
                for i, (_, labels) in enumerate(own):
                    y[i, : len(labels)] = labels
                step += 1
                for n, g in model.gradients(x, mask, y).items():  # Adam
                    first[n] += 0.1 * (g - first[n])
                    second[n] += 0.001 * (g * g - second[n])
                    rate = cfg.rate * 0.5 ** (epoch / 4) * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    model.weights[n] -= (rate * first[n] / (np.sqrt(second[n]) + 1e-8)).astype(np.float32)
    return model
