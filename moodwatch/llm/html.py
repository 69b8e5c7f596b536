"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks of text.  Each block has its tag path (tags, classes and ids
of all open elements), its words and a few numbers.  Hashed embeddings of path and words
and the numbers go into a bidirectional LSTM over the page's blocks, so every block is
judged with the whole page in view.  The blocks judged to be content are the main text.

The network is small and written in numpy.  It is fitted on a bounded sample of pages.  Their
labels come from a teacher: names of elements and classes that say what a block is.  Since
pages of one site look alike, the same texts are also set in other layouts, with the
labels known, and sometimes without telling names, so that the network must go by words,
numbers and neighbours as well.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodwatch.llm.common import arrow_pass

#: pages the network is fitted on, blocks of one page used for it, other layouts of each page
SAMPLE_PAGES, SAMPLE_BLOCKS, LAYOUTS = 300, 64, 5
PATH_BUCKETS, WORD_BUCKETS, WIDTH, HIDDEN, NUMBERS = 512, 2048, 16, 24, 8
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 7
#: pages labelled at once
TOGETHER = 128

# Elements of HTML.
SKIPPED = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "title", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "br"}
#: an opening tag ends an open element of the same kind
SIBLINGS = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}

# Names that say what a block is (the teacher).
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "select", "option", "textarea", "label", "dialog", "menu",
                    "fieldset"}
BOILERPLATE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "sidebar", "side", "widget", "widgets", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
    "footer", "header", "masthead", "topbar", "toolbar", "cookie", "cookies", "consent", "notice", "notices", "gdpr",
    "popup", "modal", "alert", "newsletter", "subscribe", "subscription", "signup", "share", "sharing", "social",
    "related", "recommended", "comment", "comments", "disqus", "reply", "replies", "respond", "login", "search",
    "pagination", "pager", "copyright", "legal", "hidden", "skip"}
CONTENT_NAMES = {"article", "main", "content", "post", "entry", "story", "articlebody", "body"}
NOTICES = ("We use cookies to improve your experience. Accept all", "Wir verwenden Cookies. Alle akzeptieren",
           "Nous utilisons des cookies. Tout accepter", "Usamos cookies. Aceptar todo", "Subscribe to our newsletter",
           "Share on social media", "Log in or sign up to comment", "All rights reserved. Terms of use. Privacy policy",
           "Advertisement", "Read more", "Leave a reply", "Related articles", "Skip to content", "Search this site",
           "Impressum | Datenschutz | Kontakt", "Mentions légales. Plan du site", "Aviso legal. Contacto", "Terms of use", "Home", "Start",
           "© 2024 All rights reserved", "Copyright", "Accept", "Share", "Contact us", "Newsletter bestellen", "À lire aussi", "Mehr zum Thema")
#: short remarks of readers
REMARKS = ("Great news, thanks!", "I was there too.", "Nice.", "Finally!", "I don't agree with this at all.", "Sehr guter Artikel.", "Das stimmt so nicht.",
           "Merci pour cet article.", "Je ne suis pas d'accord.", "Muy interesante, gracias.", "No estoy de acuerdo.", "First!", "What about the others?")

#: possessive throughout: no part gives characters back, so a page is read in linear time
COMMENT_OR_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>|<[!?/a-zA-Z][^>]*+(?:>|\Z)""", re.S)
#: a block's path holds so many of the outermost and of the innermost open elements
NEAR = 64
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORD = re.compile(r"\w+")


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    links: int  # characters of the text inside links


def _names(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role, each with a dot before it."""
    out = []
    for m in NAMES.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "hidden" or kind == "aria-hidden" and value == "true" or kind == "style" and re.search(r"display\s*:\s*none", value):
            out.append(".hidden")
        elif kind in ("class", "id", "role"):
            out += ["." + w.lower() for w in NAME_PART.findall(value)]
    return tuple(dict.fromkeys(out))


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order.  Comments, scripts, styles and the head are left out;
    character references are decoded, white space is one blank.  Broken markup is read as far
    as it goes: an element that is never closed ends with the page or with its parent."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    still_open: Counter[str] = Counter()
    parts: list[str] = []
    linked, links, at = 0, 0, 0
    path: tuple[str, ...] | None = None

    def close() -> None:
        nonlocal links, path
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(path or (), text, links))
        parts.clear()
        links, path = 0, None

    def add(raw: str) -> None:
        nonlocal links, path
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if path is None and not text.isspace():
            shown = stack if len(stack) <= 2 * NEAR else stack[:NEAR] + stack[-NEAR:]
            path = tuple(n for name, more in shown for n in (name, *more))
        if linked:
            links += len(text)

    def cut(k: int) -> None:
        """Close the open elements from number k on."""
        nonlocal linked
        for name, _ in stack[k:]:
            still_open[name] -= 1
            linked -= name == "a"
        del stack[k:]

    while (m := COMMENT_OR_TAG.search(page, at)) is not None:  # from behind a script's end, whatever stands in it
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            close()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1) if still_open[name] else ():
                if stack[k][0] == name:
                    cut(k)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        if name in SKIPPED:
            if name == "head":
                continue
            end = re.compile(f"</{re.escape(name)}\\b", re.I).search(page, at)
            if end is None:
                at = len(page)
                break
            at = end.start()
            continue
        if name in SIBLINGS or name == "a":
            # an open one of the same kind ends here, unless a container began since
            for k in range(len(stack) - 1, -1, -1) if still_open[name] else ():
                if stack[k][0] == name:
                    cut(k)
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "blockquote", "select"):
                    break
        stack.append((name, _names(m[3])))
        still_open[name] += 1
        linked += name == "a"
    if at < len(page):
        add(page[at:])
    close()
    return out


def teach(page: list[Block]) -> np.ndarray:
    """The teacher's labels (1: content)."""
    def inside(b: Block, tags: set[str], names: set[str]) -> bool:
        return any(p in tags or p[0] == "." and p[1:] in names for p in b.path)

    bad = [inside(b, BOILERPLATE_TAGS, BOILERPLATE_NAMES) or b.path[-3:-1] == ("body", "header") or
           "header" in b.path and "article" not in b.path for b in page]
    good = [inside(b, {"article", "main"}, CONTENT_NAMES) for b in page]
    if not any(g and not x for g, x in zip(good, bad, strict=True)):
        good = [len(b.text) >= 40 and b.links < len(b.text) / 2 for b in page]
    return np.array([g and not x for g, x in zip(good, bad, strict=True)], np.float32)


def relayout(page: list[Block], labels: np.ndarray, others: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The content of a page in another layout with known labels; ``others``: texts of other pages."""
    def pick(*options: str) -> tuple[str, ...]:
        return tuple(options[rng.integers(len(options))].split())

    content = [b.text for b, y in zip(page, labels, strict=True) if y] or others[:3]
    short = [b.text for b, y in zip(page, labels, strict=True) if not y and len(b.text) < 80]
    kind = rng.random()  # names that tell, names of another language or none
    strange: dict[str, str] = {}
    semantic = ("article", "main", "nav", "aside", "footer", "header", "form", "section")

    def name(path: tuple[str, ...]) -> tuple[str, ...]:
        if kind < 0.45:
            return path
        if kind < 0.7:
            return tuple("div" if p in semantic else p for p in path if p[0] != ".")
        for p in path:
            if p[0] == "." and p not in strange:
                strange[p] = "." + "".join(rng.choice(list("abdefghiklmnoprstuvwz"), int(rng.integers(2, 12))))
        return tuple(strange.get(p, "div" if p in semantic and kind > 0.85 else p) for p in path)

    def some(source: list[str], low: int, high: int) -> list[str]:
        # where no name tells, what isn't content is short, as nothing else would tell it
        found = [source[rng.integers(len(source))] for _ in range(int(rng.integers(low, high)))] if source else []
        return found if kind < 0.45 else [t[:int(rng.integers(15, 90))] for t in found]

    out: list[tuple[Block, int]] = []
    base = ("html", "body") + pick("", "", "div", "div .page", "div .wrapper .container", "div div", "table tr td")

    def put(path: tuple[str, ...], text: str, label: int, links: int = 0) -> None:
        out.append((Block(base + name(path), text, links), label))

    def menu(path: tuple[str, ...], texts: list[str]) -> None:
        for t in texts:
            put(path + pick("ul li a", "a", "div a", "ol li a"), t, 0, len(t))

    def notice(path: tuple[str, ...]) -> None:
        put(path + pick("p", "div", "span", "button"), NOTICES[rng.integers(len(NOTICES))], 0)

    if rng.random() < 0.5:
        notice(pick("div .cookie .notice", "div .consent .banner", "div .gdpr", "section .notice", "div .popup"))
    if rng.random() < 0.8:
        put(pick("header", "div .header", "div .masthead", "header .site .header") + pick("h1 a", "div", "span", "p"), (short or others)[0][:40], 0)
    menu(pick("nav", "div .menu", "div .navbar", "header nav", "div .navigation", "div .breadcrumbs"), some(short or others, 2, 9))
    if rng.random() < 0.4:
        for t in some(others, 1, 4):
            put(pick("aside", "div .sidebar", "div .widget", "div .side") + pick("p", "div", "ul li"), t[:200], 0)
    holder = pick("article", "main article", "div .content", "div .post", "div .entry .content", "main", "div .article .body",
                  "section .story", "div .text", "td", "div .main div .post .body", "table tr td", "div")
    body = pick("p", "p", "p", "div", "")
    for k, t in enumerate(content):
        put(holder + (pick("h1", "h1", "header h1", "h2") if not k and len(t) < 120 else (body if rng.random() < 0.8 else pick("p", "div", "p b", "blockquote p", "blockquote", "ul li", "h2", "pre", "span"))), t, 1)
        if rng.random() < 0.06:
            put(holder + pick("div .ad", "aside", "div .related", "div .promo", "div .share", "div .newsletter"), some([*NOTICES, *others], 1, 2)[0][:150], 0)
    if rng.random() < 0.5:
        for t in some(others if rng.random() < 0.5 else list(REMARKS), 1, 6):
            put(pick("div .comments", "section .comment .list", "div .disqus", "ol .comments li .comment", "div .replies") + pick("p", "div p", "div"), t, 0)
    if rng.random() < 0.3:
        for _ in range(int(rng.integers(1, 4))):
            notice(pick("form", "form .search", "form .login", "div .newsletter form"))
    if rng.random() < 0.4:
        for t in some(others, 1, 5):
            put(pick("aside", "div .sidebar", "div .related", "div .ad", "div .ads", "div .sponsored") + pick("p", "div", "h3", "ul li a"), t[:160], 0)
    for _ in range(int(rng.integers(1, 4))):
        t = some([*NOTICES, *(short or others)], 1, 2)[0]
        put(pick("footer", "div .footer", "footer .site .footer", "div .copyright", "div .legal") + pick("p", "div", "ul li a", ""), t[:160], 0)
    return [b for b, _ in out], np.array([y for _, y in out], np.float32)


_path_buckets: dict[tuple[str, ...], np.ndarray] = {}
_word_buckets: dict[str, int] = {}


class Features(NamedTuple):
    paths: np.ndarray  # buckets of all blocks, one after the other
    path_at: np.ndarray  # where each block's begin
    words: np.ndarray
    word_at: np.ndarray
    numbers: np.ndarray


def features(page: list[Block]) -> Features:
    if len(_path_buckets) > 20_000:
        _path_buckets.clear()
    if len(_word_buckets) > 300_000:
        _word_buckets.clear()
    paths, words, path_at, word_at, numbers = [], [], [0], [0], []
    known = _word_buckets
    for k, b in enumerate(page):
        found = _path_buckets.get(b.path)
        if found is None:
            parts = [*b.path, "/".join(b.path[-2:]), "end:" + (b.path[-1] if b.path else "")]
            found = _path_buckets[b.path] = np.array([crc32(p.encode()) % PATH_BUCKETS for p in parts], np.int32)
        paths.append(found)
        path_at.append(path_at[-1] + len(found))
        own = WORD.findall(b.text.lower()) or [""]
        for w in own:
            if w not in known:
                known[w] = crc32(w.encode()) % WORD_BUCKETS
        words += [known[w] for w in own]
        word_at.append(word_at[-1] + len(own))
        n = len(b.text)
        ends = b.text.count(".") + b.text.count("!") + b.text.count("?")
        numbers.append((np.log1p(n) / 5, min(1, b.links / n), min(1, 10 * b.text.count(",") / n), min(1, 20 * ends / n),
                        b.text[-1] in ".!?", k / len(page), len(b.path) / 10, 1 / (1 + len(page))))
    return Features(np.concatenate(paths) if paths else np.empty(0, np.int32), np.array(path_at), np.array(words, np.int32),
                    np.array(word_at), np.array(numbers, np.float32).reshape(-1, NUMBERS))


Weights = dict[str, np.ndarray]


def _start(rng: np.random.Generator) -> Weights:
    size = 2 * WIDTH + NUMBERS
    w: Weights = {"path": rng.normal(0, 0.3, (PATH_BUCKETS, WIDTH)), "word": rng.normal(0, 0.1, (WORD_BUCKETS, WIDTH)),
                  "out": rng.normal(0, 0.2, (2 * HIDDEN, 1)), "bias": np.zeros(1)}
    for d in "fb":  # forward, backward
        w["x" + d] = rng.normal(0, size ** -0.5, (size, 4 * HIDDEN))
        w["h" + d] = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
        w["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, c0: np.ndarray) -> tuple[np.ndarray, list]:
    """Outputs (batch, steps, HIDDEN), and what the gradient needs of each step."""
    z = x @ wx + c0
    h = c = np.zeros((len(x), HIDDEN), np.float32)
    out, kept = np.empty((*x.shape[:2], HIDDEN), np.float32), []
    for t in range(x.shape[1]):
        a = z[:, t] + h @ wh
        gates, g = _sigmoid(a[:, :3 * HIDDEN]), np.tanh(a[:, 3 * HIDDEN:])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        new = f * c + i * g
        tc = np.tanh(new)
        kept.append((h, c, i, f, o, g, tc))
        h, c = o * tc, new
        out[:, t] = h
    return out, kept


def _lstm_gradient(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, ...]:
    dz = np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
    dwh = np.zeros_like(wh)
    dh = dc = np.zeros((len(x), HIDDEN), np.float32)
    for t in range(x.shape[1] - 1, -1, -1):
        h, c, i, f, o, g, tc = kept[t]
        dh = dh + dout[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz[:, t] = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dwh += h.T @ dz[:, t]
        dh, dc = dz[:, t] @ wh.T, dc * f
    flat = dz.reshape(-1, dz.shape[-1])
    return dz @ wx.T, x.reshape(-1, x.shape[-1]).T @ flat, dwh, flat.sum(axis=0)


def _inputs(w: Weights, page: Features) -> np.ndarray:
    path = np.add.reduceat(w["path"][page.paths], page.path_at[:-1]) / np.diff(page.path_at)[:, None]
    word = np.add.reduceat(w["word"][page.words], page.word_at[:-1]) / np.diff(page.word_at)[:, None]
    return np.concatenate([path, word, page.numbers], axis=1).astype(np.float32)


def _turned(lengths: np.ndarray, steps: int) -> np.ndarray:
    """For each page and step, the step that stands there in the page read backwards."""
    t = np.arange(steps)[None, :]
    return np.where(t < lengths[:, None], lengths[:, None] - 1 - t, t)


def _run(w: Weights, pages: list[Features]) -> tuple:
    lengths = np.array([len(p.numbers) for p in pages])
    steps = int(lengths.max())
    x = np.zeros((len(pages), steps, 2 * WIDTH + NUMBERS), np.float32)
    for k, p in enumerate(pages):
        x[k, :lengths[k]] = _inputs(w, p)
    turn = _turned(lengths, steps)
    back = np.take_along_axis(x, turn[:, :, None], axis=1)
    forward, kept_f = _lstm(x, w["xf"], w["hf"], w["cf"])
    backward, kept_b = _lstm(back, w["xb"], w["hb"], w["cb"])
    both = np.concatenate([forward, np.take_along_axis(backward, turn[:, :, None], axis=1)], axis=2)
    return lengths, x, turn, back, kept_f, kept_b, both, _sigmoid(both @ w["out"] + w["bias"])[:, :, 0]


def _gradient(w: Weights, pages: list[Features], labels: list[np.ndarray]) -> Weights:
    lengths, x, turn, back, kept_f, kept_b, both, p = _run(w, pages)
    d = np.zeros_like(p)
    for k, y in enumerate(labels):
        d[k, :lengths[k]] = p[k, :lengths[k]] - y
    d /= lengths.sum()
    flat = d.reshape(-1, 1)
    grad = {"out": both.reshape(-1, both.shape[-1]).T @ flat, "bias": flat.sum(axis=0)}
    dboth = d[:, :, None] * w["out"][:, 0]
    dx, grad["xf"], grad["hf"], grad["cf"] = _lstm_gradient(x, w["xf"], w["hf"], kept_f, dboth[:, :, :HIDDEN])
    dback = np.take_along_axis(dboth[:, :, HIDDEN:], turn[:, :, None], axis=1)
    dx2, grad["xb"], grad["hb"], grad["cb"] = _lstm_gradient(back, w["xb"], w["hb"], kept_b, dback)
    dx = dx + np.take_along_axis(dx2, turn[:, :, None], axis=1)
    grad["path"], grad["word"] = np.zeros_like(w["path"]), np.zeros_like(w["word"])
    for k, page in enumerate(pages):
        own = dx[k, :lengths[k]]
        for name, buckets, at, part in (("path", page.paths, page.path_at, own[:, :WIDTH]), ("word", page.words, page.word_at, own[:, WIDTH:2 * WIDTH])):
            many = np.diff(at)
            np.add.at(grad[name], buckets, np.repeat(part / many[:, None], many, axis=0))
    return grad


def train(pages: list[str]) -> Weights:
    """Fit the network on raw pages; the same pages in the same order give the same weights."""
    rng = np.random.default_rng(SEED)
    cut = [b[:SAMPLE_BLOCKS] for p in pages if (b := blocks(p))]
    w = _start(rng)
    if not cut:
        return w
    labels = [teach(b) for b in cut]
    texts = [b.text for page, y in zip(cut, labels, strict=True) for b, l in zip(page, y, strict=True) if l] or [b.text for page in cut for b in page]
    seen = [(features(b), y) for b, y in zip(cut, labels, strict=True)]
    for b, y in zip(cut, labels, strict=True):
        for _ in range(LAYOUTS):
            other = [texts[rng.integers(len(texts))] for _ in range(6)]
            made, known = relayout(b, y, other, rng)
            page = features(made[:2 * SAMPLE_BLOCKS])
            if rng.random() < 0.5:  # as if in a language never seen
                page = page._replace(words=rng.integers(0, WORD_BUCKETS, len(page.words), dtype=np.int32))
            seen.append((page, known[:2 * SAMPLE_BLOCKS]))
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(seen))
        # pages of like length go together
        order = np.concatenate([sorted(order[a:a + 8 * BATCH], key=lambda k: len(seen[k][1])) for a in range(0, len(order), 8 * BATCH)]).astype(int)
        for a in range(0, len(order), BATCH):
            some = [seen[k] for k in order[a:a + BATCH]]
            grad = _gradient(w, [p for p, _ in some], [y for _, y in some])
            norm = float(np.sqrt(sum((g * g).sum() for g in grad.values())))
            step += 1
            for k, g in grad.items():
                g = g / max(1.0, norm)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                w[k] = (w[k] - RATE * (1 - epoch / EPOCHS) * move).astype(np.float32)
    return w


def label(w: Weights, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, which of its blocks are content."""
    out: list[np.ndarray] = [np.empty(0, bool)] * len(pages)
    order = [k for k in sorted(range(len(pages)), key=lambda k: len(pages[k])) if pages[k]]
    for a in range(0, len(order), TOGETHER):
        some = order[a:a + TOGETHER]
        lengths, *_, p = _run(w, [features(pages[k]) for k in some])
        for row, k in enumerate(some):
            out[k] = p[row, :lengths[row]] >= 0.5
    return out


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Weights:
    """Fit on the ``SAMPLE_PAGES`` pages that come first by a hash of their id."""
    rows = (pages.where(F.col(html_col).isNotNull())
            .select(F.xxhash64(id_col).alias("h"), F.col(id_col).alias("i"), F.xxhash64(html_col).alias("p"), F.col(html_col).alias("t")))
    # their hashes first: else each task would send so many whole pages
    firsts = rows.select("h", "i", "p").orderBy("h", "i", "p").limit(SAMPLE_PAGES).collect()
    if not firsts:
        return train([])
    last = F.struct(F.lit(firsts[-1].h).alias("h"), F.lit(firsts[-1].p).alias("p"))
    sample = rows.where(F.struct("h", "p") <= last).orderBy("h", "i", "p").limit(SAMPLE_PAGES).collect()
    return train([r.t for r in sample])


def extract(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row: the content blocks, one a line.

    A null page, an empty one and one without content have an empty text; null ids and urls
    stay null; repeated rows are read each."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)  # about 250 kB

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts: list[str] = []
            source = batch.column(2)
            for a in range(0, batch.num_rows, 4 * TOGETHER):
                cut = [blocks(p) for p in source.slice(a, 4 * TOGETHER).to_pylist()]
                texts += ["\n".join(b.text for b, y in zip(page, keep, strict=True) if y)
                          for page, keep in zip(cut, label(shared.value, cut), strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

        return work

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return arrow_pass(rows, ["page_id", "url", "html"], "page_id long, url string, text string, n_chars long", make)
