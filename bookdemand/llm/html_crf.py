"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its text blocks, each with features of its ancestors'
tags, classes and ids and of its text.  The field scores every block and every pair of
neighbouring labels; it is trained by gradient steps on the log-likelihood of labelled
pages and decoded by Viterbi.  Blocks labelled as article are the main text.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import Shared

# Element names of HTML.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody
td textarea tfoot th thead title tr ul""".split())
HIDDEN = frozenset("script style noscript template iframe svg object".split())
SPACES = frozenset("br wbr img input td th".split())
KEEPS_P = frozenset("html head body title option select button textarea".split())  # these do not end an open paragraph
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol menu dl table select tbody thead tfoot".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
VALUE_OR_END = re.compile(r"=\s*([\"'])|>")
DEEPEST = 512  # elements open at once; deeper ones take the place of the last
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SENTENCE_END = re.compile(r"[.!?…][\"'”»)]?(?:\s|$)")


@dataclass
class Block:
    text: str
    ancestors: tuple[str, ...]  # tags from the root down
    names: frozenset[str]  # words of the ancestors' classes, ids and roles
    linked: int  # characters inside links


def tag_end(page: str, at: int) -> int | None:
    """Where the tag that is open at ``at`` ends; a > in a quoted value does not end it."""
    while m := VALUE_OR_END.search(page, at):
        if not m[1]:
            return m.end()
        close = page.find(m[1], m.end())
        at = close + 1 if close >= 0 else m.end()
    return None


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order: character references decoded, runs of white space
    one space, trimmed, empty ones left out.  Scripts, styles, comments and markup go.
    A page that ends inside a tag ends before it."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    text: list[str] = []
    linked, in_link, at = 0, False, 0

    def flush() -> None:
        nonlocal linked, in_link
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, tuple(t for t, _ in stack), stack[-1][1] if stack else frozenset(), linked))
            text.clear()
        linked, in_link = 0, False

    def add(part: str) -> None:
        nonlocal linked
        if part:
            text.append(part)
            linked += len(part) * in_link

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing, inside = m[2].lower(), bool(m[1]), at
        end = tag_end(page, at)
        if end is None:
            break  # the page ends inside a tag
        at = end
        attributes = page[inside:end - 1]
        if tag in HIDDEN:
            if not closing and not attributes.endswith("/"):
                last = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                at = last.end() if last else len(page)
            continue
        if tag == "a":
            in_link = not closing
        if tag in SPACES:
            add(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                del stack[depth:]
            continue
        if tag not in KEEPS_P and stack and stack[-1][0] == "p":
            stack.pop()
        if tag == "body" and stack and stack[-1][0] == "head":
            stack.pop()
        same = SIBLINGS.get(tag, ())
        for k in range(len(stack) - 1, -1, -1) if same else ():
            if stack[k][0] in same:
                del stack[k:]
                break
            if stack[k][0] in LISTS:
                break
        if tag == "hr":
            continue
        names = stack[-1][1] if stack else frozenset()
        if attributes:
            found = set()
            for key, value in ATTRIBUTE.findall(attributes):
                if key.lower() in ("hidden", "aria-hidden"):
                    found |= {"hidden"} if value.strip("\"'").lower() != "false" else set()
                else:
                    found.update(NAME.findall(CAMEL.sub("-", value).lower()))
            names = names | found if found else names
        if len(stack) >= DEEPEST:
            stack.pop()
        stack.append((tag, names))
    flush()
    return out


def block_features(block: Block, place: float) -> list[str]:
    words, size = block.text.count(" ") + 1, len(block.text)
    tags = block.ancestors
    out = ["a:" + t for t in set(tags) - {"html", "body", "div"}]
    out += ["n:" + n for n in block.names]
    out.append("tag:" + (tags[-1] if tags else ""))
    out.append("in:" + ">".join([t for t in tags if t not in ("html", "body", "div")][-2:]))
    out.append(f"words:{min(6, int(math.log2(words)))}")
    out.append(f"links:{min(4, 4 * block.linked // max(1, size))}")
    ends = len(SENTENCE_END.findall(block.text))
    out.append(f"ends:{min(3, ends)}")
    if ends and words >= 8 and 2 * block.linked < size:
        out.append("prose")
    if "©" in block.text or "copyright" in block.text.lower():
        out.append("copyright")
    if place < 0.15:
        out.append("early")
    elif place > 0.85:
        out.append("late")
    return out


@dataclass
class Field:
    weights: dict[str, float] = field(default_factory=dict)  # for the label article
    start: float = 0.0
    pair: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])  # [label][next label]

    def unary(self, features: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in row]) for row in features]

    def viterbi(self, unary: list[float]) -> list[int]:
        """The best labelling; of equal ones that with fewer article blocks."""
        if not unary:
            return []
        off, on = 0.0, unary[0] + self.start
        back = []
        p = self.pair
        for u in unary[1:]:
            from_off, from_on = (off + p[0][0], on + p[1][0]), (off + p[0][1], on + p[1][1])
            back.append((from_off[1] > from_off[0], from_on[1] > from_on[0]))
            off, on = max(from_off), max(from_on) + u
        label = int(on > off)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]

    def expected(self, unary: list[float]) -> tuple[list[float], list[list[float]]]:
        """Probability of label article for each block, and expected counts of label pairs."""
        n, p = len(unary), self.pair
        forward = [(0.0, unary[0] + self.start)]
        for u in unary[1:]:
            a, b = forward[-1]
            forward.append((_sum(a + p[0][0], b + p[1][0]), _sum(a + p[0][1], b + p[1][1]) + u))
        backward = [(0.0, 0.0)] * n
        for k in range(n - 2, -1, -1):
            a, b = backward[k + 1]
            backward[k] = (_sum(p[0][0] + a, p[0][1] + unary[k + 1] + b), _sum(p[1][0] + a, p[1][1] + unary[k + 1] + b))
        whole = _sum(*forward[-1])
        on = [math.exp(f[1] + b[1] - whole) for f, b in zip(forward, backward)]
        pairs = [[0.0, 0.0], [0.0, 0.0]]
        for k in range(n - 1):
            for x in (0, 1):
                for y in (0, 1):
                    pairs[x][y] += math.exp(forward[k][x] + p[x][y] + y * unary[k + 1] + backward[k + 1][y] - whole)
        return on, pairs


def _sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high)) if low - high > -700 else high


def page_features(found: list[Block]) -> list[list[str]]:
    return [block_features(b, k / len(found)) for k, b in enumerate(found)]


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = 6, rate: float = 0.4, decay: float = 1e-4, seed: int = 3) -> Field:
    """Steps on the log-likelihood of labelled block sequences, each weight's step falling
    with the squares of its gradients so far (AdaGrad)."""
    crf, rng = Field(), random.Random(seed)
    rows = [(page_features(b), y) for b, y in pages if b]
    spent: dict = {}

    def step(key, gradient: float) -> float:
        spent[key] = spent.get(key, 1.0) + gradient * gradient
        return rate * gradient / math.sqrt(spent[key])

    for _ in range(epochs):
        rng.shuffle(rows)
        for features, labels in rows:
            on, pairs = crf.expected(crf.unary(features))
            gradients: dict[str, float] = {}
            for row, p, y in zip(features, on, labels):
                if abs(y - p) > 1e-5:
                    for f in row:
                        gradients[f] = gradients.get(f, 0.0) + y - p
            for f, g in gradients.items():
                old = crf.weights.get(f, 0.0)
                crf.weights[f] = old + step(f, g - decay * old)
            crf.start += step("start", labels[0] - on[0])
            seen = [[0, 0], [0, 0]]
            for a, b in zip(labels, labels[1:]):
                seen[a][b] += 1
            for a in (0, 1):
                for b in (0, 1):
                    crf.pair[a][b] += step((a, b), seen[a][b] - pairs[a][b])
    return crf


# ---------------------------------------------------------------- labelled pages

MARK = "⁠"  # stands before the text of article blocks in a labelled page


def labelled_page(seed: int) -> tuple[list[Block], list[int]]:
    """A page put together from common layouts, its blocks labelled by how they were made."""
    r = random.Random(seed)
    syllables = r.sample("an be chi do el fo ga hu il jo ka li mo nu or pe qua ri so te un ve wi xo ya zu ment tion".split(), 14)

    def word() -> str:
        return "".join(r.choice(syllables) for _ in range(r.choice((1, 1, 2, 2, 3))))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(r.randint(low, high))).capitalize()

    def prose(low: int = 1, high: int = 6) -> str:
        return " ".join(words(2, 18) + r.choice("....?!") for _ in range(r.randint(low, high)))

    def link(text: str) -> str:
        return f'<a href="/{word()}">{text}</a>'

    def named(tag: str, *names: str) -> str:
        name = r.choice(names)
        return f'<{tag} {r.choice(("class", "id"))}="{name}{r.choice(("", "", "-" + word(), " " + word()))}">'

    def menu() -> str:
        items = "".join(f"<li>{link(words(1, 3))}</li>" for _ in range(r.randint(3, 8)))
        tag = r.choice(("nav", "nav", "div"))
        head = "<nav>" if tag == "nav" else named("div", "menu", "navigation", "nav", "navbar", "breadcrumb", "topnav")
        return f"{head}<ul>{items}</ul></{tag}>"

    def head() -> str:
        tag = r.choice(("header", "div"))
        inner = f"<p>{words(1, 5)}</p>" + r.choice(("", menu(), f"<h2>{words(1, 3)}</h2>", f"<span>{words(2, 6)}</span>"))
        return (f"<{tag}>" if tag == "header" else named("div", "header", "masthead", "banner", "topbar")) + inner + f"</{tag}>"

    def aside() -> str:
        tag = r.choice(("aside", "aside", "div", "section"))
        start = f"<{tag}>" if tag == "aside" and r.random() < 0.6 else named(tag, "sidebar", "related", "widget", "popular", "recommended", "trending")
        inner = r.choice((f"<ul>{''.join(f'<li>{link(words(2, 8))}</li>' for _ in range(r.randint(2, 6)))}</ul>", f"<p>{prose(1, 2)}</p>", f"<p>{link(words(3, 9))}</p><p>{prose(1, 1)}</p>"))
        return f"{start}<h3>{words(1, 3)}</h3>{inner}</{tag}>"

    def notice() -> str:
        return r.choice((named("div", "cookie", "notice", "consent", "alert", "gdpr", "cookies", "warning", "message"), '<div role="alert">', named("section", "notice", "cookie-banner"),
                         named("div", "newsletter", "subscribe", "paywall", "promo"))) + f"<p>{prose(1, 3)}</p><button>{words(1, 2)}</button></div>"

    def advert() -> str:
        return named("div", "ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "banner") + r.choice((prose(1, 2), f"<p>{prose(1, 2)}</p>", link(words(2, 7)))) + "</div>"

    def form() -> str:
        return f"<form><label>{words(1, 3)}</label><input name=q><p>{prose(1, 1)}</p><select><option>{word()}<option>{word()}</select><textarea>{words(0, 4)}</textarea><button>{word()}</button></form>"

    def comments() -> str:
        tag = r.choice(("section", "div", "ol"))
        one = "li" if tag == "ol" else r.choice(("div", "article", "p"))
        body = "".join((f"<{one}>" if r.random() < 0.4 else named(one, "comment", "reply", "response")) + r.choice((f"<b>{word()}</b> ", "")) + (f"<p>{prose(1, 3)}</p>" if one != "p" and r.random() < 0.6 else prose(1, 3)) + f"</{one}>" for _ in range(r.randint(1, 6)))
        return named(tag, "comments", "commentlist", "discussion", "responses", "respond") + r.choice(("", f"<h2>{words(1, 2)}</h2>", f"<h3>{words(1, 2)}</h3>")) + body + r.choice(("", form())) + f"</{tag}>"

    def foot() -> str:
        tag = r.choice(("footer", "footer", "div"))
        start = "<footer>" if tag == "footer" else named("div", "footer", "bottom", "copyright")
        inner = r.choice((f"&copy; {word()}.example &middot; {prose(1, 2)}", f"<p>&copy; 2020 {words(1, 4)}</p>", f"<p>{prose(1, 2)}</p>", f"<ul><li>{link(word())}<li>{link(word())}</ul><p>Copyright {words(1, 3)}</p>"))
        return start + inner + f"</{tag}>"

    def tools() -> str:
        return r.choice((named("div", "share", "social", "tags", "meta", "byline", "author") + link(word()) + " " + link(word()) + "</div>", advert(), f"<nav><p>{link(words(1, 4))}</p></nav>"))

    def piece() -> str:
        kind = r.random()
        m = MARK
        if kind < 0.62:
            return f"<p>{m}{r.choice(('', '', '<b>', '<i>'))}{prose()}{r.choice(('</p>', '</p>', '<br>', ''))}"
        if kind < 0.72:
            return f"<p>{m}{words(1, 6)}{r.choice(('.', ''))}</p>"
        if kind < 0.79:
            return f"<h2>{m}{words(1, 7)}</h2>"
        if kind < 0.85:
            items = "".join(f"<li>{m}{prose(1, 1)}" for _ in range(r.randint(2, 5)))
            return f"<ul>{items}</ul>"
        if kind < 0.89:
            return f"<blockquote><p>{m}{prose(1, 2)}</p></blockquote>"
        if kind < 0.92:
            return f"<table><tr><td>{m}{words(1, 4)}</td><td>{m}{words(1, 3)}</td></tr></table>"
        if kind < 0.95:
            return f"<pre>{m}{words(3, 12)}</pre>"
        return f"<p>{m}{words(2, 6)} {link(words(1, 3))} {prose(1, 2)}</p>"

    body = [piece() for _ in range(r.choice((1, 2, 3, 5, 8, 12, 20)))]
    for extra, chance in ((tools, 0.3), (advert, 0.15), (aside, 0.1), (notice, 0.1)):
        if r.random() < chance:
            body.insert(r.randint(0, len(body)), extra())
    title = f"<h1>{MARK}{words(2, 10)}{r.choice(('', '.'))}</h1>" if r.random() < 0.85 else ""
    inside = title + "".join(body) + (comments() if r.random() < 0.12 else "")
    wrap = r.choice((("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                     (named("div", "content", "post", "entry", "article", "story", "main", "text", "post-body"), "</div>"), ("<div>", "</div>"),
                     (named("section", "content", "article-body", "entry"), "</section>"), ("", "")))
    before = [f() for f, chance in ((head, 0.4), (menu, 0.75), (notice, 0.25), (advert, 0.4), (aside, 0.1), (form, 0.15)) if r.random() < chance]
    after = [f() for f, chance in ((tools, 0.15), (comments, 0.3), (aside, 0.35), (form, 0.2), (advert, 0.15), (notice, 0.1), (foot, 0.85), (notice, 0.1)) if r.random() < chance]
    if r.random() < 0.5:
        r.shuffle(before)
    page = f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body>{''.join(before)}{wrap[0]}{inside}{wrap[1]}{''.join(after)}"
    found = blocks(page)
    labels = [int(MARK in b.text) for b in found]
    for b in found:
        b.text = b.text.replace(MARK, "")
    return found, labels


def default_field(pages: int = 1500, seed: int = 1) -> Field:
    """A field trained on ``pages`` labelled pages of common layouts."""
    return train([labelled_page(1000 * seed + k) for k in range(pages)])


# ---------------------------------------------------------------- extraction

def main_text(page: str | None, crf: Field) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, y in zip(found, crf.viterbi(crf.unary(page_features(found)))) if y)


def extract(pages: DataFrame, crf: Field) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``: the article's blocks in page
    order, joined by an empty line, and the number of code points.

    Null and empty html, and pages without article blocks, give an empty text.  Rows with
    null ids or urls and repeated rows come out as they came in; other columns are not read.
    """
    shared = Shared(pages.sparkSession, crf)  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), shared.value) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
