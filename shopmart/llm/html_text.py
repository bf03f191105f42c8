"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks: runs of text between the starts and ends of block
elements. Each block is main text or not; features are the tags and the class and
id words of its ancestors, its own element, and its text (length, links, end,
digits, telling words). The two-state chain is trained by maximum likelihood and
pages are decoded by Viterbi.

Labelled pages for training: the layouts below, in which main blocks are marked,
and at most ``sample`` pages of the table itself that say by an ``article`` or
``main`` element where their main text is (those of the smallest hash of their
id, at most MAX_TRAINING_HTML characters long). Extraction looks at whole pages.

Defined cases: null or empty pages have empty text and 0 characters; elements
that are not closed end with their parent; a tag that is cut off at the end of
the page is markup; of a hidden element (HIDDEN) that is not closed only its own
text is left out, not the elements after it; a self-closed ``svg`` is empty;
script, style, iframe and textarea that are not closed run to the end of the
page; character references that are cut off stay as they are; a
``br`` is white space; blocks without text are left out; without pages to learn
from only the layouts count; repeated rows get equal results; columns other than
id and html are not looked at.
"""

from __future__ import annotations

import html as html_entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import slices, table, texts

SAMPLE = 200
MAX_TRAINING_HTML = 100_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|iframe|textarea)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>\"'=<]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role|data-main)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What is in these is not text of the page.
HIDDEN = frozenset("noscript template svg select button".split())
#: Within these the text of these elements belongs to them too.
_PARTS = frozenset("option optgroup title desc text tspan g".split())
#: An open element of the key ends where one of these starts.
_ENDS = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
_SPACE = re.compile(r"\s+")
_TELLING = re.compile(r"(?i)\b(cookies?|copyright|subscribe|newsletter|comments?|reply|sign in|log ?in|advert\w*|sponsored|share|privacy|terms|menu|search|related)\b|©|&copy;")


class Block:
    __slots__ = ("path", "text", "linked", "main")

    def __init__(self, path: tuple[str, ...], text: str, linked: float, main: bool) -> None:
        self.path, self.text, self.linked, self.main = path, text, linked, main


def leaf_blocks(page: str) -> list[Block]:
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []  # element, what it says of its content
    parts: list[str] = []
    links = linked = 0
    # Per open hidden element: its place on the stack, the text and links around it, and the blocks before it.
    hidden: list[tuple[int, list[str], int, int, int]] = []

    def flush() -> None:
        nonlocal linked
        if parts and not (hidden and stack and (stack[-1][0] in HIDDEN or stack[-1][0] in _PARTS)):
            text = _SPACE.sub(" ", html_entities.unescape("".join(parts))).strip()
            if text:
                path = tuple(w for _, words in stack for w in words)
                blocks.append(Block(path, text, min(1.0, linked / len(text)), "main:" in path))
        parts.clear()
        linked = 0

    def cut(k: int, closed: bool = False) -> None:
        """End the elements from the k-th on; a hidden one that is closed takes its blocks along."""
        nonlocal parts, links, linked
        links = 0
        while hidden and hidden[-1][0] >= k:
            flush()
            at, parts, linked, outer, mark = hidden.pop()
            del stack[at:]
            if closed and at == k:
                del blocks[mark:]
                links = outer
            else:
                later = blocks[mark:]
                del blocks[mark:]
                flush()
                blocks.extend(later)
        del stack[k:]

    for m in _TOKEN.finditer(page):
        text = m.group("text")
        if text is not None:
            parts.append(text)
            if links:
                linked += len(text.strip())
            continue
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = max(0, links + (-1 if m.group("close") else 1))
        if tag in INLINE or (tag in VOID and tag != "hr"):
            continue
        if tag in HIDDEN and not m.group("close"):
            if tag != "svg" or not m.group("attrs").endswith("/"):
                hidden.append((len(stack), parts, linked, links, len(blocks)))
                stack.append((tag, (f"t:{tag}",)))
                parts, linked = [], 0
            continue
        if tag not in HIDDEN:
            flush()
        if m.group("close"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    cut(k, closed=True)
                    break
            continue
        if tag == "hr":
            continue
        for k in range(len(stack) - 1, -1, -1):
            ends = _ENDS.get(stack[k][0], ())
            if ends is None or tag in ends:
                cut(k)
            if stack and k < len(stack) and stack[k][0] not in _ENDS:
                break
        words = [f"t:{tag}"]
        if m.group("attrs"):
            for name, *values in _ATTR.findall(m.group("attrs")):
                if name.lower() == "data-main":
                    words.append("main:")
                else:
                    words += [f"c:{w}" for w in re.findall(r"[a-z]+", "".join(values).lower())]
        stack.append((tag, tuple(words)))
    flush()
    cut(0)
    flush()
    return blocks


def path_features(path: tuple[str, ...]) -> list[str]:
    """Of the ancestors, and of the block's own element."""
    own = [p for p in path if p != "main:"]
    return [*dict.fromkeys(own), f"own:{next((p for p in reversed(own) if p[0] == 't'), '')}"]


def text_features(block: Block) -> list[str]:
    text, n = block.text, len(block.text)
    found = [f"len:{min(n, 2000).bit_length()}", f"link:{int(block.linked * 4)}"]
    found.append("end:stop" if text[-1] in ".!?:;\"'”»" else "end:none")
    if sum(c.isdigit() for c in text[:200]) * 5 > min(n, 200):
        found.append("digits")
    if _TELLING.search(text[:300]):
        found.append("telling")
    return found


def labelled_layouts(pages: int = 60) -> list[list[Block]]:
    """Pages of several common layouts, with the main blocks marked."""
    r = random.Random(7)
    syllables = "ta ri no mel sa ko ver in an de lu pi or es mar tu".split()

    def words(n: int) -> str:
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))

    def sentence() -> str:
        return words(r.randint(4, 18)).capitalize() + r.choice(".....!?")

    def menu(tag: str) -> str:
        items = "".join(f'<li><a href="/{words(1)}">{words(r.randint(1, 2))}</a></li>' for _ in range(r.randint(3, 8)))
        return f"<{tag}><ul>{items}</ul></{tag.split(' ')[0]}>"

    def body() -> str:
        out = [f"<h1 data-main>{words(5).capitalize()}</h1>"]
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            long = " ".join(sentence() for _ in range(r.randint(1, 6)))
            if kind < 0.7:
                out.append(f"<p data-main>{long}</p>")
            elif kind < 0.8:
                out.append(f"<h2 data-main>{words(3).capitalize()}</h2>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li data-main>{sentence()}</li>" for _ in range(3)) + "</ul>")
            else:
                out.append(f"<blockquote data-main>{long}</blockquote>")
        return "".join(out)

    def noise() -> str:
        return r.choice(
            [
                f'<div class="{r.choice(["ad", "ads", "advert", "sponsored", "promo"])}">{sentence()}</div>',
                f'<div class="{r.choice(["cookie notice", "banner", "popup"])}">We use cookies. {sentence()}</div>',
                f'<aside class="{r.choice(["sidebar", "related", "widget"])}"><h3>{words(2)}</h3>{menu("div")}<p>{sentence()}</p></aside>',
                f"<form><p>Subscribe: {sentence()}</p></form>",
                f'<div class="{r.choice(["share social", "breadcrumb", "tags meta"])}">{words(4)}</div>',
            ]
        )

    def comments() -> str:
        each = "".join(f"<div class=comment><p>{words(1)}</p><p>{sentence()} {sentence()}</p></div>" for _ in range(r.randint(0, 4)))
        return r.choice(["", f'<section class="comments" id="comments"><h3>Comments</h3>{each}</section>'])

    found = []
    for _ in range(pages):
        main = r.choice(["<article>{}</article>", "<main>{}</main>", '<div class="content post">{}</div>', '<div id="main"><div class="entry text">{}</div></div>', "<main><article>{}</article></main>"])
        top = r.choice([menu("nav"), f"<header><h2>{words(2)}</h2>{menu('nav')}</header>", menu('div class="menu"'), f'<div class="header"><p>{words(3)}</p></div>'])
        end = r.choice([f"<footer>&copy; {words(2)}. {sentence()}</footer>", f'<div class="footer"><p>Copyright {sentence()}</p></div>', f"<footer>{menu('div')}</footer>"])
        inside = body() + (noise() if r.random() < 0.3 else "")
        page = f"<html><head><title>{words(4)}</title></head><body>{top}{noise() if r.random() < 0.6 else ''}{main.format(inside)}{noise() if r.random() < 0.5 else ''}{comments()}{end}</body></html>"
        found.append(leaf_blocks(page))
    return found


#: Within the main element these still are not main text.
_OUTSIDE = frozenset("t:nav t:aside t:footer t:form t:header c:ad c:ads c:advert c:comment c:comments c:related c:share c:cookie".split())


def declared(page: str) -> list[Block] | None:
    """Blocks labelled by the page's own article or main element, or None without one."""
    blocks = leaf_blocks(page)
    for b in blocks:
        b.main = ("t:article" in b.path or "t:main" in b.path) and not _OUTSIDE.intersection(b.path)
    return blocks if any(b.main for b in blocks) else None


class Field:
    """Two states: 0 other, 1 main text."""

    def __init__(self) -> None:
        self.weights: dict[str, tuple[float, float]] = {}
        self.turns = np.zeros((2, 2))
        self.first = np.zeros(2)
        self._paths: dict[tuple[str, ...], tuple[float, float]] = {}

    def fit(self, pages: list[list[Block]], steps: int = 120, l2: float = 0.5) -> Field:
        pages = [p for p in pages if p]
        names: dict[str, int] = {}
        rows = [[[names.setdefault(f, len(names)) for f in [*path_features(b.path), *text_features(b)]] for b in p] for p in pages]
        longest, n = max(map(len, pages)), len(pages)
        at = np.array([k * longest + t for k, p in enumerate(rows) for t, fs in enumerate(p) for _ in fs])
        feature = np.array([f for p in rows for fs in p for f in fs])
        used = np.zeros((n, longest), bool)
        gold = np.zeros((n, longest), int)
        for k, p in enumerate(pages):
            used[k, : len(p)] = True
            gold[k, : len(p)] = [b.main for b in p]
        wanted = np.stack([gold == 0, gold == 1], axis=-1) & used[..., None]
        pairs = used[:, 1:]
        wanted_turns = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)])
        size = len(names)
        theta = np.zeros(2 * size + 6)
        first, second = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            w, turns, start = theta[: 2 * size].reshape(size, 2), theta[2 * size : -2].reshape(2, 2), theta[-2:]
            score = np.stack([np.bincount(at, w[feature, s], n * longest).reshape(n, longest) for s in (0, 1)], axis=-1)
            forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            forward[:, 0] = score[:, 0] + start
            for t in range(1, longest):
                new = np.logaddexp(forward[:, t - 1, :1] + turns[0], forward[:, t - 1, 1:] + turns[1]) + score[:, t]
                forward[:, t] = np.where(used[:, t, None], new, forward[:, t - 1])
            for t in range(longest - 2, -1, -1):
                ahead = score[:, t + 1] + backward[:, t + 1]
                new = np.logaddexp(turns[:, 0] + ahead[:, :1], turns[:, 1] + ahead[:, 1:])
                backward[:, t] = np.where(used[:, t + 1, None], new, 0)
            total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
            here = np.exp(forward + backward - total[:, None, None]) * used[..., None]
            both = forward[:, :-1, :, None] + turns + (score + backward)[:, 1:, None, :] - total[:, None, None, None]
            both = np.exp(np.minimum(both, 0)) * pairs[..., None, None]
            miss = (here - wanted).reshape(-1, 2)
            gradient = np.concatenate(
                [
                    np.stack([np.bincount(feature, miss[at, s], size) for s in (0, 1)], axis=-1).ravel(),
                    (both.sum(axis=(0, 1)) - wanted_turns).ravel(),
                    (here[:, 0] - wanted[:, 0]).sum(axis=0),
                ]
            )
            gradient = (gradient + l2 * theta) / n
            first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
            theta = theta - 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        w = theta[: 2 * size].reshape(size, 2)
        self.weights = {name: (float(w[i, 0]), float(w[i, 1])) for name, i in names.items()}
        self.turns, self.first = theta[2 * size : -2].reshape(2, 2), theta[-2:]
        return self

    def _sum(self, features: list[str]) -> tuple[float, float]:
        found = [self.weights[f] for f in features if f in self.weights]
        return sum(f[0] for f in found), sum(f[1] for f in found)

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi."""
        (aa, ab), (ba, bb) = self.turns.tolist()
        a, b = self.first.tolist()
        back = []
        for t, block in enumerate(blocks):
            known = self._paths.get(block.path)
            if known is None:
                if len(self._paths) > 100_000:
                    self._paths.clear()
                known = self._paths[block.path] = self._sum(path_features(block.path))
            x, y = self._sum(text_features(block))
            if t:
                to_a, to_b = b + ba > a + aa, b + bb > a + ab
                back.append((to_a, to_b))
                a, b = (b + ba if to_a else a + aa), (b + bb if to_b else a + ab)
            a, b = a + known[0] + x, b + known[1] + y
        state = b > a
        out = [state]
        for to_a, to_b in reversed(back):
            state = to_b if state else to_a
            out.append(state)
        return out[::-1] if blocks else []

    def extract(self, page: str) -> str:
        blocks = leaf_blocks(page)
        return "\n".join(b.text for b, main in zip(blocks, self.decode(blocks)) if main)


def train(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Field:
    rows = pages.select(F.col(key).cast("string").alias("id"), F.col(html).alias("html"))
    rows = rows.where((F.length("html") <= MAX_TRAINING_HTML) & F.col("html").rlike("(?i)<(?:article|main)[ >]"))
    chosen = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(sample)
    # Ids first, so that pages aren't carried through the choice.
    held = rows.join(F.broadcast(chosen), "id", "left_semi").orderBy("id", "html").limit(sample).collect()
    labelled = [d for d in (declared(r["html"]) for r in held) if d and len(d) <= 400]
    return Field().fit(labelled + labelled_layouts())


def extract(pages: DataFrame, field: Field, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text) of every row."""
    sent = pages.sparkSession.sparkContext.broadcast(field)  # weights of the features of at most SAMPLE pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                found = [sent.value.extract(t) for t in texts(batch, "html")]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(found, pa.string())], ["id", "url", "text"])

    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string")


def op6_html(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = extract(pages, train(pages))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
