"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between the tags of block-level
elements, with the open elements above them. A block's features are its
ancestors (tags, pairs of neighbours, the words of their class and id), its
length, link share, punctuation and place, hashed into one weight vector; a
state says whether the block belongs to the article. Viterbi decodes a page.

The field is trained on labelled pages: pages built by the rules below in many
layouts, each block labelled by the part it was built for, and a bounded sample
of ``max_pages`` pages of the input (in hash order, of ``max_html`` characters
at most), whose blocks are labelled where the markup names the part itself
(``article`` or ``main`` against ``nav``, ``footer``, ``aside``, ``form`` and
the like); other blocks of such pages are not trained on.

Text: character references are decoded, white space inside a block becomes one
space, the article's blocks are joined in page order by two line breaks. What
stands in scripts, styles, templates and the head is no text. An end of input
inside a tag, comment, script or style ends that piece; any other element of
that kind that is never closed is passed over by its opening tag alone. Of more
than ``MAX_DEPTH`` open elements the inner ones are not told apart, so a page's
blocks take room and time in proportion to its length.

Defined cases: a null or empty html gives an empty text; a page without an
article block gives an empty text; repeated rows and null ids are kept row by
row; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as chars
import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import table

DIMS = 1 << 17
MAX_DEPTH = 64

# Elements of HTML by their part in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe svg head title object canvas audio video map".split())
TO_THE_END = frozenset("script style".split())
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option optgroup p pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
#: An opening tag of the key closes an open element of the values, unless one of STOPS lies between.
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "tr td th thead tbody", "thead": "thead", "tfoot": "tr td th tbody"}
CLOSES = {k: frozenset(v.split()) for k, v in CLOSES.items()}
STOPS = frozenset("ul ol dl table select article section main body".split())
#: Opening tags that end an open paragraph.
ENDS_P = BLOCKS - frozenset("button label option optgroup select textarea legend caption tbody td tfoot th thead tr body html".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: list  # (tag, words of class, id and role) of the open elements
    text: str
    linked: int = 0  # characters inside links
    mark: str = ""  # the nearest data-y
    place: float = 0.0
    extra: list = field(default_factory=list)


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order; blocks without text are left out."""
    out: list[Block] = []
    stack: list[tuple] = []  # (tag, words, mark)
    parts: list[str] = []
    linked = links = at = 0
    n = len(page)
    deeper: dict[str, int] = {}  # open elements below MAX_DEPTH, by tag
    unclosed: set[str] = set()  # tags without an end tag from here on

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                mark = next((m for _, _, m in reversed(stack) if m), "")
                out.append(Block([(t, w) for t, w, _ in stack if t in BLOCKS], text, linked, mark))
        linked = 0

    def close(index: int):
        nonlocal links
        if any(t in BLOCKS for t, _, _ in stack[index:]):
            flush()
        links -= sum(t == "a" for t, _, _ in stack[index:])
        del stack[index:]

    while at < n:
        lt = page.find("<", at)
        text = page[at : lt if lt >= 0 else n]
        if text:
            text = chars.unescape(text)
            parts.append(text)
            if links:
                linked += len(text.strip())
        if lt < 0:
            break
        nxt = page[lt + 1 : lt + 2]
        if nxt in ("!", "?"):
            comment = page.startswith("<!--", lt)
            end = page.find("-->" if comment else ">", lt + (4 if comment else 1))
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        m = _TAG.match(page, lt)
        if m is None:
            if nxt.isalpha() and nxt.isascii() or nxt == "/" and page[lt + 2 : lt + 3].isalpha():
                end = page.find(">", lt)  # an open quote: the tag ends at the next > or, without one, with the page
                at = n if end < 0 else end + 1
            else:
                parts.append("<")
                at = lt + 1
            continue
        at = m.end()
        ending, tag, rest = m[1], m[2].lower(), m[3]
        if ending:
            if deeper.get(tag):
                deeper[tag] -= 1
                links -= tag == "a"
                if tag in BLOCKS:
                    flush()
                continue
            index = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if index >= 0:
                close(index)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in RAW:
            if tag not in unclosed and (not rest.endswith("/") or tag not in ("svg",)):
                end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
                if end is None:
                    unclosed.add(tag)
                at = end.end() if end else n if tag in TO_THE_END else at
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if tag in ENDS_P:
                index = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), -1)
                if index >= 0:
                    close(index)
            if tag in CLOSES:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in CLOSES[tag]:
                        close(i)
                        break
                    if stack[i][0] in STOPS:
                        break
        words, mark = (), ""
        if rest and "=" in rest:
            found = []
            for name, a, b, c in _ATTR.findall(rest):
                if name.lower() == "data-y":
                    mark = a or b or c
                else:
                    found += _WORDS.findall((a or b or c).lower())
            words = tuple(found)
        if not rest.endswith("/"):
            links += tag == "a"
            if len(stack) < MAX_DEPTH:
                stack.append((tag, words, mark))
            else:
                deeper[tag] = deeper.get(tag, 0) + 1
    flush()
    for i, b in enumerate(out):
        b.place = i / max(1, len(out) - 1)
    return out


def path_features(path: list) -> list[str]:
    tags = [t for t, _ in path if t not in ("html", "body")]
    out = [f"a {t}" for t in set(tags)] + [f"p {tags[-1] if tags else ''}", f"d {min(8, len(tags))}"]
    out += [f"2 {x} {y}" for x, y in {*zip(["body", *tags], tags)}]
    out += [f"c {w}" for w in {w for _, words in path for w in words}]
    out += [f"n {w}" for w in {w for _, words in path[-2:] for w in words}]
    return out


def text_features(b: Block) -> list[str]:
    words = b.text.count(" ") + 1
    size = min(7, words.bit_length())
    share = min(4, int(5 * b.linked / max(1, len(b.text))))
    end = "." if b.text[-1] in ".!?…\"»”" else ":" if b.text[-1] in ":;," else "w"
    place = "first" if b.place == 0 else "last" if b.place == 1 else str(int(4 * b.place))
    return ["bias", f"s {size}", f"l {share}", f"e {end}", f"se {size} {end}", f"sl {size} {share}", f"u {b.text[0].isupper()}", f"w {place}", f"r {'©' in b.text or '·' in b.text or '|' in b.text}"]


def hashed(names: list[str]) -> list[int]:
    return [zlib.crc32(x.encode("utf-8")) % DIMS for x in names]


@dataclass
class Model:
    weights: np.ndarray
    step: np.ndarray  # [from, to]


def viterbi(scores: list[float], step: np.ndarray) -> list[int]:
    """The best states; scores: of state 1 against state 0."""
    (s00, s01), (s10, s11) = step.tolist()
    back, x0, x1 = [], 0.0, scores[0] if scores else 0.0
    for s in scores[1:]:
        a, b = x1 + s10 > x0 + s00, x1 + s11 > x0 + s01
        back.append((a, b))
        x0, x1 = max(x0 + s00, x1 + s10), max(x0 + s01, x1 + s11) + s
    out = [int(x1 > x0)] if scores else []
    for pair in reversed(back):
        out.append(int(pair[out[-1]]))
    return out[::-1]


def fit(pages: list[tuple[list[Block], list[int | None]]], epochs: int = 12, seed: int = 3) -> Model:
    """Stochastic gradient of the likelihood, page by page; blocks labelled None are summed out."""
    rng = np.random.default_rng(seed)
    w, m = np.zeros(DIMS), np.zeros((2, 2))
    data = [([np.array(sorted(set(hashed(path_features(b.path) + text_features(b))))) for b in blocks], y) for blocks, y in pages if blocks]
    gw = np.full(DIMS, 1e-2)
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            f, y = data[i]
            score = np.array([w[x].sum() for x in f])
            free, pairs = _expected(score, m, [None] * len(y))
            held, real = _expected(score, m, y)
            for x, d in zip(f, held - free):
                if abs(d) > 1e-4:
                    g = d - 1e-3 * w[x]
                    gw[x] += g * g
                    w[x] += 0.2 * g / np.sqrt(gw[x])
            m += 0.02 * ((real - pairs) / len(y) - 1e-2 * m)
    return Model(w, m)


def _expected(score: np.ndarray, step: np.ndarray, y: list) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 and expected steps, by forward-backward over the states that y allows."""
    n, e = len(score), np.exp(step)
    up = np.ones((n, 2))
    up[:, 1] = np.exp(np.clip(score, -30, 30))
    for i, v in enumerate(y):
        if v is not None:
            up[i, 1 - v] = 0.0
    a, b = np.empty((n, 2)), np.ones((n, 2))
    a[0] = up[0] / up[0].sum()
    for i in range(1, n):
        x = (a[i - 1] @ e) * up[i]
        a[i] = x / x.sum()
    pairs = np.zeros((2, 2))
    for i in range(n - 2, -1, -1):
        z = up[i + 1] * b[i + 1]
        x = e @ z
        b[i] = x / x.sum()
        joint = a[i][:, None] * e * z
        pairs += joint / joint.sum()
    p = a * b
    return p[:, 1] / p.sum(1), pairs


# --- labelled pages built by rule -------------------------------------------

# Names that sites give to the parts of a page.
MAIN_NAMES = "content post entry story article main body text page primary single blogpost news detail".split()
PART_NAMES = {
    "nav": "nav menu navbar breadcrumb breadcrumbs navigation topbar tabs pagination pager".split(),
    "header": "header masthead branding logo top site tagline banner".split(),
    "footer": "footer foot bottom copyright legal credits colophon".split(),
    "side": "sidebar side aside widget related recommended popular trending rail more teaser links archive categories tags tagcloud".split(),
    "notice": "notice cookie consent gdpr alert message popup modal overlay warning disclaimer paywall".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner commercial dfp adsense".split(),
    "form": "form search login signup subscribe newsletter contact register feedback".split(),
    "comment": "comment comments reply replies discussion respond disqus commentlist reader feedback thread".split(),
    "share": "share social sharing toolbar byline meta tools".split(),
}
_SYLLABLES = "an ber co da el fi ga ho in ja ku la mi no or pe qua re sa ti un ve wi xa yo zu".split()


def built_page(rng: random.Random) -> str:
    """A page in a random layout; data-y marks the parts of the article (1) and the rest (0)."""
    pick = lambda xs: xs[int(rng.random() * len(xs))]
    chance = lambda p: rng.random() < p
    word = lambda: "".join(pick(_SYLLABLES) for _ in range(rng.randrange(1, 4)))

    def text(lo, hi, stop=True):
        return " ".join(word() for _ in range(int(rng.randrange(lo, hi + 1)))).capitalize() + ("." if stop else "")

    def prose():
        return " ".join(text(4, 18) for _ in range(int(rng.randrange(1, 6))))

    def named(kind):
        name = pick(PART_NAMES[kind])
        return f' {pick(["class", "id"])}="{name}{pick(["", "", "-" + word(), "_1", " " + word()])}"'

    def links(n):
        return f"<ul>{''.join(f'<li><a href=/{word()}>{text(1, 4, False)}</a></li>' for _ in range(n))}</ul>"

    def part(kind):
        tag = {"nav": pick(["nav", "div", "ul"]), "header": pick(["header", "div"]), "footer": pick(["footer", "div"]), "side": pick(["aside", "div", "section"]), "form": "form", "comment": pick(["section", "div", "ol"])}.get(kind, pick(["div", "div", "section", "p"]))
        plain = tag in ("nav", "header", "footer", "aside", "form") and chance(0.5)
        inside = {
            "nav": lambda: links(int(rng.randrange(3, 9))),
            "header": lambda: pick([f"<h1>{text(1, 3, False)}</h1><p>{text(3, 8)}</p>", f"<a href=/>{text(1, 3, False)}</a>", f"<h2>{text(1, 3, False)}</h2>", text(2, 6, False)]),
            "footer": lambda: f"&copy; {word()} &middot; {text(2, 9)}" + (links(3) if chance(0.4) else "") + (f"<p>{text(4, 14)}</p>" if chance(0.4) else ""),
            "side": lambda: pick([f"<h3>{text(1, 3, False)}</h3>" + links(int(rng.randrange(2, 6))), f"<h4>{text(1, 3, False)}</h4><p>{text(5, 20)}</p>", f"<p>{prose()}</p>", links(4), text(4, 12)]),
            "notice": lambda: pick([text(5, 20), f"<p>{text(5, 20)}</p><button>{text(1, 2, False)}</button>", f"<p>{prose()}</p>"]),
            "ad": lambda: pick([text(3, 14), f"<p>{text(3, 14)}</p>", f"<a href=/x>{text(3, 9)}</a>", f"<p>{prose()}</p>"]),
            "form": lambda: f"<label>{text(1, 3, False)}</label><input name=q><select><option>{word()}</option><option>{word()}</option></select><button>{word()}</button>" + (f"<p>{text(4, 12)}</p>" if chance(0.4) else ""),
            "comment": lambda: f"<h3>{text(1, 3, False)}</h3>" * chance(0.6) + "".join(pick([f"<div class=comment><p>{prose()}</p></div>", f"<li><b>{word()}</b> {text(5, 25)}</li>", f"<p>{prose()}</p>", f"<article class=comment><p>{text(4, 20)}</p></article>", f"<div>{text(4, 20)}</div>"]) for _ in range(int(rng.randrange(1, 5)))),
            "share": lambda: pick([links(3), text(2, 5, False), f"<a href=/s>{word()}</a> <a href=/t>{word()}</a>"]),
        }[kind]()
        return f"<{tag}{'' if plain else named(kind)} data-y=0>{inside}</{tag}>"

    def body_block():
        kind = int(rng.randrange(12))
        if kind < 7:
            return f"<p>{prose()}</p>"
        return pick([f"<h2>{text(2, 8, False)}</h2><p>{prose()}</p>", f"<blockquote>{prose()}</blockquote>", f"<ul>{''.join(f'<li>{text(3, 14)}</li>' for _ in range(3))}</ul>", f"<div>{prose()}</div>", f"<p>{text(1, 3)}</p>", f"<pre>{text(3, 12, False)}</pre>", f"<h3>{text(1, 6, False)}</h3><p>{prose()} <a href=/y>{word()}</a> {text(2, 8)}</p>", f"<table><tr><td>{text(1, 4, False)}</td><td>{text(1, 4, False)}</td></tr></table>", f"<figure><figcaption>{text(3, 10)}</figcaption></figure>", f"<p><b>{text(3, 12)}<br><p>{prose()}</p>"])

    title = text(3, 10, chance(0.4))
    head = pick([f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f"<h2>{title}</h2>", f"<div class=title><h1>{title}</h1></div>", ""])
    blocks = [body_block() for _ in range(int(rng.randrange(1, 12)))]
    for kind in ("ad", "share", "side", "notice", "form"):
        if chance(0.2):
            blocks.insert(int(rng.randrange(len(blocks) + 1)), part(kind))
    if chance(0.3):
        blocks.append(part("comment"))
    inner = head + "".join(blocks)
    article = pick([
        f"<article data-y=1>{inner}</article>", f"<article data-y=1 class={pick(MAIN_NAMES)}>{inner}</article>", f"<main data-y=1>{inner}</main>", f"<main><article data-y=1>{inner}</article></main>",
        f"<div data-y=1 class={pick(MAIN_NAMES)}-{word()}>{inner}</div>", f"<div data-y=1 id={pick(MAIN_NAMES)}>{inner}</div>", f"<section data-y=1 class={pick(MAIN_NAMES)}>{inner}</section>", f"<article data-y=1><div class={word()}>{inner}</div></article>",
    ])
    before = [part(k) for k in ("notice", "header", "nav", "ad", "form") if chance(0.5)]
    after = [part(k) for k in ("comment", "side", "ad", "share", "form", "notice", "nav") if chance(0.3)] + [part("footer")] * chance(0.8)
    if chance(0.3):
        article = f"<div class={pick(['wrapper', 'container', 'row', 'layout', word()])}>{article}{part('side')}</div>"
    return f"<html><head><title>{title}</title></head><body>{''.join(before)}{article}{''.join(after)}</body></html>"


_IN, _OUT = frozenset(["article", "main"]), frozenset(["nav", "footer", "aside", "form"])
_OUT_NAMES = frozenset("ad ads advert advertisement sponsored cookie sidebar comments comment newsletter breadcrumb".split())


def marked_by_markup(blocks: list[Block]) -> list[int | None]:
    """Labels where the markup names the part; None elsewhere."""
    out = []
    for b in blocks:
        tags, words = {t for t, _ in b.path}, {w for _, ws in b.path for w in ws}
        outside = bool(tags & _OUT or words & _OUT_NAMES)
        out.append(0 if outside else 1 if tags & _IN else None)
    return out if 1 in out else [None] * len(out)


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_pages: int = 200, max_html: int = 50_000, built: int = 700, seed: int = 11) -> Model:
    rng = random.Random(seed)
    labelled = []
    for _ in range(built):
        blocks = leaf_blocks(built_page(rng))
        labelled.append((blocks, [int(b.mark or 0) for b in blocks]))
    fit_for = pages.where(F.length(html_col).between(1, max_html)).select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
    # The ids are ordered alone: each task sends its first ids to the driver, not its first pages.
    ids = fit_for.select("_id").where("_id is not null").orderBy(F.xxhash64("_id", F.lit("html")), "_id").limit(max_pages).distinct()
    some = fit_for.join(F.broadcast(ids), "_id").groupBy("_id").agg(F.min("_html").alias("_html")).orderBy("_id").collect()
    for _, page in some:
        blocks = leaf_blocks(page)
        labelled.append((blocks, marked_by_markup(blocks)))
    return fit([(b, y) for b, y in labelled if any(v is not None for v in y)])


class PathScores(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, names: tuple) -> float:
        if len(self) > 200_000:
            self.clear()
        self[names] = s = set(hashed(path_features(list(names))))
        return s


def main_text(page: str | None, model: Model, paths: PathScores) -> str:
    blocks = leaf_blocks(page) if page else []
    scores = [float(model.weights[list(paths[tuple(b.path)] | set(hashed(text_features(b))))].sum()) for b in blocks]
    return "\n\n".join(b.text for b, s in zip(blocks, viterbi(scores, model.step)) if s)


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.step))

    def run(batches):
        field_ = shared.value
        paths = PathScores(field_.weights)
        for batch in batches:
            texts = [main_text(x.as_py(), field_, paths) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages)).withColumn("n_chars", F.length("text").cast("bigint"))
