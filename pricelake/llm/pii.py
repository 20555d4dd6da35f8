r"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Base patterns (leftmost, non-overlapping per kind) give emails, IP addresses,
card numbers and phone numbers. They are the seeds of a bootstrap:

* an *instance* is a token of ``LEAST_CHARS`` letters and digits and more that
  looks like an identifier (a digit, an ``@``, or a run of letters with an inner
  capital) or a base span; tokens shaped like
  keys (``KEY_CHARS`` letters and digits and more, mixed) are weak seeds;
* a *pattern* is the lexical context around it: the word before, the word after,
  both, the two words before, a name glued in front (``key=``), with digits
  and punctuation normalised, or the first four letters of a key (``AKIA``);
* pattern and instance scores are computed in rounds over the graph of their
  co-occurrences, all in Spark: a pattern's score is the share of what it
  extracts (weighted by instance scores) times how much it was seen to extract;
  an instance's score is the noisy-or of its patterns; seeds stay at 1, weak
  ones at ``WEAK`` or more;
* tokens outside the base spans, weak seeds included, whose context is a pattern
  at or above ``CONFIDENT`` are added as spans of the kind ``id``. A context of
  one word says less, so nearly all that it extracts must be seeds (``NEARLY``)
  and it must be seen ``OFTEN`` times.

Base spans always stay, added spans never overlap them.

Defined cases: a null or empty text has no spans and counts of zero; repeated
rows are extracted one by one; null doc_ids keep their row; other columns are
ignored; without any confident pattern nothing is added; an empty table gives
an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import fresh, materialize, table

KINDS = ("email", "ip", "card", "phone")
ADDED = "id"
ROUNDS = 3
#: A pattern needs this score, and this many distinct instances of which that many are seeds.
CONFIDENT, SUPPORT, SEEDS = 0.6, 5, 3
#: The share of seeds among what a pattern extracts; for contexts of one word the second one, and this many distinct instances.
SHARE, NEARLY, OFTEN = 0.1, 0.8, 20
#: Weak seeds: so many letters and digits at least; the score they start with.
KEY_CHARS, WEAK = 16, 0.8
#: Tokens of fewer letters and digits (4.0, 3rd) name nobody: they are neither instances nor added.
LEAST_CHARS = 6

# The base patterns of the contract. Possessive runs keep them linear where the next character can't be of the run.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_LIKE = re.compile(r"[0-9@]|[a-z][A-Z]")
_EDGE = re.compile(r"^\W+|\W+$")
_ALNUM = re.compile(r"[^\W_]")
_GLUE = re.compile(r"""[("'\[{]*([A-Za-z_][\w-]*[=:])["'(\[{]*(?=[^\s/])""")
_KEY = re.compile(rf"(?=\S*[0-9])(?=\S*[A-Za-z])[A-Za-z0-9+/_=-]{{{KEY_CHARS},}}")
_HEAD = re.compile(r"(?=.{0,3}[g-zG-Z_-])[A-Za-z_-]{4}")


def emails(text: str) -> list[tuple[int, int]]:
    """The matches of the email pattern, found from their ``@`` (equal to scanning from the left: no ``@`` lies inside a local part)."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans by kind, in the order of KINDS."""
    ips, cards, phones = [], [], []
    if _DIGITS.search(text):
        ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
        if "+" in text:
            phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return [emails(text) if "@" in text else [], ips, cards, phones]


def _word(token: str) -> str:
    """A context word: lower case, digits as 0, no punctuation at its ends; punctuation alone stays."""
    return _DIGITS.sub("0", _EDGE.sub("", token).lower()) or token[:8]


def contexts(tokens: list[tuple[int, int]], text: str, first: int, last: int, glue: str = "", head: str = "") -> list[str]:
    """The patterns around tokens first..last: the words before and after, both, the two words before, a glued name such as ``key=``, a key's first letters."""
    before = _word(text[slice(*tokens[first - 1])]) if first else "^"
    after = _word(text[slice(*tokens[last + 1])]) if last + 1 < len(tokens) else "$"
    two = (_word(text[slice(*tokens[first - 2])]) if first > 1 else "^") + " " + before
    return [f"L {before}", f"R {after}", f"L2 {two}", f"B {before} | {after}", *([f"G {_DIGITS.sub('0', glue.lower())}"] if glue else []), *([f"H {head}"] if _HEAD.fullmatch(head) else [])]


_BASE = "array<array<struct<start:int,end:int>>>"
_FOUND = "array<struct<start:int,end:int,instance:string,seed:boolean,weak:boolean,patterns:array<string>>>"


def _scan(batches, at: int, names: list[str]):
    """The rows with their base spans and identifier-like tokens in context; at: the number of the text's column."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    found_type = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()), ("seed", pa.bool_()), ("weak", pa.bool_()), ("patterns", pa.list_(pa.string()))])
    for batch in batches:
        bases, founds = [], []
        for text in batch.column(at):
            text = text.as_py() or ""
            base = base_spans(text)
            found = []
            if _LIKE.search(text):
                taken = sorted((a, b) for k in base for a, b in k)
                tokens = [m.span() for m in _TOKEN.finditer(text)]
                i = t = 0
                while i < len(tokens):
                    a, b = tokens[i]
                    while t < len(taken) and taken[t][1] <= a:
                        t += 1
                    if t < len(taken) and taken[t][0] < b:
                        j = i
                        while j + 1 < len(tokens) and tokens[j + 1][0] < taken[t][1]:
                            j += 1
                        found.append({"start": taken[t][0], "end": taken[t][1], "instance": text[slice(*taken[t])], "seed": True, "weak": False, "patterns": contexts(tokens, text, i, j)})
                        i = j
                    elif _LIKE.search(text, a, b):
                        token = text[a:b]
                        glue = _GLUE.match(token)
                        left = glue.end() if glue else len(token) - len(re.sub(r"^[^\w@+]+", "", token))
                        right = len(re.sub(r"[^\w]+$", "", token))
                        if len(_ALNUM.findall(token, left, right)) >= LEAST_CHARS and _LIKE.search(token, left, right):
                            weak = _KEY.fullmatch(token, left, right) is not None
                            found.append({"start": a + left, "end": a + right, "instance": token[left:right], "seed": False, "weak": weak, "patterns": contexts(tokens, text, i, i, glue[1] if glue else "", token[left : left + 4] if weak else "")})
                    i += 1
            bases.append([[{"start": a, "end": b} for a, b in k] for k in base])
            founds.append(found)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bases, pa.list_(pa.list_(span))), pa.array(founds, pa.list_(found_type))], names=names)


def confident_patterns(found: DataFrame) -> DataFrame:
    """(pattern, score) of the patterns that the graph of patterns and instances makes confident. found: rows (instance, seed, weak, patterns).

    Each round: instance scores from pattern scores, pattern scores from
    instance scores; both are grouped and joined in Spark and written out."""
    start = F.when(F.col("seed"), 1.0).when(F.col("weak"), WEAK).otherwise(0.0)
    edges = found.select(F.xxhash64("instance").alias("instance"), start.alias("start"), F.explode("patterns").alias("pattern"))
    edges = edges.groupBy("pattern", "instance").agg(F.max("start").alias("start"))
    seen = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.count_if(F.col("start") > 0).alias("s"), F.sum("start").alias("w"))
    seen = materialize(seen.where((F.col("n") >= SUPPORT) & (F.col("s") >= SEEDS)), "pii-patterns")
    edges = materialize(edges, "pii-edges").join(seen.select("pattern"), "pattern", "left_semi")
    edges = materialize(edges, "pii-graph")
    scores = materialize(seen.select("pattern", (F.col("w") / F.col("n")).alias("score")), "pii-scores")
    for _ in range(ROUNDS):
        heard = edges.join(scores, "pattern")
        instances = heard.groupBy("instance").agg(F.max("start").alias("start"), (1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))).alias("_p"))
        instances = materialize(instances.select("instance", F.greatest("start", "_p").alias("weight")), "pii-instances")
        scores = edges.join(instances, "instance").groupBy("pattern").agg((F.sum("weight") / F.count("*")).alias("share"), F.count("*").alias("n"))
        scores = materialize(scores.select("pattern", (F.col("share") * (1 - F.exp(-F.col("n") / SUPPORT))).alias("score")), "pii-scores")
    # A pattern that mostly extracts unknown tokens cannot lift itself: seeds must be a tenth of what it extracts at least, nearly all for one word.
    one = F.col("pattern").startswith("L ") | F.col("pattern").startswith("R ")
    enough = F.when(one, (F.col("s") >= NEARLY * F.col("n")) & (F.col("n") >= OFTEN)).otherwise(F.col("s") >= SHARE * F.col("n"))
    return materialize(scores.where(F.col("score") >= CONFIDENT).join(seen.where(enough), "pattern").select("pattern", "score"), "pii-confident")


def extract(docs: DataFrame, text_col: str = "text", base_col: str = "base", added_col: str = "added", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of every row of ``docs``, its base spans by kind, and the spans that the patterns found."""
    row, found = fresh("row"), fresh("found")
    keep = docs.columns if keep is None else keep
    read = docs.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text_col])])
    names = [*read.columns, base_col, found]
    at = read.columns.index(text_col)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields), f"`{base_col}` {_BASE}, `{found}` {_FOUND}"])
    scanned = read.mapInArrow(lambda batches: _scan(batches, at, names), schema)
    scanned = materialize(scanned.select(*[f"`{c}`" for c in [*keep, base_col, found]], F.monotonically_increasing_id().alias(row)), "pii-scan")
    tokens = scanned.select(row, F.explode(found).alias("f")).select(row, "f.*")
    good = confident_patterns(tokens.select("instance", "seed", "weak", "patterns"))
    asked = tokens.where("not seed").select(row, "start", "end", F.explode("patterns").alias("pattern"))
    hits = asked.join(good, "pattern").groupBy(row).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_hits"))
    out = scanned.drop(found).join(materialize(hits, "pii-hits"), row, "left")
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return out.select(*[f"`{c}`" for c in [*keep, base_col]], F.coalesce("_hits", empty).alias(added_col))


def _joined(kinds):
    """kind:start:end, comma-joined, of (kind, array of spans) in order."""

    def texts(kind, spans):
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*(texts(*x) for x in kinds)), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id (added spans), n_spans (all)."""
    done = extract(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = [(k, F.col("base")[i]) for i, k in enumerate(KINDS)]
    return done.select(
        "doc_id",
        *(F.size(spans).cast("bigint").alias(f"n_{k}") for k, spans in base),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined([*base, (ADDED, F.col("added"))]).alias("spans"),
        F.size("added").cast("bigint").alias("n_id"),
        (sum((F.size(spans) for _, spans in base), F.size("added"))).cast("bigint").alias("n_spans"),
    )


def _redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced; spans that overlap are replaced together, by the kind that comes first."""
    out, free, end, kind = [], 0, 0, ""
    for a, b, k in sorted(spans):
        if kind and a < end:
            end = max(end, b)
            continue
        if kind:
            out.append(f"<{kind.upper()}>")
            free = end
        out.append(text[free:a])
        end, kind = b, k
    return "".join([*out, f"<{kind.upper()}>", text[end:]]) if kind else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by ``<EMAIL>``, ``<IP>``, ``<CARD>``, ``<PHONE>`` or ``<ID>``."""
    base, added = fresh("base"), fresh("added")
    done = extract(docs, text_col, base, added)
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = []
            for text, found, more in zip(batch.column(at), batch.column(base), batch.column(added)):
                spans = [(s["start"], s["end"], k) for k, each in zip((*KINDS, ADDED), [*(found.as_py() or []), more.as_py() or []]) for s in each]
                texts.append(_redacted(text.as_py(), spans) if spans else text.as_py())
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return done.mapInArrow(run, docs.schema)
