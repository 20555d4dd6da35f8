"""Toxic spans by a linear-chain conditional random field.

Tokens are the white-space-separated chunks of a text; a state says whether a
token is toxic. Token features: the lower-cased word without punctuation, its
prefixes of 3 to 6 and suffix of 3 characters, hashed into one weight vector.

Labels exist per document only, so the labelled tokens that the field is
trained on are derived first: a word or prefix counts as toxic if, over the
training documents (copies collapsed), it occurs almost only in toxic ones and
far more often than chance explains. Forward-backward marginals over chains of
``CHAIN`` tokens give each token's probability; a document's score is its
largest marginal, and the offending offsets are the tokens at or above the
threshold.

The model is fitted on a bounded sample of labelled rows: at most
``max_toxic`` + ``max_clean`` documents in hash order, of at most
``max_train_chars`` characters each (longer ones leave before the sample is
drawn), and of their chains at most ``max_chains`` with a toxic token and
``others_per_chain`` times as many and ``least_others`` others. Scoring reads
every whole text, in chains of ``CHAIN`` tokens that know nothing of each other.

Defined cases: a null or empty text has no tokens and scores 0.0; null labels
and labels of absent documents are not used; repeated rows are scored one by
one; without any toxic training token everything scores about 0; other columns
are kept as they are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import table

THRESHOLD = 0.3
CHAIN = 64
DIMS = 1 << 20
FEATURES = 7
CACHE = 400_000
_NOT_WORD = re.compile(r"\W+")
_CHUNK = re.compile(r"\S+")


@dataclass
class Model:
    weights: np.ndarray  # of the hashed features, for the toxic state
    step: np.ndarray  # [from, to] transition scores
    first: np.ndarray  # scores of the first token's state
    calibration: tuple[float, float] = (0.0, 1.0)  # of a document's largest marginal: logit = a + b * logit


def normalise(chunk: str) -> str:
    return _NOT_WORD.sub("", chunk.lower())


def features(word: str) -> list[int]:
    """The ``FEATURES`` hashed features of a word; 0 is the bias, shared by all."""
    names = (f"w{word}", f"3{word[:3]}", f"4{word[:4]}", f"5{word[:5]}", f"6{word[:6]}", f"s{word[-3:]}")
    return [0, *(1 + zlib.crc32(x.encode("utf-8")) % (DIMS - 1) for x in names)]


def keys(word: str) -> list[str]:
    """What may mark a token as toxic: the word, and prefixes that leave a rest."""
    return [f"={word}", *(word[:k] for k in (4, 5, 6) if len(word) > k)] if word else []


def _first_of_copies(words: list[str]) -> int:
    """Equal for most pairs of near copies: the smallest hash of three words in a row."""
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    return min(zlib.crc32(g.encode("utf-8")) for g in grams)


def toxic_keys(docs: list[list[str]], toxic: list[int]) -> set[str]:
    """Words and prefixes that only chance could not put into the toxic documents."""
    seen, counts = set(), (Counter(), Counter())
    total = [0, 0]
    for words, y in zip(docs, toxic):
        if (mark := (_first_of_copies(words), y)) in seen:
            continue
        seen.add(mark)
        total[y] += 1
        counts[y].update({k for w in set(words) for k in keys(w)})
    if not all(total):
        return set()
    rate = total[1] / sum(total)
    need = np.log(max(2, len(counts[0].keys() | counts[1].keys()))) + 1.5
    out = set()
    for key, a in counts[1].items():
        c = counts[0][key]
        share = a / (a + c)
        if a >= 3 and share >= 0.8:
            gain = a * np.log(share / rate) + (c * np.log((1 - share) / (1 - rate)) if c else 0)
            if gain > need:
                out.add(key)
    return out


def forward_backward(score: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Marginals [chains, tokens] of the toxic state, and expected [from, to] steps. score: of the toxic state against the clean one."""
    n, t = score.shape
    up = np.exp(np.clip(score, -30, 30))
    m, first = np.exp(model.step), np.exp(model.first)
    a = np.empty((2, t, n))
    b = np.ones((2, t, n))
    x0, x1 = np.full(n, first[0]), first[1] * up[:, 0]
    for i in range(t):
        if i:
            x0, x1 = a[0, i - 1] * m[0, 0] + a[1, i - 1] * m[1, 0], (a[0, i - 1] * m[0, 1] + a[1, i - 1] * m[1, 1]) * up[:, i]
        z = x0 + x1
        a[0, i], a[1, i] = x0 / z, x1 / z
    pairs = np.zeros((2, 2))
    for i in range(t - 2, -1, -1):
        y0, y1 = b[0, i + 1], b[1, i + 1] * up[:, i + 1]
        x0, x1 = m[0, 0] * y0 + m[0, 1] * y1, m[1, 0] * y0 + m[1, 1] * y1
        z = x0 + x1
        b[0, i], b[1, i] = x0 / z, x1 / z
        joint = np.array([[a[0, i] * m[0, 0] * y0, a[0, i] * m[0, 1] * y1], [a[1, i] * m[1, 0] * y0, a[1, i] * m[1, 1] * y1]])
        pairs += (joint / joint.sum((0, 1))).sum(2)
    p = a[1] * b[1]
    return (p / (p + a[0] * b[0])).T, pairs


def fit(texts: list[str], toxic: list[int], epochs: int = 5, batch: int = 1000, seed: int = 7, max_chains: int = 6_000, others_per_chain: int = 2, least_others: int = 1_000) -> Model:
    """Trains the field by AdaGrad on at most ``max_chains`` chains with a toxic token, and ``others_per_chain`` times as many others and ``least_others`` more."""
    docs = [[normalise(c) for c in t.split()] for t in texts]
    docs, toxic = [d for d in docs if d], [y for d, y in zip(docs, toxic) if d]
    marked = toxic_keys(docs, toxic)
    model = Model(np.zeros(DIMS), np.zeros((2, 2)), np.zeros(2))
    model.weights[0] = -4.0
    if not marked:
        model.weights[0] = -12.0
        return model
    is_toxic: dict[str, bool] = {}
    chains, tags = [], []
    for words, y in zip(docs, toxic):
        for i in range(0, len(words), CHAIN):
            part = words[i : i + CHAIN]
            tag = [0] * len(part)
            if y:
                for j, w in enumerate(part):
                    if w not in is_toxic:
                        is_toxic[w] = any(k in marked for k in keys(w))
                    tag[j] = int(is_toxic[w])
            chains.append(part)
            tags.append(tag)
    rng = np.random.default_rng(seed)
    hit = np.array([i for i, t in enumerate(tags) if any(t)], int)
    rest = np.array([i for i, t in enumerate(tags) if not any(t)], int)
    hit = rng.permutation(hit)[:max_chains]
    rest = rng.permutation(rest)[: others_per_chain * len(hit) + least_others]
    use = np.concatenate([hit, rest])
    memo: dict[str, list[int]] = {}
    f = np.zeros((len(use), CHAIN, FEATURES), np.int32)
    y = np.zeros((len(use), CHAIN))
    live = np.zeros((len(use), CHAIN))
    for r, i in enumerate(use):
        for j, w in enumerate(chains[i]):
            if w not in memo:
                memo[w] = features(w)
            f[r, j] = memo[w]
        y[r, : len(tags[i])] = tags[i]
        live[r, : len(tags[i])] = 1
    square, square_m = np.full(DIMS, 1e-2), np.full((2, 2), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(use))
        for at in range(0, len(order), batch):
            r = order[at : at + batch]
            score = np.where(live[r] > 0, model.weights[f[r]].sum(2), -30.0)
            p, pairs = forward_backward(score, model)
            g = np.bincount(f[r].ravel(), ((y[r] - p) * live[r]).repeat(FEATURES), DIMS) - 1e-3 * model.weights
            model.weights += 0.3 * g / np.sqrt(square := square + g * g)
            t = y[r].astype(int)
            real = np.zeros((2, 2))
            np.add.at(real, (t[:, :-1].ravel(), t[:, 1:].ravel()), 1)
            gm = (real - pairs) / len(r) - 1e-3 * model.step
            model.step += 0.1 * gm / np.sqrt(square_m := square_m + gm * gm)
    score_of: dict[str, float] = {}
    for d in docs:
        for w in d:
            if w not in score_of:
                score_of[w] = float(model.weights[memo[w] if w in memo else features(w)].sum())
    tops = np.clip([p.max() for p in marginals(docs, score_of, model)], 1e-9, 1 - 1e-9)
    model.calibration = calibrate(np.log(tops / (1 - tops)), np.array(toxic, float))
    return model


def marginals(docs: list[list[str]], score_of, model: Model) -> list[np.ndarray]:
    """Each document's token probabilities; score_of maps a token to its score."""
    lens = np.fromiter(map(len, docs), np.int64, len(docs))
    chains = -(-lens // CHAIN)
    start = ((np.cumsum(chains) - chains) * CHAIN).tolist()
    grid = np.full(int(chains.sum()) * CHAIN, -30.0)
    for s, words in zip(start, docs):
        grid[s : s + len(words)] = np.fromiter(map(score_of.__getitem__, words), float, len(words))
    if len(grid):
        grid = np.concatenate([forward_backward(x, model)[0] for x in np.array_split(grid.reshape(-1, CHAIN), 1 + len(grid) // 1_000_000)]).ravel()
    return [grid[s : s + n] for s, n in zip(start, lens.tolist())]


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the document labels on the logit of the largest marginal (Newton steps, a small ridge)."""
    a, b = 0.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p)
        g = np.array([(y - p).sum() - 1e-2 * a, ((y - p) * x).sum() - 1e-2 * (b - 1)])
        h = np.array([[w.sum() + 1e-2, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-2]])
        da, db = np.linalg.solve(h, g)
        a, b = a + float(np.clip(da, -2, 2)), max(0.05, b + float(np.clip(db, -1, 1)))
    return a, b


def calibrated(p: float, model: Model) -> float:
    a, b = model.calibration
    x = a + b * float(np.log(p / (1 - p)))
    return float(1 / (1 + np.exp(-min(30.0, max(-30.0, x)))))


def training_rows(docs: DataFrame, labels: DataFrame, keep, max_toxic: int, max_clean: int, max_train_chars: int) -> list:
    """The bounded, labelled sample: (text, toxic) rows, in hash order of their ids. keep: a condition on the column doc_id.

    Texts that are too long for training leave before the sample is drawn. Of
    several texts with one doc_id the smallest counts."""
    one = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(keep(F.col("doc_id")))
    one = one.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("_y"))
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).where(F.length("_text").between(1, max_train_chars))
    one = one.join(texts.select("_id"), "_id", "left_semi")
    order = F.xxhash64(F.col("_id"), F.lit("toxicity"))
    some = one.where("_y = 1").orderBy(order).limit(max_toxic).unionByName(one.where("_y = 0").orderBy(order).limit(max_clean))
    return texts.join(F.broadcast(some), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.max("_y").alias("_y")).orderBy("_id").select("_text", "_y").collect()


def train(docs: DataFrame, labels: DataFrame, keep=lambda i: F.lit(True), max_toxic: int = 1500, max_clean: int = 2500, max_train_chars: int = 20_000, max_chains: int = 6_000, others_per_chain: int = 2, least_others: int = 1_000) -> Model:
    """Fits the field on a bounded sample: at most ``max_toxic`` and ``max_clean`` labelled documents of at most
    ``max_train_chars`` characters, and of their chains at most ``max_chains`` with a toxic token and
    ``others_per_chain`` times as many and ``least_others`` others."""
    rows = training_rows(docs, labels, keep, max_toxic, max_clean, max_train_chars)
    return fit([r[0] for r in rows], [r[1] for r in rows], max_chains=max_chains, others_per_chain=others_per_chain, least_others=least_others)


SPANS = "array<struct<start:int,end:int,score:double>>"


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", spans_col: str = "spans", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the document's score and its offending offsets (code points, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.step, model.first, model.calibration))
    names = docs.columns
    at = names.index(text_col)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        field = shared.value
        weights = field.weights

        class Memo(dict):
            def __missing__(self, chunk):
                self[chunk] = x = float(weights[features(normalise(chunk))].sum())
                return x

        memo = Memo()
        for batch in batches:
            texts = batch.column(at)
            scores, spans = [], []
            for a in range(0, len(texts), 500):
                if len(memo) > CACHE:
                    memo = Memo()
                part = [t.as_py() or "" for t in texts[a : a + 500]]
                for text, own in zip(part, marginals([t.split() for t in part], memo, field)):
                    scores.append(calibrated(min(max(float(own.max()), 1e-9), 1 - 1e-9), field) if len(own) else 0.0)
                    hits = np.flatnonzero(own >= threshold)
                    if hits.size and scores[-1] >= threshold:
                        where = [m.span() for m in _CHUNK.finditer(text)]
                        spans.append([{"start": where[i][0], "end": where[i][1], "score": float(own[i])} for i in hits])
                    else:
                        spans.append([])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, span)], names=[*names, score_col, spans_col])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{score_col}` double, `{spans_col}` {SPANS}"])
    return docs.mapInArrow(run, schema)


def held_out(doc_id):
    """Rows whose labels are never learned from; a row without doc_id has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the offending offsets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i))
    done = score(docs, model)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")
