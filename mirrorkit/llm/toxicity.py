"""Toxic spans by a linear-chain conditional random field, and document scores.

Tokens are the stretches between ASCII white space; a token's observation is
the strength class of its best feature (its words and their beginnings of 4, 5
and 6 letters) by document log-odds in labelled rows, 0 for none. Labels are
per document; *labelled tokens* are made from them: a token with a feature is
toxic in a toxic document and clean in a clean one, any other is clean.

The field has two states with weights for observation and state and for state
transitions, fitted by gradient ascent on the conditional log-likelihood with
forward-backward. A document's score comes from the marginals of its tokens:
the largest one's log-odds and the expected number of toxic tokens, turned
into a probability by a logistic fit on the same rows.

Fitting takes a bounded sample of the labelled rows (``MAX_LABELLED`` per
class, by a hash of the id), which bounds the features too. Two
thirds of the sample choose the features, the rest fits the field and the
scores, so features that stood out by chance get the weight they deserve.
The field is fitted on all tokens of these texts, in stretches of ``CHUNK``;
equal stretches are counted and gone through once.
A feature counts by the lower bound of its log-odds. Scoring covers every text as a whole. Between tokens with observations the
chain is carried by powers of the neutral step, so a document costs one
dictionary look-up per token and a few 2x2 products per feature token.

Defined results: a null or empty text has no token and gets the score of a
text without evidence; without labelled rows of both classes all scores are 0;
several labels of one id count as toxic if any is; null labels are ignored; a
null id is not held out; repeated rows are scored each; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorkit.llm.common import map_batches, slices, text_once, texts_of, worker_caches

MAX_LABELLED = 15_000
MIN_DOCS = 4
#: Lower bounds of log-odds from which a feature is of strength class 1, 2, ...
STRENGTHS = (0.7, 1.4, 2.2, 3.2, 4.5)
#: Standard errors between log-odds and their lower bound.
ERRORS = 1.3
CHUNK = 64
#: Stretches that forward-backward takes at once; bounds its memory, not the data.
BATCH = 4_096
THRESHOLD = 0.3

_LETTERS = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(rb"[^ \t\n\r\x0b\x0c]+")


def features(token: bytes) -> set[str]:
    """Words of a token in lower case (marked ``=``) and their beginnings."""
    out = set()
    for word in _LETTERS.findall(token.decode("utf-8", "replace").lower()):
        out.add("=" + word)
        for n in (4, 5, 6):
            if len(word) >= n:
                out.add(word[:n])
    return out


class Observations(dict):
    """Strength class by token, filled as tokens appear; starts anew when large."""

    MAX_TOKENS = 300_000

    def __init__(self, lexicon: dict[str, int]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: bytes) -> int:
        found = max((self.lexicon.get(f, 0) for f in features(token)), default=0)
        if len(token) <= 48:
            if len(self) >= self.MAX_TOKENS:
                self.clear()
            self[token] = found
        return found


@dataclass
class ChainField:
    """Weights: observation x (state 1), transitions x (from, to), relative to all-clean."""

    lexicon: dict[str, int] = field(default_factory=dict)
    emit: np.ndarray = field(default_factory=lambda: np.array([-6.0] + [0.0] * len(STRENGTHS)))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(3))
    fitted: bool = False

    def step(self, k: int) -> np.ndarray:
        return np.exp(self.move) * np.array([1.0, np.exp(self.emit[k])])

    def _tables(self) -> tuple:
        """Steps as plain numbers, and the neutral step (scaled to largest eigenvalue 1) as ``one + ratio ** n * other``."""
        key = self.emit.tobytes(), self.move.tobytes()
        if self.__dict__.get("_made", (None,))[0] != key:
            steps = [tuple(self.step(k).ravel().tolist()) for k in range(len(self.emit))]
            a, b, c, d = steps[0]
            root = (((a - d) / 2) ** 2 + b * c) ** 0.5  # positive, as all entries are
            top, ratio = (a + d) / 2 + root, ((a + d) / 2 - root) / ((a + d) / 2 + root)
            one = tuple((x / top - ratio * unit) / (1 - ratio) for x, unit in zip(steps[0], (1, 0, 0, 1)))
            other = tuple(unit - x for x, unit in zip(one, (1, 0, 0, 1)))
            self._made = key, steps, ratio, one, other
        return self._made[1:]

    def marginals(self, classes: list[int], gaps: list[int]) -> list[float]:
        """P(toxic) of the observed tokens; ``gaps[i]`` neutral tokens stand before token i, the last after all."""
        steps, ratio, (a1, b1, c1, d1), (a2, b2, c2, d2) = self._tables()
        forward, x, y = [], 1.0, 0.0  # a clean state stands before the text
        for k, gap in zip(classes, gaps):
            if gap:
                f = ratio**gap
                x, y = x * (a1 + f * a2) + y * (c1 + f * c2), x * (b1 + f * b2) + y * (d1 + f * d2)
            a, b, c, d = steps[k]
            x, y = x * a + y * c, x * b + y * d
            total = x + y
            x, y = x / total, y / total
            forward.append((x, y))
        f = ratio ** gaps[-1]
        x, y = a1 + f * a2 + b1 + f * b2, c1 + f * c2 + d1 + f * d2
        out = []
        for i in range(len(classes) - 1, -1, -1):
            clean, toxic = forward[i]
            clean, toxic = clean * x, toxic * y
            out.append(toxic / (clean + toxic))
            a, b, c, d = steps[classes[i]]
            x, y = a * x + b * y, c * x + d * y
            if gaps[i]:
                f = ratio ** gaps[i]
                x, y = (a1 + f * a2) * x + (b1 + f * b2) * y, (c1 + f * c2) * x + (d1 + f * d2) * y
            total = x + y
            x, y = x / total, y / total
        return out[::-1]

    def evidence(self, marginals: list[float]) -> np.ndarray:
        top = min(max(marginals, default=0.0), 1 - 1e-6)
        return np.array([1.0, np.log((top + 1e-4) / (1 - top)), np.log1p(sum(marginals))])

    def score(self, marginals: list[float]) -> float:
        if not self.fitted:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.evidence(marginals) @ self.doc, -30, 30))))


def observed(obs: Observations, text: bytes) -> tuple[list[int], list[int], list[int]]:
    """(token numbers, classes, gaps) of the tokens of ``text`` that have a feature."""
    classes = list(map(obs.__getitem__, text.split()))
    if not any(classes):
        return [], [], [len(classes)]
    at = np.flatnonzero(classes)
    gaps = np.diff(at, prepend=-1) - 1
    return at.tolist(), [classes[i] for i in at], [*gaps.tolist(), len(classes) - 1 - int(at[-1])]


def chain_expectations(x: np.ndarray, length: np.ndarray, emit: np.ndarray, move: np.ndarray,
                       count: np.ndarray | None = None):
    """Forward-backward over many chunks at once: (log Z, P(state 1) per token, expected transitions).

    Transitions of chunk i are taken ``count[i]`` times.
    """
    n, width = x.shape
    count = np.ones(n) if count is None else count
    e = np.stack([np.zeros(len(emit)), emit], axis=1)[x]  # n, width, 2
    live = np.arange(width)[None, :] < length[:, None]
    trans = np.exp(move)
    alpha = np.zeros((n, width, 2))
    scale = np.zeros((n, width))
    now = np.zeros((n, 2))
    now[:, 0] = 1.0
    for t in range(width):
        nxt = (now @ trans) * np.exp(e[:, t])
        s = nxt.sum(axis=1, keepdims=True)
        nxt = nxt / s
        alive = live[:, t][:, None]
        now = np.where(alive, nxt, now)
        alpha[:, t] = now
        scale[:, t] = np.where(alive[:, 0], np.log(s[:, 0]), 0.0)
    beta = np.ones((n, 2))
    p1 = np.zeros((n, width))
    pairs = np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        alive = live[:, t]
        both = alpha[:, t] * beta
        both = both / both.sum(axis=1, keepdims=True)
        p1[:, t] = np.where(alive, both[:, 1], 0.0)
        first = np.zeros((n, 2))
        first[:, 0] = 1.0
        prev = alpha[:, t - 1] if t else first
        right = np.exp(e[:, t]) * beta
        joint = prev[:, :, None] * trans[None] * right[:, None, :]
        joint = joint / joint.sum(axis=(1, 2), keepdims=True)
        pairs += (joint * (alive * count)[:, None, None]).sum(axis=0)
        back = right @ trans.T
        beta = np.where(alive[:, None], back / back.sum(axis=1, keepdims=True), beta)
    return scale.sum(axis=1), p1, pairs


def fit_chain(x: np.ndarray, y: np.ndarray, length: np.ndarray, count: np.ndarray | None = None,
              rounds: int = 60, ridge: float = 1.0):
    """Weights that maximise the conditional log-likelihood of token states ``y``, by Adam.

    Chunk i stands for ``count[i]`` equal ones.
    """
    count = np.ones(len(x)) if count is None else count.astype(float)
    order = np.argsort(length, kind="stable")
    x, y, length, count = x[order], y[order], length[order], count[order]
    parts = []
    for at in range(0, len(x), BATCH):
        piece = slice(at, at + BATCH)
        width = int(length[piece].max())
        part_live = np.arange(width)[None, :] < length[piece][:, None]
        parts.append((x[piece, :width], y[piece, :width], length[piece], count[piece], part_live))
    emit = np.array([-6.0] + [0.0] * len(STRENGTHS))
    move = np.zeros((2, 2))
    # Per observation: tokens, and those in state 1; per transition: how often.
    tokens, want_emit, want_move = np.zeros_like(emit), np.zeros_like(emit), np.zeros((2, 2))
    for px, py, _, pc, live in parts:
        of = np.broadcast_to(pc[:, None], px.shape)[live]
        tokens += np.bincount(px[live], weights=of, minlength=len(emit))
        want_emit += np.bincount(px[live], weights=of * py[live], minlength=len(emit))
        before = np.concatenate([np.zeros((len(py), 1), dtype=py.dtype), py[:, :-1]], axis=1)
        want_move += np.bincount((before * 2 + py)[live], weights=of, minlength=4).reshape(2, 2)
    seen = np.maximum(1, tokens)
    total = max(1, tokens.sum())
    m = [np.zeros_like(emit), np.zeros_like(move)]
    v = [np.zeros_like(emit), np.zeros_like(move)]
    for i in range(1, rounds + 1):
        got_emit, pairs = np.zeros_like(emit), np.zeros((2, 2))
        for px, _, pl, pc, live in parts:
            _, p1, part_pairs = chain_expectations(px, pl, emit, move, pc)
            got_emit += np.bincount(px[live], weights=(p1 * pc[:, None])[live], minlength=len(emit))
            pairs += part_pairs
        # Scaled by observation, so that rare classes are fitted as fast as the neutral one.
        grads = [(want_emit - got_emit - ridge * emit) / seen, (want_move - pairs - ridge * move) / total * 10]
        grads[1][0, 0] = 0.0  # the reference transition
        for w, g, a, b in ((emit, grads[0], m[0], v[0]), (move, grads[1], m[1], v[1])):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w += 0.25 * (a / (1 - 0.9**i)) / (np.sqrt(b / (1 - 0.99**i)) + 1e-8)
    return emit, move


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, learn,
                    max_labelled: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """At most about ``max_labelled`` learnable ids per class, and {class: (all, taken share in ppm)}.

    The ids taken are a bounded set, so they may be broadcast.
    """
    known = labels.filter(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("bigint").alias("l_id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ppm = {c: (n, min(1_000_000, 1_000_000 * max_labelled // n)) for c, n in counts.items()}
    place = F.pmod(F.xxhash64("l_id", F.lit(4)), F.lit(1_000_000))
    share = F.when(F.col("toxic") == 1, ppm.get(1, (0, 0))[1]).otherwise(ppm.get(0, (0, 0))[1])
    part = (F.pmod(F.xxhash64("l_id", F.lit(9)), F.lit(3)) < 2).alias("chooses")
    return known.filter(place < share).select("l_id", "toxic", part).limit(3 * max_labelled), ppm


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_caches("toxicity")
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())])
    cache: dict[bytes, set[str]] = {}

    def out():
        rows = [(f, c, n) for c in (0, 1) for f, n in counts[c].items()]
        return pa.RecordBatch.from_arrays([pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema)], schema=schema)

    for batch in slices(batches, 512):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = set()
            for token in set((text or b"").split()):
                if token not in cache:
                    if len(cache) > 40_000:
                        cache.clear()
                    cache[token] = features(token)
                found |= cache[token]
            counts[toxic].update(found)
        if len(counts[0]) + len(counts[1]) > 250_000:
            yield out()
            counts = (Counter(), Counter())
    if counts[0] or counts[1]:
        yield out()


def _training_rows(batches: Iterator[pa.RecordBatch], lexicon: dict[str, int]) -> Iterator[pa.RecordBatch]:
    obs = Observations(lexicon)
    schema = pa.schema([("toxic", pa.int32()), ("at", pa.list_(pa.int64())), ("classes", pa.list_(pa.int32())),
                        ("tokens", pa.int64())])
    for batch in slices(batches, 512):
        rows = []
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            at, classes, gaps = observed(obs, text or b"")
            rows.append((toxic, at, classes, sum(gaps) + len(at)))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _chunks(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All stretches of ``CHUNK`` tokens of the training texts: (observations, states, lengths, counts) of the different ones.

    They come in order of their content, whatever the order of ``rows``.
    """
    found: Counter = Counter()
    for row in rows:
        toxic, tokens = row["toxic"], row["tokens"]
        at = np.array(row["at"], dtype=int)
        classes = np.array(row["classes"], dtype=np.uint8)
        chunk, first = np.unique(at // CHUNK, return_index=True)
        ends = np.append(first[1:], len(at))
        for start, a, b in zip((chunk * CHUNK).tolist(), first, ends):
            line = np.zeros(CHUNK, dtype=np.uint8)
            line[at[a:b] - start] = classes[a:b]
            found[min(CHUNK, tokens - start), toxic, line.tobytes()] += 1
        # Without an observation nothing tells a toxic text's stretch from a clean one's.
        full, rest = divmod(tokens, CHUNK)
        plain = full - int((chunk < full).sum())
        if plain:
            found[CHUNK, 0, bytes(CHUNK)] += plain
        if rest and full not in chunk:
            found[rest, 0, bytes(CHUNK)] += 1
    keys = sorted(found)
    x = np.frombuffer(b"".join(k[2] for k in keys), dtype=np.uint8).reshape(-1, CHUNK)
    y = ((x > 0) & (np.array([k[1] for k in keys], dtype=int)[:, None] == 1)).astype(np.uint8)
    return x, y, np.array([k[0] for k in keys], dtype=int), np.array([found[k] for k in keys])


def fit(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> ChainField:
    """Fit on rows for which ``learn`` (a column over the id) holds."""
    model = ChainField()
    sample, ppm = labelled_sample(docs, labels, id_col, label_col, learn, max_labelled)
    if set(ppm) != {0, 1}:
        return model
    texts = docs.select(F.col(id_col).cast("bigint").alias("l_id"), F.col(text_col).cast("binary").alias("text")).join(
        F.broadcast(sample), "l_id").select("text", "toxic", "chooses").persist()
    try:
        sizes = texts.groupBy("chooses", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
        n = {r["toxic"]: r["n"] for r in sizes if r["chooses"]}
        fitting = {r["toxic"]: r["n"] for r in sizes if not r["chooses"]}
        if set(n) != {0, 1} or set(fitting) != {0, 1}:
            return model
        counts = map_batches(
            texts.filter("chooses"), _feature_counts, "feature string, toxic int, n bigint").groupBy("feature").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
        odds = F.log((F.col("bad") + 0.5) / (n[1] + 1)) - F.log((F.col("good") + 0.5) / (n[0] + 1))
        odds = odds - ERRORS * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
        strong = counts.filter(F.col("bad") >= MIN_DOCS).withColumn("odds", odds).filter(F.col("odds") >= STRENGTHS[0])
        # Bounded by the sample: a strong feature is in MIN_DOCS of its toxic texts or more.
        model.lexicon = {r["feature"]: sum(r["odds"] >= s for s in STRENGTHS) for r in strong.collect()}
        lexicon = model.lexicon
        rows = map_batches(texts.filter("NOT chooses"), lambda it: _training_rows(it, lexicon),
                                "toxic int, at array<bigint>, classes array<int>, tokens bigint").collect()
    finally:
        texts.unpersist()
    x, y, length, count = _chunks(rows)
    if len(x):
        model.emit, model.move = fit_chain(x, y, length, count)
    model.fitted = True
    evidence, truth = [], []
    for row in rows:
        gaps = (np.diff(np.array(row["at"], dtype=int), prepend=-1) - 1).tolist()
        gaps.append(row["tokens"] - 1 - (row["at"][-1] if row["at"] else -1))
        evidence.append(model.evidence(model.marginals(row["classes"], gaps) if row["at"] else []))
        truth.append(row["toxic"])
    truth = np.array(truth, dtype=float)
    # Weights restore the share of the classes before sampling.
    weight = np.where(truth == 1, ppm[1][0] / fitting[1], ppm[0][0] / fitting[0])
    model.doc = fit_logistic(np.array(evidence), truth, weight / weight.mean())
    return model


def _score(batches: Iterator[pa.RecordBatch], model: ChainField, text_col: str) -> Iterator[pa.RecordBatch]:
    worker_caches("toxicity")
    obs = Observations(model.lexicon)
    none = model.score([])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
    for batch in slices(batches, 512):
        scores, spans, stretches = [], [], []
        for raw in texts_of(batch, text_col):
            at, classes, gaps = observed(obs, raw)
            if not at:
                scores.append(none)
                spans.append([])
                stretches.append([])
                continue
            p = model.marginals(classes, gaps)
            scores.append(model.score(p))
            bad = {i: q for i, q in zip(at, p) if q >= 0.5}
            found = [(i, m.start(), m.end(), bad[i]) for i, m in enumerate(_TOKEN.finditer(raw)) if i in bad] if bad else []
            spans.append([{"start": a, "end": b, "p": q} for _, a, b, q in found])
            stretches.append(maximal(found))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(scores, type=pa.float64()), pa.array(spans, type=span), pa.array(stretches, type=span)],
            names=["row", "score", "spans", "stretches"])


def maximal(tokens: list[tuple[int, int, int, float]]) -> list[dict]:
    """Runs of neighbouring tokens (number, start, end, p) as one stretch each, with its largest p."""
    out: list[dict] = []
    last = None
    for i, a, b, q in tokens:
        if out and last == i - 1:
            out[-1]["end"], out[-1]["p"] = b, max(out[-1]["p"], q)
        else:
            out.append({"start": a, "end": b, "p": q})
        last = i
    return out


def score(docs: DataFrame, model: ChainField, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """row (struct of the ``carry`` columns, by default all), score, spans, stretches.

    Spans are byte offsets in UTF-8 of lexicon tokens with a marginal of at
    least 0.5; stretches are the maximal runs of neighbouring ones.
    """
    slim = docs.select(F.struct(*(carry or docs.columns)).alias("row"), F.col(text_col).cast("binary").alias("text"))
    row = slim.schema["row"].dataType.simpleString()
    span = "array<struct<start: bigint, end: bigint, p: double>>"
    return map_batches(text_once(slim, text_col), lambda it: _score(it, model, text_col), f"row {row}, score double, spans {span}, stretches {span}")
