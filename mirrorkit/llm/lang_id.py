"""Language by unigram piece models, summed over all segmentations.

Pieces are those of a fixed public vocabulary. Each language has a probability
per piece; a word's probability is the sum over all ways to cut it into
pieces (forward algorithm), a text's the product over its words, and the
prediction the language with the largest posterior.

Piece probabilities are fitted by expectation maximisation on words counted in
a bounded sample of the labelled texts (``MAX_LABELLED`` per language, by a
hash of the id): tasks count words, then each round tasks run forward-backward
over the distinct words and sum expected piece counts, which are at most
vocabulary times languages. Rounds end when the words' likelihood gains less
than ``GAIN`` per letter. Scoring covers every text as a whole; a task keeps
a dictionary of the short words it has met.

Words are stretches of letters in lower case, of any length: in scripts without
spaces a stretch is a sentence. The sums over stretches of more than
``LONG_WORD`` letters are taken in logarithms and not kept; cost is linear in
the text either way.

Defined results: null texts and texts without a letter are ``und`` with score
0; without any labelled text all are ``und``; null languages are not learned
from; a null id is learnable and not held out; ties go to the language first
in order; repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorkit.llm.common import written

MAX_LABELLED = 1_500
LONG_WORD = 32
#: Letters (times words) of long stretches that are summed at once.
LONG_BATCH = 1 << 17
MAX_PIECE = 16  # the longest piece of letters of the vocabulary
#: Gain in log-likelihood per letter at which fitting has converged, and rounds it may take.
GAIN, ROUNDS = 0.002, 50
START = "▁"  # the vocabulary's mark for a word's beginning
FALLBACK = 1e-7  # probability of a letter that is no piece
UND = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


_VOCABULARIES: dict[str, dict[str, int]] = {}


def vocabulary(path: str) -> dict[str, int]:
    """Piece to number, for the pieces that can occur in lower-case words."""
    if path not in _VOCABULARIES:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        usable = sorted(p for p in pieces if len(p) <= MAX_PIECE and p == p.lower())
        _VOCABULARIES[path] = {p: n for n, p in enumerate(usable)}
    return _VOCABULARIES[path]


def lattice(words: list[str], pieces: dict[str, int]) -> np.ndarray:
    """Numbers of the pieces of words of one length: [word, begin, size - 1].

    ``len(pieces)`` marks no piece, ``len(pieces) + 1`` a letter that is none.
    Shorter words among them must be filled up with spaces, which no piece has.
    """
    none = len(pieces)
    get = pieces.get
    n = len(words[0]) + 1
    out = np.full((len(words), n, MAX_PIECE), none, dtype=np.int32)
    spans = [(j, e) for j in range(n) for e in range(j + 1, min(n, j + MAX_PIECE) + 1)]
    flat = [get(w[j:e], none) for w in (START + w for w in words) for j, e in spans]
    begin = np.array([j for j, _ in spans])
    size = np.array([e - j - 1 for j, e in spans])
    out[:, begin, size] = np.array(flat, dtype=np.int32).reshape(len(words), len(spans))
    single = out[:, :, 0]
    single[single == none] = none + 1
    return out


def forward(lat: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Prefix sums alpha[word, end, ...] for piece probabilities ``p[piece, ...]``."""
    n = lat.shape[1]
    alpha = np.zeros((len(lat), n + 1, *p.shape[1:]))
    alpha[:, 0] = 1.0
    for j in range(n):
        for s in range(min(MAX_PIECE, n - j)):
            alpha[:, j + s + 1] += alpha[:, j] * p[lat[:, j, s]]
    return alpha


def log_sums(lat: np.ndarray, log_p: np.ndarray, back: bool = False) -> np.ndarray:
    """Logarithms of the prefix sums of ``forward`` (or of suffix sums): [word, end, ...]."""
    n = lat.shape[1]
    out = np.full((len(lat), n + 1, *log_p.shape[1:]), -np.inf)
    out[:, n if back else 0] = 0.0
    for e in (range(n - 1, -1, -1) if back else range(1, n + 1)):
        size = np.arange(min(MAX_PIECE, n - e if back else e))
        begin = np.full_like(size, e) if back else e - 1 - size
        ways = out[:, e + 1 + size if back else begin] + log_p[lat[:, begin, size]]
        top = np.maximum(ways.max(axis=1), -1e300)  # not infinite, so that no way stays no way
        with np.errstate(divide="ignore"):
            out[:, e] = top + np.log(np.exp(ways - top[:, None]).sum(axis=1))
    return out


def long_log_words(words: list[str], pieces: dict[str, int], log_p: np.ndarray) -> np.ndarray:
    """Log-probabilities of words of any lengths, a batch of neighbours in length at once."""
    out = np.zeros((len(words), *log_p.shape[1:]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and (upto + 1 - at) * len(words[order[upto]]) <= LONG_BATCH:
            upto += 1
        part = order[at:upto]
        width = len(words[part[-1]])
        sums = log_sums(lattice([words[i].ljust(width) for i in part], pieces), log_p)
        out[part] = sums[np.arange(len(part)), [len(words[i]) + 1 for i in part]]
        at = upto
    return out


def long_expected_counts(word: str, pieces: dict[str, int], p: np.ndarray, weight: float) -> tuple[np.ndarray, float]:
    """Expected piece counts and log-probability of one long word, for one language."""
    lat = lattice([word], pieces)
    with np.errstate(divide="ignore"):
        log_p = np.log(p)
    alpha, beta = log_sums(lat, log_p)[0], log_sums(lat, log_p, back=True)[0]
    out = np.zeros(len(p))
    n = lat.shape[1]
    for s in range(min(MAX_PIECE, n)):
        ids = lat[0, : n - s, s]
        out += np.bincount(ids, weights=weight * np.exp(alpha[: n - s] + log_p[ids] + beta[s + 1 :] - alpha[n]), minlength=len(p))
    return out, float(alpha[n])


def expected_counts(lat: np.ndarray, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece over all segmentations, by word weight."""
    return expectation(lat, p, weight)[0]


def expectation(lat: np.ndarray, p: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected piece counts, and the words' log-likelihood."""
    n = lat.shape[1]
    alpha = forward(lat, p)
    beta = np.zeros((len(lat), n + 1))
    beta[:, n] = 1.0
    for j in range(n - 1, -1, -1):
        for s in range(min(MAX_PIECE, n - j)):
            beta[:, j] += p[lat[:, j, s]] * beta[:, j + s + 1]
    scale = weight / np.maximum(alpha[:, n], 1e-300)
    out = np.zeros(len(p))
    for j in range(n):
        for s in range(min(MAX_PIECE, n - j)):
            ids = lat[:, j, s]
            out += np.bincount(ids, weights=alpha[:, j] * p[ids] * beta[:, j + s + 1] * scale, minlength=len(p))
    return out, float(weight @ np.log(np.maximum(alpha[:, n], 1e-300)))


def _by_length(words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for at in groups.values():
        for k in range(0, len(at), 2000):
            part = at[k : k + 2000]
            yield part, [words[i] for i in part]


@dataclass
class PieceModels:
    """Probabilities [piece, language], with two rows for no piece and unknown letters."""

    path: str
    languages: list[str]
    p: np.ndarray
    prior: np.ndarray

    def log_words(self, words: list[str]) -> np.ndarray:
        pieces = vocabulary(self.path)
        out = np.zeros((len(words), len(self.languages)))
        long_ = [i for i, w in enumerate(words) if len(w) > LONG_WORD]
        if long_:
            with np.errstate(divide="ignore"):
                out[long_] = long_log_words([words[i] for i in long_], pieces, np.log(self.p))
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        for at, part in _by_length([words[i] for i in short]):
            at = [short[i] for i in at]
            out[at] = np.log(np.maximum(forward(lattice(part, pieces), self.p)[:, -1], 1e-300))
        return out


def normalised(counts: np.ndarray) -> np.ndarray:
    """Probabilities from expected counts, with a little for every piece."""
    v = len(counts) - 2
    p = counts[:v] + 0.05
    p = p / p.sum(axis=0, keepdims=True)
    shape = (1, *counts.shape[1:])
    return np.concatenate([p, np.zeros(shape), np.full(shape, FALLBACK)])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text or ""))
    for lang, words in counts.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(words)), pa.array(list(words.keys()), type=pa.string()),
             pa.array(list(words.values()), type=pa.int64())], schema=schema)


def _expect(batches: Iterator[pa.RecordBatch], model: PieceModels) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])
    pieces = vocabulary(model.path)
    number = {lang: i for i, lang in enumerate(model.languages)}
    total = np.zeros_like(model.p)
    likely = np.zeros(len(model.languages))
    for batch in batches:
        words: dict[int, tuple[list[str], list[int]]] = {}
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
            if len(word) > LONG_WORD:
                counts, log = long_expected_counts(word, pieces, model.p[:, number[lang]], n)
                total[:, number[lang]] += counts
                likely[number[lang]] += n * log
                continue
            got = words.setdefault(number[lang], ([], []))
            got[0].append(word)
            got[1].append(n)
        for i, (list_, counts) in words.items():
            weights = np.array(counts, dtype=float)
            for at, part in _by_length(list_):
                counts, log = expectation(lattice(part, pieces), model.p[:, i], weights[at])
                total[:, i] += counts
                likely[i] += log
    piece, lang = np.nonzero(total[: len(pieces)])
    # Piece -1 stands for the log-likelihood.
    yield pa.RecordBatch.from_arrays([
        pa.array(np.append(lang, np.arange(len(likely))).astype(np.int32)),
        pa.array(np.append(piece, np.full(len(likely), -1)).astype(np.int32)),
        pa.array(np.append(total[piece, lang], likely))], schema=schema)


def fit(docs: DataFrame, path: str, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> PieceModels | None:
    """Models of the languages in the rows for which ``learn`` (a column) holds; None if there are none."""
    known = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.create_map(*[x for lang in languages for x in (
        F.lit(lang), F.lit(min(1_000_000, 1_000_000 * max_labelled // sizes[lang])))])
    place = F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1_000_000))
    words = written(known.filter(place < share[F.col("lang")]).select("lang", "text").mapInArrow(
        _count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "lang-words")
    pieces = vocabulary(path)
    start = np.array([10.0 ** -len(p) for p in pieces])  # shorter pieces first: every word has some way
    counts = np.repeat(np.append(start / start.sum() * len(pieces), [0, 0])[:, None], len(languages), axis=1)
    total = sum(sizes.values())
    prior = np.log(np.array([sizes[lang] / total for lang in languages]))
    model = PieceModels(path, languages, normalised(counts), prior)
    spread = words.repartition("word")
    letters = words.agg(F.sum((F.length("word") + 1) * F.col("n"))).first()[0] or 0
    before = -np.inf
    for _ in range(rounds):
        now = model
        got = spread.mapInArrow(lambda it: _expect(it, now), "lang int, piece int, n double").groupBy(
            "lang", "piece").agg(F.sum("n").alias("n")).collect()  # at most vocabulary x languages
        counts, likely = np.zeros_like(model.p), 0.0
        for r in got:
            if r["piece"] < 0:
                likely += r["n"]
            else:
                counts[r["piece"], r["lang"]] = r["n"]
        model = PieceModels(path, languages, normalised(counts), prior)
        if likely - before <= GAIN * letters:
            break
        before = likely
    return model


class WordScores:
    """Log-probabilities by word, in one growing table; starts anew when large. Long words are not kept."""

    MAX_WORDS = 1_000_000

    def __init__(self, model: PieceModels):
        self.model = model
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        missing = [w for w in words if w not in self.rows]
        if len(self.rows) + len(missing) > self.MAX_WORDS:
            self.rows.clear()
            missing = list(words)
        if not missing:
            return
        first = len(self.rows)
        need = first + len(missing)
        if need > len(self.table):
            grown = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]))
            grown[:first] = self.table[:first]
            self.table = grown
        self.table[first:need] = self.model.log_words(missing)
        self.rows.update(zip(missing, range(first, need)))

    def sums(self, words: list[list[str]]) -> np.ndarray:
        """One row of sums per list."""
        long_ = [(i, w) for i, list_ in enumerate(words) for w in list_ if len(w) > LONG_WORD]
        if long_:
            words = [[w for w in list_ if len(w) <= LONG_WORD] for list_ in words]
        self.learn(set().union(*words))
        out = np.zeros((len(words), self.table.shape[1]))
        if long_:
            np.add.at(out, [i for i, _ in long_], self.model.log_words([w for _, w in long_]))
        get = self.rows.__getitem__
        for i, list_ in enumerate(words):
            if list_:
                out[i] += self.table[np.fromiter(map(get, list_), dtype=np.int64, count=len(list_))].sum(axis=0)
        return out


def _predict(batches: Iterator[pa.RecordBatch], model: PieceModels) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    scores = WordScores(model)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            words = [words_of(t or "") for t in piece.column("text").to_pylist()]
            total = scores.sums(words) + model.prior
            best = total.argmax(axis=1)
            post = 1 / np.exp(total - total[np.arange(len(total)), best][:, None]).sum(axis=1)
            known = [any(c.isalpha() for x in w for c in x) for w in words]
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"),
                pa.array([model.languages[b] if k else UND for b, k in zip(best, known)]),
                pa.array(np.where(known, post, 0.0))], schema=schema)


def predict(docs: DataFrame, model: PieceModels | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (posterior of the predicted language)."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return slim.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    return slim.mapInArrow(lambda it: _predict(it, model), "doc_id bigint, lang_pred string, score double")
