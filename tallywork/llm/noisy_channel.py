"""Toxicity after noisy-channel deobfuscation.

Writers hide words as ``1d10t``, ``m o r o n`` or ``stuuupid``. Such a token is seen as the
output of a channel: a letter may come out as a look-alike, be repeated, or be set apart.
All readings of a token form a lattice of characters, and the Viterbi path through it under
a character language model is the restored word. A classifier learned from labelled
documents scores the restored text.

* The language model counts character 4-grams over every document. Its table has 28**4
  cells at most, whatever the corpus, so it may be collected and broadcast.
* The classifier weighs words and word beginnings by log odds. It is fitted on at most
  ``fit_rows`` labelled documents, keeps ``max_features`` features, and is calibrated on
  scores from the half of the sample that its weights did not see.
* Only tokens that look disguised have more than one reading; the others restore to
  themselves and skip the search. Tokens and spaced letters of any length are searched, in
  time linear in their length. Restored tokens are remembered by each worker.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from os.path import commonprefix
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.text import slices, small_pieces
from tallywork.session import written

ORDER, SYMBOLS = 4, 28
CELLS = SYMBOLS**ORDER
BOUNDARY, OTHER = 0, 27

# What may stand for which letters. A star hides a vowel.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "¢": "c", "€": "e", "£": "l", "*": "aeiou",
}
# Costs in nats of what the channel does to a word.
LOOKALIKE_COST, DROP_COST, SQUEEZE_COST, JOIN_COST, SPLIT_COST = 1.0, 1.0, 0.5, 0.0, 2.0

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¡¿–—"
LETTERS = re.compile(r"[^\W\d_]+")
LOOKS = r"\d@$!|+(¢€£*"
LETTER, SIGN, LOOK = re.compile(r"[^\W\d_]"), re.compile(r"[^\W_]"), re.compile(f"[{LOOKS}]")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
PARTED = re.compile(r"(?:[^\W\d_][._\-~]){2,}+[^\W\d_]")
SPACED = re.compile(rf"(?<!\S)(?:(?:[^\W_]|[{LOOKS}])\s++){{2,}}(?:[^\W_]|[{LOOKS}])(?!\S)")
SEPARATORS = "._-~'"
# Words of a worker's memory, and the length of a token that is too long to be kept in it.
CACHE, LONG = 200_000, 64
# The search writes out what all its paths share after so many stretches.
SETTLED = 64


class Fit(NamedTuple):
    fit_rows: int = 20_000
    max_features: int = 20_000
    min_documents: int = 3
    # A feature must be associated with the label beyond chance (likelihood ratio statistic).
    min_g2: float = 20.0
    threshold: float = 0.3


def _fold_table() -> np.ndarray:
    """Symbol of every code point of the basic plane: 1-26 for a-z without accents, 27 for
    another letter, 0 for anything else."""
    table = np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        char = chr(point)
        if char.isalpha():
            base = unicodedata.normalize("NFKD", char)[0].lower()
            table[point] = ord(base) - 96 if "a" <= base <= "z" else OTHER
    return table


_FOLD: list[np.ndarray] = []


def fold() -> np.ndarray:
    if not _FOLD:
        _FOLD.append(_fold_table())
    return _FOLD[0]


def gram_counts(texts: Iterable[str]) -> np.ndarray:
    """Counts of symbol 4-grams; a word stands between three boundaries."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = np.where(points < 1 << 16, fold()[np.minimum(points, (1 << 16) - 1)], BOUNDARY)
    symbols = np.concatenate([[BOUNDARY], symbols, [BOUNDARY]])
    symbols = symbols[np.concatenate([[True], (symbols[1:] != BOUNDARY) | (symbols[:-1] != BOUNDARY)])]
    run = np.repeat(symbols, np.where(symbols == BOUNDARY, ORDER - 1, 1)).astype(np.int64)
    code = run[: len(run) - ORDER + 1].copy()
    for i in range(1, ORDER):
        code = code * SYMBOLS + run[i : len(run) - ORDER + 1 + i]
    return np.bincount(code, minlength=CELLS)


def corpus_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): counts over all texts; a task sends one row per gram it has seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in small_pieces(batches, 0):
            total += gram_counts(t or "" for t in batch.column(0).to_pylist())
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    return (
        docs.select(F.col(text).cast("string"))
        .mapInArrow(count, "gram bigint, n bigint")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )


def log_probabilities(grams: np.ndarray, counts: np.ndarray, strength: float = 4.0) -> np.ndarray:
    """log P(symbol | three before), each order smoothed by the next shorter one."""
    table = np.zeros(CELLS)
    table[grams] = counts
    table = table.reshape((SYMBOLS,) * ORDER)
    shorter = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        seen = table.sum(axis=tuple(range(ORDER - order)))
        shorter = (seen + strength * shorter) / (seen.sum(axis=-1, keepdims=True) + strength)
    return np.log(shorter).astype(np.float32).ravel()


class Decoder:
    """Viterbi search in the lattice of a token's readings."""

    def __init__(self, log_p: np.ndarray):
        self.log_p = log_p

    def readings(self, token: str, spaced: bool = False) -> Iterator[list[tuple[str, float]]]:
        """The lattice: for each stretch of the token its readings and their costs."""
        at = 0
        while at < len(token):
            char, end = token[at], at + 1
            while end < len(token) and token[end] == char:
                end += 1
            run = end - at
            if char.isalpha():
                options = [(char * min(run, 2), 0.0 if run < 3 else SQUEEZE_COST)]
                if run > 1:
                    options.append((char, SQUEEZE_COST if run > 2 else 3 * SQUEEZE_COST))
            elif char in LOOKALIKES:
                options = [(x * n, LOOKALIKE_COST) for x in LOOKALIKES[char] for n in ((1,) if run == 1 else (1, 2))]
                options.append(("", run * DROP_COST + LOOKALIKE_COST))
            else:
                options = [("", JOIN_COST if char in SEPARATORS else DROP_COST)]
            if spaced and at:
                options += [(" " + text, cost + SPLIT_COST) for text, cost in options if text]
            yield options
            at = end

    def restored(self, token: str, spaced: bool = False) -> str:
        """The most likely reading; a state is the last three symbols.

        Time is linear in the token's length: what all paths begin with is settled and cut off.
        """
        log_p, table = self.log_p, fold()
        keep = SYMBOLS ** (ORDER - 1)
        paths: dict[int, tuple[float, str]] = {0: (0.0, "")}
        settled = []
        for number, options in enumerate(self.readings(token, spaced), 1):
            after: dict[int, tuple[float, str]] = {}
            for state, (score, text) in paths.items():
                for part, cost in options:
                    s, value = state, score - cost
                    for char in part:
                        if char == " ":
                            value += float(log_p[s * SYMBOLS])
                            s = 0
                            continue
                        symbol = int(table[ord(char)]) if ord(char) < 1 << 16 else OTHER
                        code = s * SYMBOLS + symbol
                        value += float(log_p[code])
                        s = code % keep
                    if s not in after or value > after[s][0]:
                        after[s] = (value, text + part)
            paths = after
            if number % SETTLED == 0:
                shared = commonprefix([text for _, text in paths.values()])
                settled.append(shared)
                paths = {s: (value, text[len(shared) :]) for s, (value, text) in paths.items()}
        best = max(paths.items(), key=lambda p: p[1][0] + float(log_p[p[0] * SYMBOLS]))
        return "".join([*settled, best[1][1]])


def disguised(token: str) -> bool:
    """Whether a token looks disguised: a sign before a look-alike or a look-alike before a
    letter, a letter three times in a row, or letters parted one by one."""
    sign, look = SIGN.search(token), LOOK.search(token)
    if sign and look:
        last_look = len(token) - LOOK.search(token[::-1]).start() - 1
        if sign.start() < last_look:
            return True
        letter = LETTER.search(token[::-1])
        if letter and look.start() < len(token) - letter.start() - 1:
            return True
    return bool(TRIPLE.search(token) or PARTED.fullmatch(token))


def spaced_runs(lower: str) -> Iterator[str]:
    """Letters, digits and look-alikes that stand alone between white space, three or more in
    a row, without the white space."""
    for match in SPACED.finditer(lower):
        yield "".join(match.group().split())


def token_words(token: str, decoder: Decoder) -> list[str]:
    """The words that a white-space token (in lower case) restores to."""
    core = token.strip(EDGES)
    # A look-alike at an edge belongs to the word, unless it comes in a row.
    if core and core != token:
        at = token.find(core)
        before, after = token[:at], token[at + len(core) :]
        if before[-1:] in ("@", "$") and before[-2:-1] != before[-1:]:
            core = before[-1] + core
        if after[:1] in ("$", "@") and after[1:2] != after[:1]:
            core = core + after[0]
    words = LETTERS.findall(core)
    if words and disguised(core):
        read = decoder.restored(core)
        if read not in words:
            words.append(read)
    return words


def word_features(word: str) -> list[str]:
    """A word and how it begins."""
    return [word, *("^" + word[:k] for k in (4, 5, 6) if len(word) > k)]


def document_words(text: str, words_of: Callable[[str], list[str]], decoder: Decoder) -> Iterator[list[str]]:
    """The restored words of each distinct token, and of letters that are spaced out."""
    lower = text.lower()
    for token in set(lower.split()):
        yield words_of(token)
    for letters in spaced_runs(lower):
        yield decoder.restored(letters, spaced=True).split()


def remembered(make: Callable[[str], object]) -> Callable[[str], object]:
    """``make`` with a memory of bounded size."""
    held: dict[str, object] = {}

    def get(token: str):
        if len(token) > LONG:
            return make(token)
        found = held.get(token)
        if found is None:
            if len(held) >= CACHE:
                held.clear()
            found = held[token] = make(token)
        return found

    return get


class Evidence(NamedTuple):
    largest: float
    total: float
    hits: int


class Scorer:
    """Weighs the restored words of a text."""

    def __init__(self, decoder: Decoder, weights: dict[str, float]):
        self.decoder, self.weights = decoder, weights
        self.token = remembered(lambda token: self.weight(token_words(token, decoder)))

    def weight(self, words: Iterable[str]) -> float:
        get = self.weights.get
        return max((w for word in words for f in word_features(word) if (w := get(f)) is not None), default=0.0)

    def evidence(self, text: str) -> Evidence:
        lower = text.lower()
        found = [w for w in map(self.token, set(lower.split())) if w]
        for letters in spaced_runs(lower):
            if w := self.weight(self.decoder.restored(letters, spaced=True).split()):
                found.append(w)
        return Evidence(max(found, default=0.0), min(sum(found), 100.0), len(found))


def design(evidence: np.ndarray) -> np.ndarray:
    """Columns of the calibration: constant, largest weight, total weight on a log scale."""
    return np.stack([np.ones(len(evidence)), evidence[:, 0], np.log1p(evidence[:, 1])], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1e-3, *[1.0] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - penalty @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model(NamedTuple):
    log_p: np.ndarray
    weights: dict[str, float]
    beta: np.ndarray | None


def held_out(id: str):
    """Whether a row's label may not be learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit, id: str, text: str, label: str) -> DataFrame:
    """(text, y, fold): at most ``fit.fit_rows`` labelled documents that are not held out.

    The ids are chosen by hash and broadcast (the bound is the parameter), so the texts are
    filtered where they are read. Of copies of a whole text (in any case) the one with the
    smallest id is taken, or the words of a copied text would pass for evidence. The fold is
    a bit of the whole text's digest, whatever texts have in common.
    """
    ids = (
        labels.filter(F.col(label).isin(0, 1) & ~held_out(id))
        .groupBy(F.col(id).alias("_id"))
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(fit.fit_rows)
    )
    picked = docs.select(F.col(id).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return (
        picked.join(F.broadcast(ids), F.col("_doc") == F.col("_id"))
        .groupBy(F.sha2(F.lower("text"), 256).alias("copy"))
        .agg(F.min_by(F.struct("text", "y"), "_doc").alias("d"))
        .select("d.text", "d.y", F.pmod(F.xxhash64("copy"), F.lit(2)).cast("int").alias("fold"))
    )


def feature_counts(sample: DataFrame, log_p) -> DataFrame:
    """(feature, n00, n01, n10, n11): documents of fold f and label y that hold a feature;
    the empty feature counts the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(log_p.value)
        words_of = remembered(lambda token: token_words(token, decoder))
        for batch in slices(batches, 2048):
            counts = [Counter() for _ in range(4)]
            for text, y, fold_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = {w for part in document_words(text, words_of, decoder) for w in part}
                features = {f for w in words for f in word_features(w)}
                counts[2 * fold_ + y].update(features)
                counts[2 * fold_ + y][""] += 1
            names = list(set().union(*counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)],
                names=["feature", "n00", "n01", "n10", "n11"],
            )

    return (
        sample.select("text", "y", "fold")
        .mapInArrow(count, "feature string, n00 bigint, n01 bigint, n10 bigint, n11 bigint")
        .groupBy("feature")
        .agg(*(F.sum(n).alias(n) for n in ("n00", "n01", "n10", "n11")))
    )


def strongest_features(counted: DataFrame, everyone: list[int], fit: Fit) -> DataFrame:
    """At most ``max_features`` rows of :func:`feature_counts`: those most associated with label 1,
    by the same statistic as :func:`log_odds`."""
    n0, n1 = F.col("n00") + F.col("n10"), F.col("n01") + F.col("n11")
    all0, all1 = everyone[0] + everyone[2], everyone[1] + everyone[3]
    n, total = n0 + n1, all0 + all1

    def part(n, expected):
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    g2 = part(n1, n * all1 / total) + part(n0, n * all0 / total) + part(all1 - n1, (total - n) * all1 / total) + part(all0 - n0, (total - n) * all0 / total)
    likelier = (F.col("feature") != "") & (n1 >= fit.min_documents) & (n1 * all0 > n0 * all1)
    return counted.filter(likelier).orderBy(g2.desc(), "feature").limit(fit.max_features)


def log_odds(n0: np.ndarray, n1: np.ndarray, all0: int, all1: int, fit: Fit) -> np.ndarray:
    """Weight of each feature: log of how much likelier it is in label 1, or 0 where it is
    rare, not likelier, or not associated beyond chance."""

    def part(n, expected):
        return n * np.log(np.maximum(n, 1e-12) / np.maximum(expected, 1e-12))

    n, total = n0 + n1, all0 + all1
    g2 = 2 * (
        part(n1, n * all1 / total) + part(n0, n * all0 / total)
        + part(all1 - n1, (total - n) * all1 / total) + part(all0 - n0, (total - n) * all0 / total)
    )
    weight = np.log((n1 + 0.5) / (all1 + 1)) - np.log((n0 + 0.5) / (all0 + 1))
    return np.where((n1 >= fit.min_documents) & (g2 >= fit.min_g2) & (weight > 0), weight, 0.0)


def train(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", fit: Fit = Fit()
) -> Model:
    """Language model from all texts, classifier from the labelled sample.

    To the driver come at most 28**4 counts, ``fit.max_features`` features and
    ``fit.fit_rows`` pairs of evidence and label. Without labels of both kinds there are no
    weights, and every text scores the share of label 1 (0 without any label).
    """
    context = docs.sparkSession.sparkContext
    grams = corpus_grams(docs, text).toPandas()
    log_p = log_probabilities(grams["gram"].to_numpy(np.int64), grams["n"].to_numpy(float))
    shared = context.broadcast(log_p)
    sample = labelled_sample(docs, labels, fit, id, text, label)
    counted = written(feature_counts(sample, shared))
    labelled = counted.filter(F.col("feature") == "").first()
    if labelled is None:
        return Model(log_p, {}, None)
    everyone = list(labelled[1:])
    strongest = strongest_features(counted, everyone, fit).toPandas()
    names = strongest["feature"].to_numpy()
    counts = strongest[["n00", "n01", "n10", "n11"]].to_numpy(float)

    def table(folds: tuple[int, ...]) -> dict[str, float]:
        zero, one = (sum(counts[:, 2 * f + y] for f in folds) for y in (0, 1))
        all0, all1 = (sum(everyone[2 * f + y] for f in folds) for y in (0, 1))
        if not all0 or not all1:
            return {}
        weights = log_odds(zero, one, all0, all1, fit)
        return {n: float(w) for n, w in zip(names, weights, strict=True) if w}

    weights = table((0, 1))
    # A fold whose other half has too little to learn from is scored by all weights.
    crossed = context.broadcast(tuple(table((1 - f,)) or weights for f in (0, 1)))

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(Decoder(shared.value), w) for w in crossed.value]
        for batch in slices(batches):
            found = [
                (*scorers[f].evidence(t)[:2], y) for t, y, f in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in columns], names=["largest", "total", "y"])

    scores = sample.select("text", "y", "fold").mapInArrow(unseen, "largest double, total double, y double")
    pairs = scores.toPandas().to_numpy(float)
    if not weights:
        return Model(log_p, {}, np.array([math.log((pairs[:, 2].sum() + 0.5) / (len(pairs) - pairs[:, 2].sum() + 0.5)), 0.0, 0.0]))
    return Model(log_p, weights, logistic(design(pairs[:, :2]), pairs[:, 2]))


def probabilities(model: Model, scorer: Scorer, texts: Iterable[str | None]) -> tuple[np.ndarray, list[int]]:
    """Score and number of hits of each text."""
    evidence = [scorer.evidence(t or "") for t in texts]
    if model.beta is None:
        return np.zeros(len(evidence)), [0] * len(evidence)
    x = design(np.array([e[:2] for e in evidence], float).reshape(-1, 2))
    return 1 / (1 + np.exp(-np.clip(x @ model.beta, -30, 30))), [e.hits for e in evidence]


def score(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", fit: Fit = Fit()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, hits.

    ``hits`` counts the distinct tokens that carry weight. A null text is empty and scores
    what a text without evidence scores. Rows are scored alone; other columns are not read.
    A null id is never held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        scorer = Scorer(Decoder(found.log_p), found.weights)
        for batch in slices(batches):
            p, hits = probabilities(found, scorer, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= fit.threshold).astype(np.int32)),
                 pa.array(hits, pa.int64())],
                names=["doc_id", "held_out", "score", "predicted", "hits"],
            )

    return docs.select(
        F.col(id).cast("bigint").alias("doc_id"), held_out(id).alias("held_out"), F.col(text).cast("string")
    ).mapInArrow(scored, "doc_id bigint, held_out boolean, score double, predicted int, hits bigint")


def without_toxic(docs: DataFrame, model: Model, *, text: str = "text", fit: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        scorer = Scorer(Decoder(found.log_p), found.weights)
        for batch in slices(batches):
            p, _ = probabilities(found, scorer, batch.column(place).to_pylist())
            yield batch.filter(pa.array(p < fit.threshold))

    return docs.mapInArrow(clean, docs.schema)


def toxicity(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", fit: Fit = Fit()
) -> DataFrame:
    """Train on ``docs`` and ``labels``, then :func:`score` all of ``docs``."""
    return score(docs, train(docs, labels, id=id, text=text, label=label, fit=fit), id=id, text=text, fit=fit)
