"""Toxicity by weak supervision: many voters, a label model, a linear classifier.

1. *Lexicon.* Words and word beginnings that stand in toxic training texts far
   more often than in clean ones are mined from at most ``train_limit``
   labelled rows (see ``labelled.py``) and joined with a short list of insults.
2. *Voters.* The terms are dealt into lexicon voters. Pattern voters know no
   term: they look at address in the second person, capitals, runs of ``!`` and
   ``?``, stretched letters, and letters replaced by signs. A voter fires or
   abstains.
3. *Label model.* Every document's votes are counted by pattern in Spark (at
   most ``2 ** voters`` counts reach the driver). A two-class generative model
   is fitted to these counts by expectation maximisation: each voter's firing
   rate per class, and the correlation of every two voters within a class,
   which discounts voters that repeat each other. The labelled training rows
   count in their own class, so that no pattern common among clean texts
   becomes the class of its own.
4. *Classifier.* A logistic regression learns the label model's posteriors
   from document features, and is calibrated on the labelled training rows.

A score needs nothing but the text. Defined results: a null or empty text is
scored from all-zero features; repeated rows give repeated rows; an empty table
gives an empty result; without labels the list of insults and the label
model alone decide. Extra columns of the input are kept by ``score_toxicity`` unless
named like its result columns, which replace them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import held_out, training_texts
from .textarrays import SpanHash, slices, utf8, words

TRAIN_LIMIT = 12_000
THRESHOLD = 0.5
LEXICON_VOTERS = 8
MAX_TERMS = 300
PREFIX_LENGTHS = (4, 5, 6, 7, 8)

# Insults, in alphabetical order.
LISTED_TERMS = ("clown", "disgusting", "dumb", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid",
                 "trash", "worthless")

#: White space, ASCII punctuation and digits separate words.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[:65] = True
SEPARATOR[91:97] = True
SEPARATOR[123:128] = True

# Words of the second person (English, German, French, Spanish), in alphabetical order.
SECOND_PERSON = ("dein", "deine", "dich", "dir", "du", "toi", "ton", "tu", "tus", "tú", "u", "you", "your", "yours")

PATTERNS = ("second_person", "capitals", "exclaims", "stretched", "signs_for_letters")
FEATURES = (*(f"voter_{i}" for i in range(LEXICON_VOTERS + 1)), "log_hits", "terms", "density", "any", "two", "three", *PATTERNS)
VOTERS = (*(f"lexicon_{i}" for i in range(LEXICON_VOTERS)), "listed", *PATTERNS)
_CAPITAL, _LETTER, _SIGN = np.zeros((3, 256), bool)
_CAPITAL[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN[list(b"#$%*@")] = True


@dataclass(frozen=True)
class Lexicon:
    """Terms: a whole word, or a word beginning written with a final ``*``."""

    terms: tuple[str, ...]

    def tables(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Per prefix length (0: whole words): sorted hashes and their term numbers."""
        by_length: dict[int, list[int]] = {}
        for i, term in enumerate(self.terms):
            by_length.setdefault(len(term) - 1 if term.endswith("*") else 0, []).append(i)
        out = []
        for length, numbers in sorted(by_length.items()):
            data, offsets = utf8(pa.array([self.terms[i].rstrip("*") for i in numbers]))
            h = SpanHash(data)(offsets[:-1], offsets[1:])
            order = np.argsort(h)
            out.append((length, h[order], np.array(numbers)[order]))
        return out


class _Words:
    """Lower-cased words of a slice, with the hashes of their beginnings."""

    def __init__(self, column: pa.Array):
        self.data, offsets = utf8(pc.utf8_lower(pc.fill_null(column, "").cast(pa.string())))
        self.rows = len(offsets) - 1
        self.start, self.end, self.row = words(self.data, offsets, SEPARATOR)
        self.span = SpanHash(self.data)
        leads = (self.data & 0xC0) != 0x80
        self.lead_at = np.append(np.flatnonzero(leads), len(self.data))
        before = np.concatenate([[0], np.cumsum(leads)])
        self.first, self.chars = before[self.start], before[self.end] - before[self.start]

    def beginnings(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the words that have a beginning of ``length`` characters
        and its end (0: the whole words)."""
        if length == 0:
            return np.arange(len(self.start)), self.end
        which = np.flatnonzero(self.chars >= length)
        return which, self.lead_at[self.first[which] + length]


def _term_hits(column: pa.Array, tables) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, and for every hit its row and term; words per row."""
    w = _Words(column)
    rows, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for length, hashes, numbers in tables:
        which, end = w.beginnings(length)
        h = w.span(w.start[which], end)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = hashes[at] == h
        rows.append(w.row[which[hit]])
        terms.append(numbers[at[hit]])
    return w.rows, np.concatenate(rows), np.concatenate(terms), np.bincount(w.row, minlength=w.rows)


def document_votes(column: pa.Array, tables, n_mined: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and votes of every text: ``(rows, FEATURES)``, ``(rows, VOTERS)``."""
    n, row, term, n_words = _term_hits(column, tables)
    voter = np.where(term < n_mined, term % LEXICON_VOTERS, LEXICON_VOTERS)
    per_voter = np.bincount(row * (LEXICON_VOTERS + 1) + voter, minlength=n * (LEXICON_VOTERS + 1)).reshape(n, -1)
    hits = np.bincount(row, minlength=n)
    pairs = np.unique(row * (1 << 20) + term)
    distinct = np.bincount(pairs >> 20, minlength=n)
    features = np.column_stack([np.log1p(per_voter), np.log1p(hits), np.minimum(distinct, 5), np.minimum(100 * hits / np.maximum(n_words, 1), 5),
                                hits > 0, hits > 1, hits > 2]).astype(float)
    patterns = pattern_votes(column)
    return np.column_stack([features, patterns]), np.column_stack([per_voter > 0, patterns])


def pattern_votes(column: pa.Array) -> np.ndarray:
    """``(rows, PATTERNS)``: which pattern voters fire. None knows a term."""
    data, offsets = utf8(column.cast(pa.string()))
    n = len(offsets) - 1

    def per_row(flags: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(offsets, np.flatnonzero(flags), side="right") - 1, minlength=n)

    def following(k: int) -> np.ndarray:
        """The k-th byte after each, 0 beyond its text."""
        out = np.zeros(len(data), np.uint8)
        out[:max(len(data) - k, 0)] = data[k:]
        for j in range(1, k + 1):
            out[np.maximum(offsets[1:] - j, 0)[offsets[1:] >= j]] = 0
        return out

    start, end, of = words(data, offsets, SEPARATOR)
    n_words = np.bincount(of, minlength=n)
    spoken, at = utf8(pa.array(SECOND_PERSON))
    known = np.sort(SpanHash(spoken)(at[:-1], at[1:]))
    low = data | np.where(_CAPITAL[data], 32, 0).astype(np.uint8)
    h = SpanHash(low)(start, end)
    second = np.bincount(of[known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h], minlength=n)
    capitals = np.concatenate([[0], np.cumsum(_CAPITAL[data], dtype=np.int64)])
    shouted = np.bincount(of[(end - start >= 4) & (capitals[end] - capitals[start] == end - start)], minlength=n)
    one, two, three = following(1), following(2), following(3)
    mark = lambda x: (x == 33) | (x == 63)
    letter, sign = _LETTER[data], _SIGN[one]
    return np.column_stack([
        (second >= 2) & (50 * second >= n_words), (shouted >= 3) & (10 * shouted >= 3 * n_words),
        per_row(mark(data) & mark(one)) >= 2, per_row(letter & (data == one) & (data == two) & (data == three)) > 0,
        per_row(letter & sign & (_LETTER[two] | _SIGN[two] & _LETTER[three])) > 0])


def mine_terms(sample: DataFrame, *, least: int = 6, ratio: float = 40.0, max_terms: int = MAX_TERMS) -> Lexicon:
    """Terms of the ``text, label`` rows: in ``least`` toxic texts or more, and
    ``ratio`` times as common there as in clean ones. Copies count once."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield from _count_terms(part)

    texts = sample.dropDuplicates(["text"])
    counted = texts.mapInArrow(task, "term string, toxic long, clean long")
    sums = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = texts.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    toxic, clean = n["toxic"] or 0, n["clean"] or 0
    if not toxic or not clean:
        return Lexicon(())
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    found = (sums.where((F.col("toxic") >= least) & (odds >= ratio))
             .orderBy(F.desc("toxic"), F.length("term"), "term").limit(10 * max_terms).collect())
    kept: dict[str, int] = {}
    for r in sorted(found, key=lambda r: (len(r["term"]), r["term"])):
        stem = r["term"].rstrip("*")
        if not any(stem[:k] + "*" in kept for k in PREFIX_LENGTHS if k < len(stem) or not r["term"].endswith("*")):
            kept[r["term"]] = r["toxic"]
    return Lexicon(tuple(sorted(kept, key=lambda t: (-kept[t], t))[:max_terms]))


def _count_terms(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    w = _Words(part.column("text"))
    label = part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
    for length in (0, *PREFIX_LENGTHS):
        which, end = w.beginnings(length)
        start = w.start[which]
        h, row = w.span(start, end), w.row[which]
        order = np.lexsort((row, h))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])  # once per document
        at = np.flatnonzero(new)
        if not len(at):
            continue
        first = np.flatnonzero(np.append(True, h[at][1:] != h[at][:-1]))
        toxic = np.add.reduceat(label[row[at]], first)
        total = np.diff(np.append(first, len(at)))
        raw = w.data.tobytes()
        a, b = start[order][at[first]], end[order][at[first]]
        mark = "*" if length else ""
        term = [raw[i:j].decode("utf-8", "replace") + mark for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(toxic), pa.array(total - toxic)],
                                         ["term", "toxic", "clean"])


@dataclass(frozen=True)
class LabelModel:
    prior: float
    fires: np.ndarray  # [class, voter] firing rates
    weight: np.ndarray  # discount of each voter for what others repeat

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        v = votes.astype(float)
        ratio = np.log(self.fires[1] / self.fires[0])
        silent = np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        logit = np.log(self.prior / (1 - self.prior)) + (v * ratio + (1 - v) * silent) @ self.weight
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, known: np.ndarray | None = None, rounds: int = 60) -> LabelModel:
    """Expectation maximisation over the counted vote patterns; ``known`` has
    the counts of labelled rows by class and pattern, which stay in their class."""
    m = votes.shape[1]
    v, c = votes.astype(float), counts.astype(float)
    fires = np.array([np.full(m, 0.01), np.full(m, 0.5)])
    model = LabelModel(0.1, fires, np.full(m, 2.0 / m))
    for _ in range(rounds if c.sum() else 0):
        p = model.posterior(votes)
        mass = [(c * (1 - p)), (c * p)] if known is None else [c * (1 - p) + known[0], c * p + known[1]]
        total = [max(x.sum(), 1e-9) for x in mass]
        # add-one smoothing towards "fires for toxic, rarely for clean"
        fires = np.array([(mass[0] @ v + 0.01) / (total[0] + 1), (mass[1] @ v + 0.5) / (total[1] + 1)])
        fires = np.clip(fires, 1e-5, 1 - 1e-5)
        shared = np.zeros((m, m))
        for k in (0, 1):
            centred = v - fires[k]
            covariance = (centred * mass[k][:, None]).T @ centred / total[k]
            scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
            shared += np.clip(covariance / scale[:, None] / scale[None, :], 0, 1) / 2
        weight = 1 / np.maximum(shared.sum(1), 1)
        prior = float(np.clip(total[1] / (total[0] + total[1]), 1e-3, 0.5))
        model = LabelModel(prior, fires, weight)
    return model


def fit_logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights (last: intercept) by Newton steps; targets are probabilities."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge * max(len(x), 1) / 100)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - target) + penalty * w
        hessian = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
    return w


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    n_mined: int
    labels: LabelModel
    weights: np.ndarray
    slope: float
    shift: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        margin = features @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def train_toxicity(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", train_limit: int = TRAIN_LIMIT) -> ToxicityModel:
    sample = training_texts(docs, labels, label, train_limit)
    mined = mine_terms(sample)
    lexicon = Lexicon(mined.terms + LISTED_TERMS)
    tables, n_mined = lexicon.tables(), len(mined.terms)
    bits = 1 << np.arange(len(VOTERS))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << len(VOTERS), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                _, votes = document_votes(part.column("text"), tables, n_mined)
                counts += np.bincount(votes @ bits, minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["pattern", "n"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, votes = document_votes(part.column("text"), tables, n_mined)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(votes @ bits), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "pattern", "x"])

    seen = (docs.select("text").mapInArrow(patterns, "pattern long, n long")
            .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect())
    voted = lambda p: ((np.asarray(p, np.int64).reshape(-1, 1) >> np.arange(len(VOTERS))) & 1).astype(bool)
    rows = sample.mapInArrow(features, "label int, pattern long, x array<double>").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    y = rows["label"].to_numpy(float)
    order = np.lexsort([*x.T, y])
    x, y, pattern = x[order], y[order], rows["pattern"].to_numpy(np.int64)[order]

    counts = {r["pattern"]: r["n"] for r in seen}
    every = np.array(sorted({*counts, *pattern.tolist()}), np.int64)
    known = np.zeros((2, len(every)))
    np.add.at(known, (y.astype(int), np.searchsorted(every, pattern)), 1)
    model = fit_label_model(voted(every), np.array([counts.get(int(k), 0) for k in every], float), known)
    posterior = model.posterior(voted(pattern))
    weights = fit_logistic(x, posterior)
    slope, shift = 1.0, 0.0
    if 0 < y.sum() < len(y):
        margin = x @ weights[:-1] + weights[-1]
        slope, shift = fit_logistic(margin[:, None], y)
        slope = max(slope, 1e-3)
    return ToxicityModel(lexicon, n_mined, model, weights, float(slope), float(shift))


def score_toxicity(df: DataFrame, model: ToxicityModel, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` (probability of label 1) and ``predicted``."""
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("score", "predicted")])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    tables = model.lexicon.tables()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                x, _ = document_votes(part.column(text_col), tables, model.n_mined)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(x))], [*part.schema.names, "score"])

    return kept.mapInArrow(task, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted`` per document."""
    model = train_toxicity(docs, labels)
    return (score_toxicity(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))
