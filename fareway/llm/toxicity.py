"""Toxicity by a support vector machine over a subsequence string kernel, with Nyström landmarks.

The kernel of two units (words) sums, over all triples of letters that both hold in order, the products of decay^span; letters of a triple
may be up to REACH letters apart, so letters put into an insult lower its value but do not hide it at once. Other characters are passed
over, and letters set apart by blanks are one unit. The value is divided by the units' norms and raised to POWER, a product of kernels. The kernel of two sentences is the sum over their units. Landmarks are units; the Nyström
map of a sentence is K^(-1/2) times its kernel values with the landmarks, and a linear machine with squared hinge loss is fitted to it.

Labels belong to documents. A sentence has its document's label, but is clean if any clean document of the sample has it; after the first
fit only the highest sentences of each toxic document stay as toxic examples. A document's value is that of its highest
sentence, turned into a probability by a logistic fit over the sample. The sample is bounded by SAMPLE_DOCS; every whole text is scored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage, id_text, map_batches, per_worker

SAMPLE_DOCS = 6000  # labelled documents the machine is fitted on
TOXIC_SENTENCES = 100  # most sentences of a toxic document in the sample, from all over it
CLEAN_SENTENCES = 12  # of a clean one
TOXIC_KEPT = 1  # sentences of a toxic document that later fits take as toxic
LANDMARKS = 160  # most units that tell toxic sentences
TELLING = 1 / 20  # of the best unit's score that such a unit needs; forms of one inflected insult are each far rarer than a plain one
TIMES = 4  # how much more frequent it must be in toxic sentences than in clean ones
BACKGROUND = 0  # frequent units besides; they let the length of a sentence weigh in
REACH = 3  # most letters from one letter of a triple to the next
DECAY = 0.6
POWER = 3
SENTENCE_WORDS = 32
UNIT_CHARS = 32  # longer words are cut into windows of this length that overlap by half
PENALTY = 3e-5
NEAR = -0.5  # toxic examples are also all sentences of toxic documents with a value above this
FITS = 3
BLOCK = 4096  # rows of the sample that a fit takes at once
CACHE_UNITS = 400_000  # values of units that a worker keeps
FIT_OF_FIVE = 0  # rows with this remainder of crc32(doc_id) by 5 are held out

SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]+\S(?!\S)){2,}")  # letters set apart by blanks
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|[\n\r]+")
LETTERS = 64
# digits and signs that stand for letters
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _letter_table() -> np.ndarray:
    """Letter class of the first code points; 0 is no letter."""
    table = np.zeros(0x3000, np.int64)
    for c in range(len(table)):
        ch = LOOKALIKES.get(chr(c), chr(c))
        if "a" <= ch <= "z":
            table[c] = ord(ch) - 96
        elif ch.isalpha():
            table[c] = 27 + c % (LETTERS - 27)
    return table


TABLE = _letter_table()


def _run(spelled: re.Match) -> str:
    """A run of single letters as one unit, and once more without its first letter, which may be a word of its own."""
    run = re.sub(r"[ \t]+", "\x01", spelled.group())
    return f"{run} {run[2:]}"


def sentences(text: str) -> list[list[str]]:
    """The units of each sentence that has any; sentences end at a mark before a blank, at a line end, or after SENTENCE_WORDS words."""
    text = SPELLED.sub(_run, text.lower())
    out = []
    for part in SENTENCE_END.split(text):
        words = part.split()
        for at in range(0, len(words), SENTENCE_WORDS):
            some = words[at : at + SENTENCE_WORDS]
            if max(map(len, some)) > UNIT_CHARS:
                some = [w[i : i + UNIT_CHARS] for w in some for i in range(0, max(1, len(w) - UNIT_CHARS // 2), UNIT_CHARS // 2)]
            out.append(some)
    return out


def triples(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse kernel features: unit number, triple, weight (sorted by unit, each triple once), and the norm of every unit."""
    gap = "\x02" * (2 * REACH)
    joined = np.frombuffer((gap.join(units) + gap).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(joined < len(TABLE), TABLE[np.minimum(joined, len(TABLE) - 1)], 27 + joined % (LETTERS - 27))
    stays = (codes > 0) | (joined == 2)  # only letters count, and the gaps that keep units apart
    codes, owner = codes[stays], np.repeat(np.arange(len(units)), [len(u) + len(gap) for u in units])[stays]
    keys, weights = [], []
    size = len(codes) - 2 * REACH
    for one in range(1, REACH + 1):
        for two in range(1, REACH + 1):
            a, b, c = codes[:size], codes[one : one + size], codes[one + two : one + two + size]
            at = np.flatnonzero((a > 0) & (b > 0) & (c > 0))
            keys.append(((owner[at] * LETTERS + a[at]) * LETTERS + b[at]) * LETTERS + c[at])
            weights.append(np.full(len(at), DECAY ** (one + two)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    weight = np.add.reduceat(weight, starts) if len(key) else weight
    key = key[starts]
    unit, triple = np.divmod(key, LETTERS**3)
    return unit, triple, weight, np.sqrt(np.bincount(unit, weight**2, minlength=len(units)))


class Landmarks:
    """Kernel values of units with the landmarks."""

    def __init__(self, units: list[str]):
        self.units = units
        unit, triple, weight, norm = triples(units) if units else (*[np.zeros(0, np.int64)] * 2, np.zeros(0), np.zeros(0))
        known, row = np.unique(triple, return_inverse=True)
        self.place = np.full(LETTERS**3, -1, np.int32)
        self.place[known] = np.arange(len(known))
        # by triple the landmarks that hold it, few of all, and their weights
        order = np.argsort(row, kind="stable")
        self.owner, self.weight = unit[order], (weight / norm[unit])[order]
        self.size = np.bincount(row, minlength=len(known))
        self.start = np.cumsum(self.size) - self.size

    def kernel(self, units: list[str]) -> np.ndarray:
        """units x landmarks."""
        shape = len(units), len(self.units)
        if not units or not self.units:
            return np.zeros(shape)
        unit, triple, weight, norm = triples(units)
        place = self.place[triple]
        meets = place >= 0
        unit, place, weight = unit[meets], place[meets], weight[meets] / norm[unit[meets]]
        size = self.size[place]
        # each triple of a unit beside each landmark that holds it
        at = np.repeat(self.start[place] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cell = np.repeat(unit, size) * shape[1] + self.owner[at]
        out = np.bincount(cell, np.repeat(weight, size) * self.weight[at], minlength=shape[0] * shape[1]).reshape(shape)
        return reduce(np.multiply, [out] * POWER)


def inverse_root(kernel: np.ndarray) -> np.ndarray:
    """K^(-1/2) on the directions that K has."""
    values, vectors = np.linalg.eigh(kernel)
    scale = np.where(values > 1e-6 * max(values.max(initial=0), 1e-12), 1 / np.sqrt(np.maximum(values, 1e-12)), 0)
    return (vectors * scale) @ vectors.T


def fit_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY, rounds: int = 50) -> np.ndarray:
    """Weights and bias (last) of the machine with squared hinge loss; y is -1 or 1. Newton steps on the rows inside the margin."""
    theta, ridge = np.zeros(x.shape[1] + 1), penalty * weight.sum() * np.eye(x.shape[1] + 1)
    ridge[-1, -1] = 1e-9
    used = weight > 0
    active = used
    for _ in range(rounds):
        left, right = ridge.copy(), np.zeros(len(theta))
        for at in range(0, len(x), BLOCK):  # the driver holds no second copy of x
            rows = at + np.flatnonzero(active[at : at + BLOCK])
            part = np.c_[x[rows], np.ones(len(rows))]
            weighted = part * weight[rows, None]
            left += weighted.T @ part
            right += weighted.T @ y[rows]
        theta = np.linalg.solve(left, right)
        now = used & (y * (x @ theta[:-1] + theta[-1]) < 1)
        if (now == active).all():
            break
        active = now
    return theta


def fit_logistic(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of P(label = 1), by Newton steps with a small penalty."""
    slope, offset = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * value + offset, -30, 30)))
        w = p * (1 - p)
        grad = np.array([((label - p) * value).sum() - 1e-2 * slope, (label - p).sum() - 1e-2 * offset])
        hess = np.array([[(w * value * value).sum() + 1e-2, (w * value).sum()], [(w * value).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2 / max(1e-12, np.abs(step).max()))
        slope, offset = max(1e-3, slope + step[0]), offset + step[1]
    return float(slope), float(offset)


@dataclass(frozen=True)
class Model:
    """Landmarks, their weights in a unit's value, the bias, and the logistic fit."""

    landmarks: tuple[str, ...]
    alpha: tuple[float, ...]
    bias: float
    slope: float = 1.0
    offset: float = 0.0


class Scorer:
    """Values of texts; the values of units are kept, for they come again and again."""

    def __init__(self, model: Model):
        self.model, self.landmarks, self.alpha, self.known = model, Landmarks(list(model.landmarks)), np.array(model.alpha), {}

    def values(self, texts: Iterable[str]) -> list[float]:
        """Of each text the value of its highest sentence; that of a sentence without units if it has none."""
        parts = [sentences(t) for t in texts]
        if len(self.known) > CACHE_UNITS:
            self.known.clear()
        new = list({w for part in parts for s in part for w in s} - self.known.keys())
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            self.known.update(zip(some, (self.landmarks.kernel(some) @ self.alpha).tolist(), strict=True))
        value, bias = self.known.__getitem__, self.model.bias
        return [max((sum(map(value, s)) for s in part), default=0.0) + bias for part in parts]


def _spread(n: int, most: int) -> list[int]:
    """At most `most` numbers below n, from all over."""
    return list(range(n)) if n <= most else np.linspace(0, n - 1, most).round().astype(int).tolist()


def training_sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """text and toxic (0 or 1) of at most `sample_docs` labelled documents that are not held out, picked by a hash of the id; written once."""
    fits = ~held_out(F.col("doc_id"))
    picked = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & fits)
        .groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    )
    return cut_lineage(id_text(docs).join(F.broadcast(picked), "doc_id").select("text", "toxic"))  # `picked` has at most sample_docs rows


def held_out(doc_id):
    """Whether a row's label must not be learned from; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == FIT_OF_FIVE, F.lit(False))


def _sentence_rows(sample: DataFrame) -> DataFrame:
    """sentence (units joined by blanks), toxic (0 if any clean document has it) and n (a number of one document that has it)."""

    def make():
        def work(batch):
            out = {"sentence": [], "toxic": [], "n": []}
            for n, text, toxic in zip(batch["n"], batch["text"], batch["toxic"], strict=True):
                found = sentences(text)
                for i in _spread(len(found), TOXIC_SENTENCES if toxic else CLEAN_SENTENCES):
                    out["sentence"].append(" ".join(found[i]))
                    out["toxic"].append(toxic)
                    out["n"].append(n)
            yield out

        return work

    numbered = sample.select(F.xxhash64("text").alias("n"), "text", "toxic")
    rows = map_batches(numbered, make, "sentence string, toxic int, n long")
    return cut_lineage(rows.groupBy("sentence").agg(F.min("toxic").alias("toxic"), F.min("n").alias("n")))


def choose_landmarks(rows: DataFrame) -> list[str]:
    """Units of three letters and more: those that tell toxic sentences best, then the most frequent ones."""
    totals = rows.agg(F.sum("toxic").alias("p"), F.count(F.lit(1)).alias("n")).first()
    units = rows.select("toxic", F.explode(F.array_distinct(F.split("sentence", " "))).alias("unit")).where(F.length("unit") >= 3)
    counted = units.groupBy("unit").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("c"))
    toxic, clean = totals.p or 0, totals.n - (totals.p or 0)
    share = F.log((F.col("p") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    telling = counted.where((F.col("p") > 1) & (share >= math.log(TIMES))).withColumn("score", share * F.sqrt("p")).orderBy(F.desc("score"), "unit").limit(LANDMARKS).collect()
    telling = [r for r in telling if r.score >= TELLING * telling[0].score]
    frequent = counted.orderBy(F.desc("c"), "unit").limit(BACKGROUND).collect()
    return list(dict.fromkeys(r.unit for r in [*telling, *frequent]))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model from the bounded sample. Without toxic or clean documents in it every text gets the same score, the share of toxic ones."""
    sample = training_sample(docs, labels, sample_docs)
    rows = _sentence_rows(sample)
    landmarks = Landmarks(choose_landmarks(rows))

    def make():
        def work(batch):
            out = {"toxic": batch["toxic"], "n": batch["n"], "k": []}
            for sentence in batch["sentence"]:
                out["k"].append(landmarks.kernel(sentence.split(" ")).sum(0).astype(np.float32).tobytes())
            yield out

        return work

    got = map_batches(rows.orderBy("sentence"), make, "toxic int, n long, k binary").collect()  # bounded by the sample
    counts = sample.groupBy("toxic").count().collect()
    seen = {r.toxic: r["count"] for r in counts}
    if not landmarks.units or len({r.toxic for r in got}) < 2:
        share = (seen.get(1, 0) + 0.5) / (sum(seen.values()) + 1)
        return Model((), (), 0.0, 1.0, float(np.log(share / (1 - share))))
    root = inverse_root(landmarks.kernel(landmarks.units))
    x = np.frombuffer(b"".join(r.k for r in got), np.float32).reshape(len(got), -1) @ root.astype(np.float32)
    toxic, doc = np.array([r.toxic for r in got]) == 1, np.array([r.n for r in got])
    del got
    kept = np.ones(len(x), bool)
    for _ in range(FITS):
        n_toxic, n_clean = (toxic & kept).sum(), (~toxic & kept).sum()
        weight = np.where(toxic, min(1.0, 0.5 * n_clean / max(1, n_toxic)), 1.0) * kept
        theta = fit_machine(x, np.where(toxic, 1.0, -1.0), weight)
        value = x @ theta[:-1] + theta[-1]
        order = np.lexsort((-value, doc))
        starts = np.r_[True, doc[order][1:] != doc[order][:-1]]
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
        kept = ~toxic
        kept[order[(rank < TOXIC_KEPT) & toxic[order]]] = True
        kept |= toxic & (value > NEAR)
    model = Model(tuple(landmarks.units), tuple((root @ theta[:-1]).tolist()), float(theta[-1]))
    scored = _valued(sample.select(F.col("toxic").cast("long").alias("doc_id"), "text"), model).collect()
    slope, offset = fit_logistic(np.array([r.value for r in scored]), np.array([float(r.doc_id) for r in scored]))
    return Model(model.landmarks, model.alpha, model.bias, slope, offset)


def _valued(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id and value of every row of doc_id and text."""

    def make():
        scorer = per_worker("toxicity", model, lambda: Scorer(model))

        def work(batch):
            yield {"doc_id": batch["doc_id"], "value": scorer.values(batch["text"])}

        return work

    return map_batches(rows.select("doc_id", "text"), make, "doc_id long, value double")


def score_documents(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every text, in one pass without a shuffle.

    A text without units (NULL, empty, white space) gets the value of an empty sentence. Repeated rows are scored each; a NULL id
    stays NULL and is not held out; other columns are ignored; an empty table gives an empty result.
    """
    score = 1 / (1 + F.exp(-(F.col("value") * F.lit(model.slope) + F.lit(model.offset))))
    out = _valued(id_text(docs, id_col, text_col), model).withColumn("score", score)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
