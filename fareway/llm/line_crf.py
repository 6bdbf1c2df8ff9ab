"""Quality rules by labelling lines: a linear-chain conditional random field marks content or boilerplate.

The field has two states, a weight per state and line feature, and a weight per pair of states. It is trained on
a bounded sample of labelled documents: lines of good documents are content, but for repeats of an earlier line of the
document; lines of bad documents are boilerplate. Viterbi decoding labels the lines of every document, and the share of words
in content lines decides whether the document stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import id_text, map_batches

SAMPLE_DOCS = 1500  # labelled documents in the training sample
SAMPLE_LINES = 64  # lines in one training sequence; longer documents give several
MIN_CONTENT_SHARE = 0.5
FEATURES = 12
SYMBOLS = re.compile(rb"[#*$%&|<>]")
END_MARKS = frozenset(b".,;:?!\"')")


def line_features(words: list[bytes], seen: bool) -> list[float]:
    """Features of a line that has a word; all lie in about [0, 2]."""
    joined = b" ".join(words)
    n, size = len(words), len(joined) - len(words) + 1
    letters = joined.translate(None, b"0123456789 !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    upper = len(letters) - len(letters.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbols = len(SYMBOLS.findall(joined))
    marks = sum(w[-1] in b"!|*#$%&" for w in words)
    return [
        1.0, np.log1p(n) / 4, float(joined[-1] in END_MARKS), 5 * symbols / size, len(set(words)) / n, float(seen), size / n / 8,
        upper / max(1, len(letters)), len(letters) / size, float(n < 3), marks / n, joined.count(b"!") / n,
    ]


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of `width` words which the text has twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.uint64, len(words))
    mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    window = np.zeros(n, np.uint64)
    for k in range(width):
        window = window * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, np.flatnonzero(hit), 1)
    np.add.at(marks, np.flatnonzero(hit) + width, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


class Measured:
    """Counts of one text, and its lines with words."""

    def __init__(self, text: str):
        raw = text.encode("utf-8", "surrogatepass")
        seen: set[bytes] = set()
        self.lines: list[list[bytes]] = []
        self.repeat: list[bool] = []
        for line in raw.split(b"\n"):
            if words := line.split():
                self.lines.append(words)
                self.repeat.append(line in seen)
                seen.add(line)
        words = [w for line in self.lines for w in line]
        joined = b"".join(words)
        self.n_words = len(words)
        self.word_chars = len(joined.decode("utf-8", "surrogatepass"))
        self.n_symbols = len(SYMBOLS.findall(raw))
        self.n_dup_lines = sum(self.repeat)
        self.n_repeat_words = repeated_words(words)

    def features(self) -> np.ndarray:
        rows = [line_features(words, seen) for words, seen in zip(self.lines, self.repeat, strict=True)]
        return np.array(rows, np.float64).reshape(-1, FEATURES)


def viterbi(unary: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Best labels of one sequence; state 0 wins ties."""
    n = len(unary)
    if n == 0:
        return np.zeros(0, np.int64)
    a, b = float(unary[0, 0]), float(unary[0, 1])
    (p00, p01), (p10, p11) = pair.tolist()
    back = []
    for u, v in unary[1:].tolist():
        a0, b0, a1, b1 = a + p00, b + p10, a + p01, b + p11
        back.append((b0 > a0, b1 > a1))
        a, b = (b0 if b0 > a0 else a0) + u, (b1 if b1 > a1 else a1) + v
    state, out = int(b > a), np.zeros(n, np.int64)
    for i in range(n - 1, 0, -1):
        out[i] = state
        state = int(back[i - 1][state])
    out[0] = state
    return out


def fit_crf(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, l2: float = 1e-2) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x 2) and pair weights (2 x 2) that maximise the conditional likelihood, by Adam.

    Without sequences all weights are 0, and Viterbi's ties then call every line content (state 0).
    """
    theta = np.zeros(2 * FEATURES + 4)
    cuts = [(x[i : i + SAMPLE_LINES], y[i : i + SAMPLE_LINES]) for x, y in sequences for i in range(0, len(x), SAMPLE_LINES)]
    cuts = [c for c in cuts if len(c[0])]
    if not cuts:
        return theta[:-4].reshape(FEATURES, 2), theta[-4:].reshape(2, 2)
    longest = max(len(x) for x, _ in cuts)
    feats, gold, live = np.zeros((len(cuts), longest, FEATURES)), np.zeros((len(cuts), longest), int), np.zeros((len(cuts), longest), bool)
    for i, (x, y) in enumerate(cuts):
        feats[i, : len(x)], gold[i, : len(x)], live[i, : len(x)] = x, y, True
    one_hot = np.eye(2)[gold] * live[..., None]
    both = live[:, 1:] & live[:, :-1]
    seen_unary = np.einsum("stf,stk->fk", feats, one_hot)
    seen_pair = np.einsum("stj,stk->jk", one_hot[:, :-1] * both[..., None], one_hot[:, 1:])
    mean, square, lines = np.zeros_like(theta), np.zeros_like(theta), live.sum()
    for step in range(1, rounds + 1):
        weights, pair = theta[:-4].reshape(FEATURES, 2), theta[-4:].reshape(2, 2)
        unary = feats @ weights
        forward, backward = np.zeros_like(unary), np.zeros_like(unary)
        forward[:, 0] = unary[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + pair, axis=1) + unary[:, t]
            forward[:, t] = np.where(live[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(pair + (unary[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], new, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        node = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        edge = np.exp(
            forward[:, :-1, :, None] + pair + (unary[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * both[..., None, None]
        grad = np.concatenate([
            (seen_unary - np.einsum("stf,stk->fk", feats, node)).ravel(), (seen_pair - edge.sum((0, 1))).ravel()
        ]) / lines - l2 * theta / len(cuts)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta[:-4].reshape(FEATURES, 2), theta[-4:].reshape(2, 2)


def spread_lines(n: int, sequences: int) -> np.ndarray:
    """Numbers of the lines of at most `sequences` runs of SAMPLE_LINES lines, from all over a document of `n` lines; all lines if they fit."""
    runs = -(-n // SAMPLE_LINES)
    picked = np.arange(runs) if runs <= sequences else np.linspace(0, runs - 1, sequences).round().astype(int)
    lines = (picked[:, None] * SAMPLE_LINES + np.arange(SAMPLE_LINES)).ravel()
    return lines[lines < n]


def training_sequences(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sequences: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and line states of `sample_docs` labelled documents, picked by a hash of the id.

    A document gives at most `sequences` sequences of SAMPLE_LINES lines, from all over it. The features are made by the tasks; the driver gets numbers of the sample alone.
    """
    picked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    )
    texts = id_text(docs).join(F.broadcast(picked), "doc_id")  # `picked` has at most sample_docs rows

    def make():
        def work(batch):
            out = {"doc_id": [], "x": [], "y": []}
            for doc_id, text, quality in zip(batch["doc_id"], batch["text"], batch["quality"], strict=True):
                found = Measured(text)
                out["doc_id"].append(doc_id)
                states = [int(quality == 0 or seen) for seen in found.repeat]
                lines = spread_lines(len(states), sequences)
                out["x"].append(found.features()[lines].ravel().tolist())
                out["y"].append([states[i] for i in lines])
            yield out

        return work

    rows = map_batches(texts, make, "doc_id long, x array<double>, y array<int>").orderBy("doc_id").toLocalIterator()
    for row in rows:
        yield np.array(row.x).reshape(-1, FEATURES), np.array(row.y, int)


def judge(found: Measured, weights: np.ndarray, pair: np.ndarray, min_content_share: float) -> tuple[bool, bool, float, np.ndarray]:
    """Whether the base rules fail, whether the text stays, its share of words in content lines, and the line states."""
    states = viterbi(found.features() @ weights, pair)
    content = sum(len(words) for words, state in zip(found.lines, states, strict=True) if state == 0)
    share = content / found.n_words if found.n_words else 0.0
    failed = found.n_words < 20 or 100 * found.n_repeat_words > 30 * found.n_words
    return failed, not failed and share >= min_content_share, share, states


def label_lines(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray], *, min_content_share: float = MIN_CONTENT_SHARE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Counts, line labels and verdict of every text, in one pass without a shuffle.

    `boilerplate_lines` are the 0-based numbers, among lines that have a word, of lines marked boilerplate. A text
    without words (NULL, empty, white space) has share 0 and fails the base rules. Repeated rows are judged each; a NULL
    id stays NULL; other columns are ignored; an empty table gives an empty result.
    """
    weights, pair = model
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "boilerplate_lines")

    def make():
        def work(batch):
            out = {name: [] for name in names}
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = Measured(text)
                failed, kept, share, states = judge(found, weights, pair, min_content_share)
                values = (
                    doc_id, found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words, failed,
                    kept, share, np.flatnonzero(states).tolist(),
                )
                for name, value in zip(names, values, strict=True):
                    out[name].append(value)
            yield out

        return work

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, content_share double, boilerplate_lines array<int>"
    )
    return map_batches(id_text(docs, id_col, text_col), make, schema)


def fit_on(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """A model from the bounded sample."""
    return fit_crf(list(training_sequences(docs, labels, sample_docs)))


def keep_documents(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], *, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of `docs` whose text passes, with all their columns, in one pass without a shuffle."""
    weights, pair = model
    least = limits.get("min_content_share", MIN_CONTENT_SHARE)

    @F.pandas_udf("boolean")
    def passes(text: pd.Series) -> pd.Series:
        return text.map(lambda t: judge(Measured(t or ""), weights, pair, least)[1])

    return docs.where(passes(docs[text_col].cast("string")))
