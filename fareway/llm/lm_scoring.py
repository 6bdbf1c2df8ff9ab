"""Language-model scores of documents: a byte-level PPM trie beside a smoothed word-frequency model.

Both models learn from the training part: rows whose crc32 of the id, as text, leaves another remainder than `held` modulo `folds`.
Word counts and counts of byte strings come from one pass with one aggregation.

Words of more than N / `frequent` of the N training tokens are at most `frequent` by arithmetic; they are
broadcast, and a document sums them on the spot. Its other words go out, one row per word and document, to meet their counts in a join.

The trie is broadcast as long as it has at most `entries` strings. A larger trie is cut by the last two symbols of the context, which no
shorter context loses, and one part after the other scores its own places; results are the same.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter

import numpy as np
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage, id_text, map_batches, per_worker
from fareway.llm.ppm import BASE, Model, count_codes

ORDER = 4
FREQUENT = 500_000
ENTRIES = 3_000_000
FLUSH = 200_000


def _tokens(text: str) -> tuple[bytes, list[bytes]]:
    raw = text.encode("utf-8", "surrogatepass").lower()
    return raw, raw.split()


def _held(doc_id: int | None, folds: int, held: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == held


def corpus_counts(docs: DataFrame, *, order: int, folds: int, held: int) -> DataFrame:
    """(word, code, n) over the training part: counts of words (the end token as the empty word) and of byte strings."""

    def make():
        words, codes = Counter(), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def flush_words():
            out = {"word": list(words), "code": [None] * len(words), "n": list(words.values())}
            words.clear()
            return out

        def merged():
            keys, at = np.unique(np.concatenate([c for c, _ in codes]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in codes]), len(keys)).astype(np.int64)

        def flush_codes():
            keys, n = merged()
            codes.clear()
            for at in range(0, len(keys), FLUSH):
                part = slice(at, at + FLUSH)
                yield {"word": [None] * len(keys[part]), "code": keys[part], "n": n[part]}

        def work(batch):
            texts = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if not _held(doc_id, folds, held):
                    raw, own = _tokens(text)
                    words.update(own)
                    words[b""] += 1
                    texts.append(raw)
            if texts:
                codes.append(count_codes(texts, order))
            if sum(len(c) for c, _ in codes) > 10 * FLUSH:
                codes[:] = [merged()]
                if len(codes[0][0]) > 5 * FLUSH:
                    yield from flush_codes()
            if len(words) > FLUSH:
                yield flush_words()

        def rest():
            if words:
                yield flush_words()
            if codes:
                yield from flush_codes()

        work.rest = rest
        return work

    rows = map_batches(docs, make, "word binary, code long, n long")
    return rows.groupBy("word", "code").agg(F.sum("n").alias("n"))


def _parts(codes: DataFrame, entries: int) -> list[tuple[int, int]]:
    """Ranges of the last two context symbols with at most `entries` strings each, or one group alone."""
    total = codes.count()
    if total <= entries:
        return [(0, BASE**2)]
    sizes = codes.groupBy(F.expr(f"code div {BASE} % {BASE**2}").alias("g")).count().orderBy("g").collect()  # 66,049 groups at most
    cuts, held = [0], 0
    for g, n in sizes:
        if held and held + n > entries:
            cuts.append(g)
            held = 0
        held += n
    return list(zip(cuts, [*cuts[1:], BASE**2], strict=True))


def _columns(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = rows.select("code", "n").toArrow()
    codes, counts = table["code"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(codes)
    return codes[order], counts[order]


def score_documents(
    docs: DataFrame, *, order: int = ORDER, folds: int = 7, held: int = 2, frequent: int = FREQUENT, entries: int = ENTRIES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    `score` is the trie's log10 probability of the text's bytes, A-Z in lower case, and its end. A NULL or empty text has the end alone.
    Repeated rows are learned and scored each. A NULL id counts as the empty text for the split and stays NULL. Other columns are ignored.
    Without training rows each token has probability 1 and each byte 1/257; an empty table gives an empty result.
    """
    spark, docs = docs.sparkSession, id_text(docs, id_col, text_col)
    counts = cut_lineage(corpus_counts(docs, order=order, folds=folds, held=held))
    words, codes = counts.where("word is not null").select("word", "n"), counts.where("code is not null").select("code", "n")
    kinds, total = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    common = {bytes(w): n for w, n in words.where(F.col("n") * frequent > total).toLocalIterator()}
    common_words = spark.sparkContext.broadcast(common)
    bottom, run = total + kinds + 1, uuid.uuid4().hex
    parts = _parts(codes, entries)
    group = F.expr(f"code div {BASE} % {BASE**2}")
    short = None
    if len(parts) > 1:
        short = _columns(codes.groupBy((F.col("code") % BASE**2).alias("code")).agg(F.sum("n").alias("n")))

    def part_model(part):
        rows = codes if len(parts) == 1 else codes.where((group >= part[0]) & (group < part[1]))
        return spark.sparkContext.broadcast(cloudpickle.dumps(Model(*_columns(rows), order, short)))

    docs = docs.withColumn("ppm", F.lit(0.0))
    for part in parts[:-1]:
        docs = cut_lineage(_add_part(docs, part_model(part), part))
    last, last_part = part_model(parts[-1]), parts[-1] if len(parts) > 1 else None

    def make():
        known = per_worker("words", run, lambda: {w: math.log10((n + 1) / bottom) for w, n in common_words.value.items()})
        model = per_worker("trie", run, lambda: cloudpickle.loads(last.value))
        state = [TaskContext.get().partitionId() << 36]

        def work(batch):
            raws = []
            out = {x: [] for x in ("uid", "word", "times", "doc_id", "n_tokens", "n_known", "base", "score")}
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                raw, own = _tokens(text)
                raws.append(raw)
                found = Counter(own)
                found[b""] = 1
                base, n_known, uid = 0.0, 0, state[0]
                state[0] += 1
                rare = []
                for word, times in found.items():
                    if (log := known.get(word)) is None:
                        rare.append((word, times))
                    else:
                        base += times * log
                        n_known += times
                # the document's own row: a word with a blank is no word, so it meets no count
                out["uid"] += [uid] * (len(rare) + 1)
                out["word"] += [b" %d" % uid, *(w for w, _ in rare)]
                out["times"] += [0, *(n for _, n in rare)]
                out["doc_id"] += [doc_id] + [None] * len(rare)
                out["n_tokens"] += [len(own) + 1] + [0] * len(rare)
                out["n_known"] += [n_known] + [0] * len(rare)
                out["base"] += [base] + [0.0] * len(rare)
                out["score"].append((len(rare)))
            scores = model.log10(raws, last_part) + np.array(batch["ppm"])
            out["score"] = [x for score, n in zip(scores.tolist(), out["score"], strict=True) for x in [score] + [0.0] * n]
            yield out

        return work

    rows = map_batches(
        docs, make, "uid long, word binary, times long, doc_id long, n_tokens long, n_known long, base double, score double"
    )
    met = rows.join(words, "word", "left")
    log = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(bottom)))
    summed = met.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(F.col("times") > 0, F.col("times") * log).otherwise(0.0)).alias("base_score"),
        F.sum("score").alias("score"),
    )
    is_held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == held
    return summed.select(
        "doc_id", is_held.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _add_part(docs: DataFrame, model, part: tuple[int, int]) -> DataFrame:
    def make():
        part_of_trie = cloudpickle.loads(model.value)

        def work(batch):
            scores = part_of_trie.log10([_tokens(x)[0] for x in batch["text"]], part) + np.array(batch["ppm"])
            yield {"doc_id": batch["doc_id"], "text": batch["text"], "ppm": scores}

        return work

    return map_batches(docs, make, "doc_id long, text string, ppm double")
