"""Substring dedup by paragraphs: MinHash banding, exact Jaccard, and components of what is alike.

A paragraph is a line of at least `min_words` words. Equal paragraphs are one text. Distinct texts that agree in one of BANDS bands of ROWS
MinHash values meet in a bucket: with 16 bands of 4, a pair at Jaccard 0.8 meets with probability 0.9998. In a bucket the exact Jaccard of the
sets of five-word shingles decides; a bucket of more than `bucket` texts is compared in blocks, each pair of blocks by another
task, so no bucket is gathered whole. Each bucket yields one link per text that it joins, never all pairs. Components of the links
are clusters; the earliest paragraph of a cluster stays.

A paragraph that is wrapped elsewhere, or lies inside other text, is no line. For these, `repeated_passages` cuts the words of a document, whatever
their lines, into windows that the words themselves choose: of each SPACING successive windows of WINDOW words the one with the least
hash. Two documents that share SPACING + WINDOW - 1 = 50 words choose a window in common, and no window is shared below WINDOW words. A
window is too short to hold an edit at Jaccard 0.8, so equal windows are one cluster; what an edit splits is found on either side of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage, id_text, keyed_text, map_batches
from fareway.llm.components import components

BANDS, ROWS = 16, 4
MIN_WORDS = 50
WIDTH = 5
SIMILARITY = 0.8
BUCKET = 2048
BROADCAST_TEXTS = 1_000_000
WINDOW, SPACING = 32, 19
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BROADCAST_WINDOWS = 2_000_000
TASK_PLACES = 20_000
TOGETHER = 30_000  # words that are hashed in one step
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SEEDS = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def shingles(paragraphs: list[list[bytes]], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word shingles of each paragraph, repeats included, end to end, and where each begins; fewer words are one shingle."""
    import xxhash

    sizes = np.fromiter(map(len, paragraphs), np.int64, len(paragraphs))
    counts = np.maximum(1, sizes - width + 1)
    begins = np.cumsum(counts) - counts
    first = np.arange(counts.sum()) + np.repeat(np.cumsum(sizes) - sizes - begins, counts)
    held = np.repeat(np.minimum(sizes, width), counts)
    hashes = np.zeros(sizes.sum() + width, np.uint64)
    hashes[: len(hashes) - width] = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(paragraphs)), np.uint64, sizes.sum())
    out = np.zeros(len(first), np.uint64)
    for k in range(width):
        out = np.where(held > k, out * GOLDEN + _mix(hashes + np.uint64(k))[first + k], out)
    return _mix(out), begins


def bands(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A row per paragraph, one 64-bit key per band, over the least of ROWS hash functions each."""
    least, product = np.empty((BANDS * ROWS, len(begins)), np.uint64), np.empty_like(values)
    for seed, row in zip(SEEDS, least, strict=True):
        np.minimum.reduceat(np.multiply(values, seed, out=product), begins, out=row)
    keys = np.arange(BANDS, dtype=np.uint64)[:, None]
    for row in least.reshape(BANDS, ROWS, -1).swapaxes(0, 1):
        keys = _mix(keys * GOLDEN + row)
    return keys.T.view(np.int64)


def _together(found: Iterable[tuple], words: int = TOGETHER) -> Iterator[list[tuple]]:
    """Lists of the tuples, whose last entries are paragraphs, of about `words` words each."""
    held, n = [], 0
    for one in found:
        held.append(one)
        n += len(one[-1])
        if n >= words:
            yield held
            held, n = [], 0
    if held:
        yield held


def jaccard_links(names: list[bytes], sets: list[np.ndarray], similarity: float) -> list[tuple[bytes, bytes]]:
    """(text, least text of its part) for the parts that links of at least `similarity` join; each set is compared until it is joined."""
    order = sorted(range(len(names)), key=names.__getitem__)
    names, sets = [names[i] for i in order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    values, number = np.unique(flat, return_inverse=True)
    by_value = np.argsort(number, kind="stable")
    begins = np.searchsorted(number[by_value], np.arange(len(values) + 1))
    holders, ends = owner[by_value], np.cumsum(sizes)
    free, out = np.ones(len(sets), bool), []
    for root in range(len(sets)):
        if not free[root]:
            continue
        free[root] = False
        front = [root]
        while front and free.any():
            x = front.pop()
            mine = number[ends[x] - sizes[x] : ends[x]]
            both = np.bincount(np.concatenate([holders[begins[v] : begins[v + 1]] for v in mine]), minlength=len(sets))
            # both / union >= similarity, in whole numbers of 1/1000
            near = np.flatnonzero(free & (1000 * both >= round(1000 * similarity) * (sizes + sizes[x] - both)))
            free[near] = False
            front += near.tolist()
            out += [(names[i], names[root]) for i in near]
    return out


def _paragraphs(text: str, min_words: int):
    for line, raw in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        words = raw.lower().split()
        if len(words) >= min_words:
            yield line, words


def repeated_paragraphs(
    docs: DataFrame, *, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, bucket: int = BUCKET,
    broadcast_texts: int = BROADCAST_TEXTS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per paragraph to remove: doc, doc_id, line, n_words, and the place of the paragraph that stays for it.

    Paragraphs are compared by their words, A-Z in lower case. The earliest of a cluster, by id and then line, stays, so a paragraph that a
    document repeats goes too. Rows alike in id and text are one document. A NULL id sorts last and stays NULL. NULL and empty texts
    have no paragraphs. Other columns are ignored; an empty table gives an empty result.
    """
    keyed = keyed_text(docs, id_col, text_col)

    def find():
        import xxhash

        def work(batch):
            texts = zip(batch["doc"], batch["doc_id"], batch["text"], strict=True)
            for part in _together((doc, doc_id, line, words) for doc, doc_id, text in texts for line, words in _paragraphs(text, min_words)):
                doc, doc_id, line, words = zip(*part, strict=True)
                yield {
                    "doc": doc, "doc_id": doc_id, "line": line, "n_words": list(map(len, words)),
                    "p": [xxhash.xxh3_128_digest(b" ".join(w)) for w in words], "bands": bands(*shingles(words)).tolist(),
                }

        return work

    rows = map_batches(keyed, find, "doc binary, doc_id long, line int, n_words int, p binary, bands array<long>")
    places = cut_lineage(rows.dropDuplicates(["doc", "line"]))
    texts = places.groupBy("p").agg(F.first("bands").alias("bands"))
    keys = texts.select("p", F.explode("bands").alias("b"))
    # bands that hold the same texts are one bucket
    buckets = (
        keys.groupBy("b").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("p")).alias("x"), F.bit_xor(F.xxhash64("p", F.lit(1))).alias("y"))
        .where("n > 1").groupBy("n", "x", "y").agg(F.min("b").alias("b"))
    )
    met = cut_lineage(keys.join(buckets.select("b", "n"), "b"))
    sets = _shingle_sets(keyed, places, met.select("p").distinct(), min_words, broadcast_texts)
    size = max(1, bucket // 2)
    n_blocks = F.when(F.col("n") <= bucket, 1).otherwise(F.ceil(F.col("n") / size).cast("int"))
    dealt = met.withColumn("m", n_blocks).withColumn("i", F.pmod(F.xxhash64("p"), "m")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    dealt = dealt.select("b", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "p")

    def verify():
        def work(batch):
            found = [x for members in batch["members"] for x in jaccard_links([m["p"] for m in members], [np.array(m["s"], np.int64).view(np.uint64) for m in members], similarity)]
            yield {"a": [a for a, _ in found], "b": [b for _, b in found]}

        return work

    members = dealt.join(sets, "p").groupBy("b", "i", "j").agg(F.collect_list(F.struct("p", "s")).alias("members"))
    links = map_batches(members.select("members"), verify, "a binary, b binary", rows=16)
    roots = components(links)
    clustered = places.drop("bands").join(roots.withColumnRenamed("node", "p"), "p", "left").withColumn("cluster", F.coalesce("root", "p"))
    first = clustered.groupBy("cluster").agg(F.count("*").alias("n"), F.min("doc").alias("kept_doc")).where("n > 1")
    line = clustered.join(first.select("cluster", F.col("kept_doc").alias("doc")), ["cluster", "doc"]).groupBy("cluster").agg(
        F.min(F.col("line")).alias("kept_line"), F.min("doc_id").alias("kept_doc_id")
    )
    return (
        clustered.join(first, "cluster").join(line, "cluster").where("doc <> kept_doc or line <> kept_line")
        .select("doc", "doc_id", "line", "n_words", "kept_doc_id", "kept_line")
    )


def _shingle_sets(keyed: DataFrame, places: DataFrame, wanted: DataFrame, min_words: int, broadcast_texts: int) -> DataFrame:
    """(p, s): the sorted shingle hashes of each wanted text.

    A wanted list of bounded length goes to every task; a longer one picks the documents, and then the texts, by joins.
    """
    few = wanted.count() <= broadcast_texts
    listed = keyed.sparkSession.sparkContext.broadcast({bytes(x) for (x,) in wanted.toLocalIterator()} if few else None)
    if not few:
        holders = places.join(wanted, "p", "left_semi").groupBy("p").agg(F.min("doc").alias("doc")).select("doc").distinct()
        keyed = keyed.join(holders, "doc", "left_semi")

    def make():
        import xxhash

        chosen, done = listed.value, set()

        def new(texts):
            for text in texts:
                for _, words in _paragraphs(text, min_words):
                    p = xxhash.xxh3_128_digest(b" ".join(words))
                    if p not in done and (chosen is None or p in chosen):
                        if len(done) < broadcast_texts:
                            done.add(p)
                        yield p, words

        def work(batch):
            for part in _together(new(batch["text"])):
                values, begins = shingles([words for _, words in part])
                yield {"p": [p for p, _ in part], "s": [np.unique(x).view(np.int64) for x in np.split(values, begins[1:])]}

        return work

    made = map_batches(keyed.select("text"), make, "p binary, s array<long>")
    if not few:
        made = made.join(wanted, "p", "left_semi")
    return cut_lineage(made.dropDuplicates(["p"]))


def _slide(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """`pick` over each run of `width` neighbours, from runs of half the length."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x, have = pick(x[:-step], x[step:]), have + step
    return x


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^1, base^2, ... and their inverses modulo 2^64."""
    return tuple(np.cumprod(np.full(size, x, np.uint64)) for x in (base, pow(base, -1, 2**64)))


def chosen_windows(words: np.ndarray, window: int = WINDOW, spacing: int = SPACING) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, 64-bit hash, 32-bit hash) of the windows that the word hashes choose; of equal least hashes all are chosen."""
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)
    mixed = _mix(words)

    def hashes(base: int) -> np.ndarray:
        # sum of word * base^place, by differences of running sums; base^-place makes it independent of the place
        powers, inverse = _powers(base, 1 << len(words).bit_length())
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mixed * powers[: len(words)], out=sums[1:])
        return _mix((sums[window:] - sums[:-window]) * inverse[:n])

    first, width = hashes(BASES[0]), min(spacing, n)
    least = _slide(np.minimum, first, width)
    edge = np.zeros(width - 1, np.uint64)
    # a window is chosen where it is the least of some run that holds it: the greatest of the least values of those runs
    places = np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge]), width) == first)
    second = hashes(BASES[1])[places] >> np.uint64(32)
    return places.astype(np.int32), first[places].view(np.int64), second.astype(np.uint32).view(np.int32)


def repeated_passages(
    docs: DataFrame, *, window: int = WINDOW, spacing: int = SPACING, broadcast_windows: int = BROADCAST_WINDOWS, task_places: int = TASK_PLACES,
    own_repeats: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per passage to remove: doc_id, word (the number of its first word), n_words, and the place of the copy of its first window that stays.

    Every run of `window + spacing - 1` words that an earlier document holds too, wrapped or embedded in any way, yields a passage of at least `window` of
    its words; runs of less than `window` words yield none. Words are parted by white space and compared with A-Z in lower case. The
    earliest holder of a window, by id (NULL last), text and place, keeps it. What the earliest holder itself repeats goes only with `own_repeats`,
    less what overlaps the copy that stays. Rows alike in id and text are one document. NULL, empty and short texts have no passages. Other columns are
    ignored; an empty table gives an empty result.
    """
    def find():
        import xxhash

        def work(batch):
            out = {"doc_id": [], "x": [], "h": [], "g": [], "at": []}
            for doc_id, x, text in zip(batch["doc_id"], batch["x"], batch["text"], strict=True):
                words = text.encode("utf-8", "surrogatepass").lower().split()
                if len(words) >= window:
                    at, h, g = chosen_windows(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), window, spacing)
                    for name, value in zip(out, (doc_id, x, h, g, at), strict=True):
                        out[name].append(value)
            yield out

        return work

    texts = id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("x"), "text")
    chosen = cut_lineage(map_batches(texts, find, "doc_id long, x long, h array<long>, g array<int>, at array<int>"))
    shared = cut_lineage(chosen.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    if shared.count() <= broadcast_windows:
        shared = F.broadcast(shared)
    places = chosen.select("doc_id", "x", F.explode(F.arrays_zip("h", "g", "at")).alias("w")).select("doc_id", "x", "w.h", "w.g", "w.at").join(shared, "h")
    # a window with many places is dealt over as many salts as its places fill tasks; what stays of it is one row, repeated for each salt
    salts = F.ceil(F.col("n") / task_places).cast("int")
    kept = places.groupBy("h", "g", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "x", "at")).alias("kept"))
    kept = kept.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n")
    later = places.withColumn("salt", F.pmod(F.xxhash64("doc_id", "x", "at"), salts).cast("int")).join(kept, ["h", "g", "salt"])
    same = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("x") == F.col("kept.x"))
    begin = F.when(same, F.greatest("at", F.col("kept.at") + window)).otherwise(F.col("at"))
    later = (later if own_repeats else later.where(~same)).select(
        "doc_id", "x", begin.alias("word"), (F.col("at") + window).alias("end"), F.col("kept.doc_id").alias("kept_doc_id"),
        (F.col("kept.at") + F.col("word") - F.col("at")).alias("kept_word"),
    ).where("word < end").dropDuplicates(["doc_id", "x", "end"])
    line = Window.partitionBy("doc_id", "x").orderBy("end")
    # windows of one length come in the order of their ends; one that begins behind all ends before it opens a passage
    opened = later.withColumn("new", F.coalesce((F.col("word") > F.lag("end").over(line)).cast("int"), F.lit(1)))
    numbered = opened.withColumn("passage", F.sum("new").over(line))
    return numbered.groupBy("doc_id", "x", "passage").agg(
        F.min("word").alias("word"), (F.max("end") - F.min("word")).alias("n_words"),
        F.min(F.struct("word", "end", "kept_doc_id", "kept_word")).alias("first"),
    ).select("doc_id", "word", "n_words", "first.kept_doc_id", "first.kept_word")
