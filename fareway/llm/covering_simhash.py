"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint is given a non-zero vector of radius + 1 bits. Table v (every non-zero vector) keeps the bits
whose vector has an odd product with v. The vectors of at most `radius` differing bits span no more than radius of
the radius + 1 dimensions, so some v is orthogonal to all of them, and its table drops all those bits: each pair
within the radius agrees in some table. Copies share a fingerprint, so tables hold distinct fingerprints only.

Buckets of at most `bucket` fingerprints are compared within and yield one link per member. A larger bucket is not
gathered: each of its fingerprints names the values it becomes when up to two of the bits its table drops are flipped.
Two fingerprints at distance 3 or less meet at a value one flip from one and two from the other; the smallest that is
at most one flip away is linked with all who name the value, and each such link is within the radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage, document_key, keyed_text, map_batches
from fareway.llm.components import components

RADIUS = 3
WIDTH = 3
BUCKET = 4096
BITS = 64


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bits that each table keeps."""
    vectors = [i % ((1 << radius + 1) - 1) + 1 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, 1 << radius + 1)]


def fingerprint(text: str, width: int = WIDTH) -> int:
    """Majority bits of the XXH64 of all word shingles, as an unsigned integer; 0 without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()][: max(1, len(words) - width + 1)]
    ends = ends[width - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)], np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc (the document's key), doc_id and fingerprint (the 64 bits as a long) of every text."""

    def make():
        def work(batch):
            yield {"doc": batch["doc"], "doc_id": batch["doc_id"], "fp": [_signed(fingerprint(x, width)) for x in batch["text"]]}

        return work

    return map_batches(keyed_text(docs, id_col, text_col), make, "doc binary, doc_id long, fp long")


def _bucket_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """One (member, smallest member reached within the bucket) per member that is not that smallest; no pair that could add a link is left out."""
    left, out = np.unique(members), []
    while len(left):
        root, front, left = int(left[0]), [left[0]], left[1:]
        while front and len(left):
            near = np.bitwise_count((left ^ front.pop()).view(np.uint64)) <= radius
            hit, left = left[near], left[~near]
            front.extend(hit)
            out.extend((x, root) for x in hit.tolist())
    return out


def near_links(values: DataFrame, *, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column `fp` that span every component within the radius."""
    if radius != 3:
        raise ValueError("large buckets are resolved for radius 3")
    masks = covering_masks(radius)
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)]
    rows = values.select("fp", F.explode(F.array(*keys)).alias("x")).select("fp", "x.t", "x.key")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = cut_lineage(rows.join(sizes, ["t", "key"]))

    def make():
        def work(batch):
            found = [x for members in batch["members"] for x in _bucket_links(np.array(members, np.int64), radius)]
            yield {"a": [a for a, _ in found], "b": [b for _, b in found]}

        return work

    small = met.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("members"))
    small = map_batches(small.select("members"), make, "a long, b long", rows=64)
    large = met.where(F.col("n") > bucket).select("t", "fp")
    flips = [
        (t, _signed(sum(1 << i for i in chosen)), size < 2)
        for t, mask in enumerate(masks) for size in range(3)
        for chosen in combinations([i for i in range(BITS) if not mask >> i & 1], size)
    ]  # a fixed table of some 7,000 rows
    flip = F.broadcast(values.sparkSession.createDataFrame(flips, "t int, flip long, near boolean"))
    named = large.join(flip, "t").select(F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "fp", "near").distinct()
    hubs = named.where("near").groupBy("value").agg(F.min("fp").alias("hub"))
    spread = named.join(hubs, "value").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return small.unionByName(spread)


def near_duplicates(
    docs: DataFrame, *, width: int = WIDTH, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest id reachable over links), and the keys of both documents.

    A NULL or empty text, or one without words, has fingerprint zero, linked like any other. Repeated rows come out each. A NULL id stays
    NULL and is no component id unless no other id is there. Other columns are ignored; an empty table gives an empty result.
    """
    marked = cut_lineage(fingerprints(docs, width=width, id_col=id_col, text_col=text_col))
    values = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("doc").alias("least_doc")))
    roots = components(near_links(values.select("fp"), bucket=bucket))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("least_doc").alias("first_doc"))
    by_value = rooted.select("fp", "root").join(named, "root").select("fp", "component_id", "first_doc")
    return marked.join(by_value, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "doc", "first_doc")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The first document of each group with all its columns: the least id, then the least text hash; repeated rows go."""
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    mark = "doc_key"
    while mark in docs.columns:  # whatever the columns are called, none is lost
        mark += "_"
    first = groups.select(F.col("first_doc").alias(mark)).distinct()
    return docs.withColumn(mark, document_key(docs[id_col], docs[text_col])).join(first, mark, "left_semi").dropDuplicates([mark]).drop(mark)
