"""Vector codes by integer Lloyd rounds, with nearest entries found in the Walsh-Hadamard domain.

A vector becomes integers floor(scale * x) and is cut into equal parts; each part position has a codebook. Parts and entries are
padded with zeros to a power of two `m` and transformed by the Walsh-Hadamard matrix, whose rows are orthogonal with squared length
m: the squared differences of two transforms sum to m times the squared distance. Rows are taken in sequency order (few sign changes
first), where most of the difference usually lies. A partial sum is a lower bound, so an entry goes as soon as its sum passes the
full sum of an entry already measured; entries that stay to the end have exact distances. All of it is integer arithmetic.

A round is one pass over the vectors: each task sums the parts of each entry, and Spark adds these sums. The driver holds the
codebooks alone, whose size is set by the parameters and the vector length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage
from fareway.operators.skew import lookup_join

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
FIRST = 4  # transform rows measured before any entry goes
STEP = 2  # rows between two eliminations after that
FEW = 16  # pairs go on one by one when at most this part of them is left
SLICE = 128  # vectors compared at once; their sums stay in the processor's cache
BROADCAST_BYTES = 8_000_000  # totals per label up to this measured size are broadcast


def walsh(width: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of the least power of two that is at least `width`, rows in sequency order."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < width:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    changes = (matrix[:, 1:] != matrix[:, :-1]).sum(1)
    return matrix[np.argsort(changes, kind="stable")]


def transform(rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Transforms of integer rows, zero-padded to the width of `matrix`."""
    return rows @ matrix[:, : rows.shape[1]].T


def largest_component(width: int) -> int:
    """Components up to this size cannot make a scaled distance that a long does not hold."""
    m = len(walsh(width))
    return int(((2**63 - 1) // m) ** 0.5) // (2 * m)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and m-fold squared distance to the nearest entry (ties: the lower index), both in the transformed domain.

    Sums are kept for all pairs while many are left, since adding to a block costs less than picking pairs from it; once most
    entries are out, the pairs that are left go on by themselves.
    """
    rows, width = points.shape
    columns = np.ascontiguousarray(entries.T)
    partial, gap = np.zeros((rows, len(entries)), np.int64), np.empty((rows, len(entries)), np.int64)
    done, bound = 0, None
    while done < width:
        until = min(width, FIRST if bound is None else done + STEP)
        for k in range(done, until):
            np.subtract(points[:, k, None], columns[k], out=gap)
            np.multiply(gap, gap, out=gap)
            partial += gap
        done = until
        if bound is None:  # the full sum of a likely entry bounds the least sum from above
            bound = ((points - entries[partial.argmin(1)]) ** 2).sum(1)
        alive = partial <= bound[:, None]
        if np.count_nonzero(alive) * FEW <= alive.size:
            break
    row, entry = np.nonzero(alive)
    total = partial[row, entry]
    for k in range(done, width, STEP):
        apart = points[row, k : k + STEP] - entries[entry, k : k + STEP]
        total += (apart * apart).sum(1)
        stays = total <= bound[row]
        row, entry, total = row[stays], entry[stays], total[stays]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(total, starts)
    hits = np.flatnonzero(total == np.repeat(least, np.diff(np.r_[starts, len(row)])))
    _, firsts = np.unique(row[hits], return_index=True)  # entries rise within a row, so the first hit is the lowest index
    return entry[hits[firsts]], least


def assign(parts: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x parts) and squared distances summed over parts; `parts` is rows x parts x width, `codebooks` parts x entries x width."""
    matrix = walsh(parts.shape[2])
    codes, error = np.zeros(parts.shape[:2], np.int64), np.zeros(len(parts), np.int64)
    for p, book in enumerate(codebooks):
        entries = transform(book, matrix)
        for at in range(0, len(parts), SLICE):
            points = transform(parts[at : at + SLICE, p], matrix)
            codes[at : at + SLICE, p], scaled = nearest(points, entries)
            error[at : at + SLICE] += scaled // len(matrix)
    return codes, error


def _integers(column: pa.ListArray, scale: int, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Integer vectors of the rows that count, and which rows these are.

    NULL vectors and vectors with a NULL or non-finite component do not count. `width`: the only length allowed.
    """
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.slice(column.offsets[0].as_py(), int(lengths.sum()))
    floats = np.asarray(values.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)  # NULL becomes NaN
    bad = np.zeros(len(column), np.int64)
    np.add.at(bad, np.repeat(np.arange(len(column)), lengths), ~np.isfinite(floats))
    good = (bad == 0) & column.is_valid().to_numpy(zero_copy_only=False)
    if width is None:
        width = int(lengths[good][0]) if good.any() else 0
    if (lengths[good] != width).any():
        raise ValueError(f"vectors of different lengths; expected {width} components")
    kept = floats[np.repeat(good, lengths)].reshape(int(good.sum()), width)
    whole = np.floor(scale * kept)
    return whole.astype(np.int64) if not whole.size or np.abs(whole).max() < 2**62 else whole, good


def _checked(whole: np.ndarray, parts: int) -> np.ndarray:
    """rows x parts x width, if no distance can overflow."""
    width = whole.shape[1] // parts
    if whole.size and np.abs(whole).max() > largest_component(width):
        raise ValueError(f"integer components beyond {largest_component(width)} would overflow a long distance")
    return whole.reshape(len(whole), parts, width)


def first_codebooks(vectors: DataFrame, *, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """parts x entries x width: the parts of the vectors with the smallest ids (NULL ids last, equal ids by vector); None without vectors."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.col("vector").isNotNull() & fine).orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    if not rows:
        return None
    if len({len(r.vector) for r in rows}) > 1 or len(rows[0].vector) % parts or not rows[0].vector:
        raise ValueError(f"all vectors need one length that {parts} divides")
    whole, _ = _integers(pa.array([r.vector for r in rows], pa.list_(pa.float64())), scale, None)
    return _checked(whole, parts).transpose(1, 0, 2).copy()


def part_sums(codes: np.ndarray, parts: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """How many parts each entry got, and their sums: parts x entries, parts x entries x width."""
    counts, sums = np.zeros((parts.shape[1], entries), np.int64), np.zeros((parts.shape[1], entries, parts.shape[2]), np.int64)
    for p in range(parts.shape[1]):
        counts[p] = np.bincount(codes[:, p], minlength=entries)
        order = np.argsort(codes[:, p], kind="stable")
        used = np.flatnonzero(counts[p])
        if len(used):
            starts = np.r_[0, np.cumsum(counts[p][used])[:-1]]
            sums[p, used] = np.add.reduceat(parts[order, p], starts, axis=0)
    return counts, sums


def _round(vectors: DataFrame, codebooks: np.ndarray, scale: int) -> np.ndarray:
    """The codebooks after one pass: entries become the floored means of their parts, unused ones stay."""
    parts, entries, width = codebooks.shape
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            cut = _checked(_integers(batch.column("vector"), scale, parts * width)[0], parts)
            more = part_sums(assign(cut, codebooks)[0], cut, entries)
            counts += more[0]
            sums += more[1]
        part, entry = np.nonzero(counts)
        used = sums[part, entry]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(used.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), lists], schema=schema)

    sums = vectors.select("vector").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    total = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[k]) for k in range(width))).alias("sums"))
    out = codebooks.copy()
    for row in total.collect():  # at most parts x entries rows
        out[row.part, row.entry] = np.array(row.sums, np.int64) // row.n
    return out


def train(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray | None:
    """Codebooks (parts x entries x width) after `rounds` passes; None if no vector counts. `vectors` has vec_id and vector."""
    codebooks = first_codebooks(vectors, parts=parts, entries=entries, scale=scale)
    if codebooks is not None:
        for _ in range(rounds):
            codebooks = _round(vectors, codebooks, scale)
    return codebooks


def digest(codebooks: np.ndarray | None) -> str:
    """SHA-256 of the entries' components in decimal, by part, entry and position."""
    flat = [] if codebooks is None else codebooks.ravel().tolist()
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def encode(vectors: DataFrame, codebooks: np.ndarray | None, label_type: str, *, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code and error of every vector that counts, in one pass without a shuffle."""
    schema = f"vec_id long, label {label_type}, code string, error long"
    if codebooks is None:
        return vectors.sparkSession.createDataFrame([], schema)
    parts, _, width = codebooks.shape
    hex_digits = np.array([f"{i:02x}" for i in range(codebooks.shape[1])], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, good = _integers(batch.column("vector"), scale, parts * width)
            codes, error = assign(_checked(whole, parts), codebooks)
            kept = batch.filter(pa.array(good))
            text = hex_digits[codes].sum(1) if len(codes) else []
            yield pa.RecordBatch.from_arrays(
                [kept.column("vec_id"), kept.column("label"), pa.array(text, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    return vectors.select("vec_id", "label", "vector").mapInArrow(run, schema)


def _with_label_error(coded: DataFrame) -> DataFrame:
    """`coded` with the error summed over rows of its label; NULL labels are one label.

    The sums have a row per label. They are broadcast if their measured size is small; beyond that hot labels are salted.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("NULL"))
    keyed = coded.withColumn("label_key", key)
    totals = cut_lineage(keyed.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")))
    size = totals.agg(F.sum(F.length("label_key") * 4 + 48)).first()[0] or 0
    sums = totals.drop("rows")
    joined = keyed.join(F.broadcast(sums), "label_key") if size <= BROADCAST_BYTES else lookup_join(keyed, sums, "label_key", "inner")
    return joined.drop("label_key")


def compress(
    embeddings: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", use: Callable[[np.ndarray | None], None] | None = None,
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that counts.

    Rows whose vector is NULL or has a NULL, NaN or infinite component are left out. Other vectors must have one length that `parts`
    divides, else the job raises, as it does where a distance could pass the range of a long. Equal ids come out each; the codebooks
    start from the rows with the smallest ids, NULL ids last and equal ids by vector, and have fewer entries if there are fewer rows.
    Further columns are ignored; a table without vectors gives an empty result. `use` is given the final codebooks.
    """
    vectors = embeddings.select(
        embeddings[id_col].cast("long").alias("vec_id"), embeddings[label_col].alias("label"), embeddings[vector_col].cast("array<double>").alias("vector")
    )
    codebooks = train(vectors, parts=parts, entries=entries, rounds=rounds, scale=scale)
    if use:
        use(codebooks)
    coded = cut_lineage(encode(vectors, codebooks, vectors.schema["label"].dataType.simpleString(), scale=scale))
    out = _with_label_error(coded)
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
