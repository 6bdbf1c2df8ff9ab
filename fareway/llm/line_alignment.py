"""Line dedup by pairwise alignment: the later of two overlapping documents loses the blocks they share.

Documents are paired by evidence: lines that at most RARE documents have, and runs of adjacent lines, however many documents have them; a line or run
needs as many words as a block. Every block holds such a run, and the run has an owner of its own, so a block is found whose single lines
all stand in other, earlier documents. Each piece of evidence belongs to the earliest document with it and pairs that one with each
later one: one pair per document and piece at most, never all pairs. A frequent line by itself is no evidence. The pair's lines, frequent ones
too, are aligned by patience diff, and aligned blocks are deleted from the later document. Equal documents are settled before: all but
the earliest are deleted whole, so a group of copies is aligned once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import cut_lineage, document_key, keyed_text, map_batches

MIN_WORDS = 5  # words of a block that is deleted
RARE = 50  # documents that may have a line that is evidence by itself
SHORT, LINE, RUN = 0, 1, 2  # kinds of evidence: a line of too few words is none, it is only counted

Entry = tuple[int, int, int, int, int]  # place in the later document, place in the earlier, line, words, line hash


def _chain(entries: list[Entry]) -> list[Entry]:
    """The longest run of entries, sorted by the first place, whose second places rise (patience sorting)."""
    tops, last, before = [], [], {}
    for i, e in enumerate(entries):
        pile = bisect_left(tops, e[1])
        before[i] = last[pile - 1] if pile else None
        if pile == len(tops):
            tops.append(e[1])
            last.append(i)
        else:
            tops[pile], last[pile] = e[1], i
    out, i = [], last[-1] if last else None
    while i is not None:
        out.append(entries[i])
        i = before[i]
    return out[::-1]


def patience(entries: list[Entry]) -> list[Entry]:
    """Aligned entries: lines that are unique come first, then the stretches between them, where more lines may be unique."""
    todo, out = [sorted(entries)], []
    while todo:
        part = todo.pop()
        times = Counter(e[4] for e in part)
        unique = [e for e in part if times[e[4]] == 1]
        chain = _chain(unique or part)
        out += chain
        if not unique or len(unique) == len(part):
            continue
        edges = [(-1, -1), *((e[0], e[1]) for e in chain), (1 << 60, 1 << 60)]
        gaps: list[list[Entry]] = [[] for _ in edges[1:]]
        firsts = [e[0] for e in chain]
        for e in part:
            gap = bisect_left(firsts, e[0])
            (a0, b0), (a1, b1) = edges[gap], edges[gap + 1]
            if a0 < e[0] < a1 and b0 < e[1] < b1:
                gaps[gap].append(e)
        todo += [gap for gap in gaps if gap and len(gap) < len(part)]
    return sorted(out)


def blocks(aligned: list[Entry], min_words: int) -> list[int]:
    """Lines of the aligned blocks of at least `min_words` words; a block goes on while both documents go to their next line."""
    out, block = [], []
    for e in [*aligned, None]:
        if block and (e is None or (e[0], e[1]) != (block[-1][0] + 1, block[-1][1] + 1)):
            if sum(x[3] for x in block) >= min_words:
                out += [x[2] for x in block]
            block = []
        if e is not None:
            block.append(e)
    return out


def runs(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """First and last line of the runs that are evidence: from each line on, and up to each line, the shortest of two lines and more with enough words."""
    out, n = set(), len(words)
    for i in range(n):
        for step, end in ((1, n - 1), (-1, 0)):
            j, total = i, words[i]
            while j != end and (j == i or total < min_words):
                j += step
                total += words[j]
            if j != i and total >= min_words:
                out.add((min(i, j), max(i, j)))
    return out


def _line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, a digest of all its lines, its lines that have a word (number, order, words, hash, how often it came before), and its distinct runs."""

    def make():
        import xxhash

        def work(batch):
            out = {"doc": batch["doc"], "body": [], "lines": [], "runs": []}
            for text in batch["text"]:
                times, lines, body = Counter(), [], xxhash.xxh3_128()
                for number, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                    line = line.strip()
                    if line:
                        h = xxhash.xxh3_128_digest(line)
                        body.update(h)
                        lines.append({"line": number, "at": len(lines), "words": len(line.split()), "h": h, "again": times[h]})
                        times[h] += 1
                out["body"].append(body.digest() if lines else None)
                out["lines"].append(lines)
                hashes = [x["h"] for x in lines]
                # equal neighbours make no run: a line repeated all over a text is no more telling than once
                ends = [(i, j) for i, j in runs([x["words"] for x in lines], min_words) if len(set(hashes[i : j + 1])) > 1]
                out["runs"].append(sorted({xxhash.xxh3_128_digest(b"".join(hashes[i : j + 1])) for i, j in ends}))
            yield out

        return work

    kind = "doc binary, body binary, lines array<struct<line:int,at:int,words:int,h:binary,again:int>>, runs array<binary>"
    return map_batches(docs.select("doc", "text"), make, kind)


def shared_lines(
    docs: DataFrame, *, min_words: int = MIN_WORDS, rare: int = RARE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc (the key of `common.document_key`), is_copy, and the 0-based lines to delete, for each document that loses something.

    Rows alike in id and text are one document here. Lines are compared without white space at their ends; lines without words
    take no part. NULL and empty texts lose nothing. An empty table gives an empty result.
    """
    tables = cut_lineage(_line_table(keyed_text(docs, id_col, text_col), min_words).dropDuplicates(["doc"]))
    firsts = tables.where("body is not null").groupBy("body").agg(F.min("doc").alias("first"), F.count("*").alias("n"))
    copies = tables.select("doc", "body").join(firsts.where("n > 1"), "body").where("doc <> first").select("doc")
    single = tables.join(firsts.select(F.col("first").alias("doc")), "doc", "left_semi")
    once = F.filter("lines", lambda x: x["again"] == 0)
    one_line = F.transform(once, lambda x: F.struct(x["h"].alias("h"), F.when(x["words"] >= min_words, LINE).otherwise(SHORT).alias("kind")))
    more_lines = F.transform("runs", lambda h: F.struct(h.alias("h"), F.lit(RUN).alias("kind")))
    seen = single.select("doc", F.explode(F.concat(one_line, more_lines)).alias("x")).select("doc", "x.h", "x.kind")
    # written first, so that the joins below read both sides from plain exchanges and very common evidence can be split
    owners = cut_lineage(seen.groupBy("h", "kind").agg(F.min("doc").alias("owner"), F.count("*").alias("n")).where("n > 1"))
    telling = owners.where((F.col("kind") == RUN) | ((F.col("kind") == LINE) & (F.col("n") <= rare))).select("h", "kind", "owner")
    pairs = cut_lineage(seen.where(F.col("kind") != SHORT).join(telling, ["h", "kind"]).where("doc <> owner").select("owner", "doc").distinct())
    # a document goes to its pairs with those lines alone that another document has
    lines = single.select("doc", F.explode("lines").alias("x")).select("doc", "x.line", "x.at", "x.words", "x.h", "x.again")
    shared = lines.join(owners.where(F.col("kind") != RUN).select("h"), "h")
    entry = F.struct("at", "line", "words", F.xxhash64("h").alias("h"), "again")
    shared = cut_lineage(shared.groupBy("doc").agg(F.collect_list(entry).alias("own")))
    met = pairs.join(shared, "doc").join(shared.select(F.col("doc").alias("owner"), F.col("own").alias("theirs")), "owner")

    def make():
        def work(batch):
            out = {"doc": [], "line": []}
            for doc, own, theirs in zip(batch["doc"], batch["own"], batch["theirs"], strict=True):
                places = {(x["h"], x["again"]): x["at"] for x in theirs}
                found = [(x["at"], places[key], x["line"], x["words"], x["h"]) for x in own if (key := (x["h"], x["again"])) in places]
                gone = blocks(patience(found), min_words)
                out["doc"] += [doc] * len(gone)
                out["line"] += gone
            yield out

        return work

    gone = map_batches(met.select("doc", "own", "theirs"), make, "doc binary, line int", rows=64)
    marks = gone.withColumn("is_copy", F.lit(False)).unionByName(copies.select("doc", F.lit(None).cast("int").alias("line"), F.lit(True).alias("is_copy")))
    return marks.groupBy("doc").agg(F.max("is_copy").alias("is_copy"), F.collect_set("line").alias("lines"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """`docs` with the text that stays, in the columns and order it had; a copy's text becomes empty.

    Rows alike in id and text all keep what the first of them keeps. A NULL text stays NULL. Other columns pass through.
    """
    marks = shared_lines(docs, id_col=id_col, text_col=text_col, **limits)

    @F.pandas_udf("string")
    def cut(text: pd.Series, lines: pd.Series, is_copy: pd.Series) -> pd.Series:
        def one(t, gone, copy):
            if t is None or not (copy or gone is not None and len(gone)):
                return t
            if copy:
                return ""
            gone = set(gone.tolist())
            return "\n".join([x for i, x in enumerate(t.split("\n")) if i not in gone])

        return pd.Series([one(*x) for x in zip(text, lines, is_copy, strict=True)], dtype=object)

    names = docs.columns
    own = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), document_key(docs[id_col], docs[text_col]).alias("doc"))
    cut_text = cut(F.col(f"row.{text_col}").cast("string"), F.col("lines"), F.coalesce("is_copy", F.lit(False)))
    return own.join(marks, "doc", "left").select(*(cut_text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names))
