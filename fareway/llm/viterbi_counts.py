"""Token counts of a unigram vocabulary without the tokens: best score and piece count by dynamic programming.

An Aho-Corasick automaton names every vocabulary entry that ends at a place. The best path to a place keeps
its score and its number of pieces. Among equal scores the earliest start wins, as in the tokenizer. A character
that is no entry costs the lowest score less 10 and counts one piece per UTF-8 byte (byte fallback).

No entry has a blank after another character, so a best path always passes between a character and the blank
that follows it: the pieces between blanks are solved one by one, and kept in a bounded cache. Scores lie on a grid of
1/1024, which makes their sums exact, so that ties are ties wherever a piece stands.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame

from fareway.llm.common import id_text, map_batches, per_worker
from fareway.llm.tokens import Generations, blank_pieces, vocabulary_path

GRID = 1024
UNKNOWN_PENALTY = 10
BLANK = "▁"
CACHE_PIECES = 400_000
SHIFT = 64  # the count sits above the score in one integer, so that a text needs one sum


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """Entries of a public piece model in their own order, with the score -ln(rank + 2) on the grid.

    The model's file ranks its entries by use but holds no probabilities; Zipf's law stands in for them.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), -round(math.log(i + 2) * GRID) / GRID) for i in range(model.get_piece_size())]


class Counter:
    """Counts pieces of texts for one vocabulary of (entry, score); scores must lie on the grid."""

    def __init__(self, vocabulary: list[tuple[str, float]], cache_pieces: int = CACHE_PIECES):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, score in vocabulary:
            entry = entry.replace(BLANK, " ")
            self.automaton.add_word(entry, (len(entry), round(score * GRID)))
            if " " in entry.lstrip(" "):
                raise ValueError(f"the entry {entry!r} has a blank after another character")
        self.automaton.make_automaton()
        self.unknown = round((min(score for _, score in vocabulary) - UNKNOWN_PENALTY) * GRID)
        self.known = Generations(cache_pieces)

    def best_path(self, piece: str) -> tuple[int, int]:
        """Score on the grid and number of pieces of the best path."""
        ends: list[list] = [[] for _ in piece]
        for end, found in self.automaton.iter(piece):
            ends[end].append(found)
        score, count = [0] * (len(piece) + 1), [0] * (len(piece) + 1)
        for end, char in enumerate(piece, 1):
            best = None
            single = False
            for length, own in sorted(ends[end - 1], reverse=True):
                single |= length == 1
                total = score[end - length] + own
                if best is None or total > best:
                    best, pieces = total, count[end - length] + 1
            if not single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    best, pieces = total, count[end - 1] + len(char.encode("utf-8", "surrogatepass"))
            score[end], count[end] = best, pieces
        return score[-1], count[-1]

    def _packed(self, pieces: list[str]) -> list[int]:
        return [(n << SHIFT) - score for score, n in map(self.best_path, pieces)]

    def count(self, texts: list[str]) -> list[tuple[float, int]]:
        """(best score, pieces) of each text; a blank goes before a text that is not empty."""
        out = []
        for text in texts:
            if not text:
                out.append((0.0, 0))
                continue
            text = " " + text.replace(BLANK, " ")
            pieces = re.findall(r" +[^ ]*", text) if "  " in text or " \n" in text else blank_pieces(text)
            total = sum(self.known.values(pieces, self._packed))
            out.append((-(total & (1 << SHIFT) - 1) / GRID, total >> SHIFT))
        return out


def count_tokens(
    docs: DataFrame, *, vocabulary: list[tuple[str, float]] | None = None, model: str = "", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens and best_score of every text, in one pass without a shuffle.

    `vocabulary` goes to the tasks with the code; it is a tokenizer's vocabulary, bounded by its nature. Without one, the
    entries of `model`, or of the public 32k piece model, are taken with Zipf scores, read in the task.
    A NULL or empty text has 0 tokens and score 0. Repeated rows are counted each; a NULL id stays NULL; other columns
    are ignored; an empty table gives an empty result.
    """
    path = model or vocabulary_path("piece_bpe_32k.model")

    def make():
        if vocabulary:
            counter = Counter(vocabulary)
        else:
            counter = per_worker("viterbi", path, lambda: Counter(zipf_vocabulary(path)))

        def work(batch):
            found = counter.count(batch["text"])
            yield {"doc_id": batch["doc_id"], "n_tokens": [n for _, n in found], "best_score": [s for s, _ in found]}

        return work

    return map_batches(id_text(docs, id_col, text_col), make, "doc_id long, n_tokens long, best_score double")
