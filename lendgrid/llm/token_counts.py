"""Count-only Viterbi over a unigram vocabulary."""

from __future__ import annotations

from collections import Counter

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from lendgrid.llm.frames import slices
from lendgrid.llm.words import Remembered

SPACE = "▁"
#: What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces with their scores; ``bytes_known``: an unknown character becomes one piece per byte of its UTF-8."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_known: bool):
        self.pieces, self.bytes_known = pieces, bytes_known

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """The pieces of a tokenizer's model file, read on the driver; the vocabulary's size bounds what tasks get."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = [i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
        own = set(special)
        return cls([(model.id_to_piece(i), model.get_score(i)) for i in ids if i not in own], any(model.is_byte(i) for i in ids))


class PieceCounter:
    """Piece count and best score of a text."""

    def __init__(self, vocabulary: Vocabulary):
        self.matcher = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes_known = vocabulary.bytes_known
        self.breaks_lines = vocabulary.bytes_known and not any("\n" in p for p, _ in vocabulary.pieces)
        self.units = Remembered(self.best)
        self.parts = Remembered(self._part)

    def best(self, unit: str) -> tuple[int, float]:
        """Pieces and score of the best cut. Of equal scores the one whose last piece starts first stays.

        Ends are visited in order and, at each, pieces from the longest to the shortest, so a later one must be strictly
        better; an unknown character counts only where no piece of one character fits.
        """
        n = len(unit)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.matcher.iter(unit):
            matches[end].append(match)
        for end in range(n):
            top, single = None, False
            for length, s in matches[end]:  # the matcher gives longer ones first
                start = end + 1 - length
                single |= length == 1
                if top is None or score[start] + s > top:
                    top = score[start] + s
                    count[end + 1] = count[start] + 1
            if not single and (top is None or score[end] + self.unknown > top):
                top, unknown[end + 1] = score[end] + self.unknown, True
                pieces = len(unit[end].encode("utf-8", "surrogatepass")) if self.bytes_known else int(not unknown[end])
                count[end + 1] = count[end] + pieces
            score[end + 1] = top
        return count[n], score[n]

    def _part(self, part: str) -> tuple[int, float]:
        if self.breaks_lines and "\n" in part:
            # no piece holds a line break, so each is cut off on either side
            head, *rest = part.split("\n")
            found = [self.units[SPACE + head], *(self.units["\n" + x] for x in rest)]
            return sum(c for c, _ in found), sum(s for _, s in found)
        return self.units[SPACE + part]

    def count(self, text: str | None) -> tuple[int, float]:
        """Blanks are the marks that begin a unit; a text gets one in front unless it has one."""
        if not text:
            return 0, 0.0
        flat = text.replace(SPACE, " ")
        pieces, score = 0, 0.0
        for part, n in Counter(flat.removeprefix(" ").split(" ")).items():
            c, s = self.parts[part]
            pieces += n * c
            score += n * s
        return pieces, score


_COUNTERS: dict[int, PieceCounter] = {}


def _counter(pieces: list[tuple[str, float]], bytes_known: bool) -> PieceCounter:
    """A worker's counter, kept from task to task for the vocabulary used last, with the words that it remembers."""
    key = hash((tuple(pieces), bytes_known))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PieceCounter(Vocabulary(pieces, bytes_known))
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``score`` of each row's whole text; a missing or empty text has 0 and 0.

    Words end where blanks do, and no piece goes over a blank, so the best cut of a text is that of its words one by one;
    each worker remembers the words it has cut. Other columns are ignored. Rows are counted where they are read: no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.bytes_known))

    def run(batches):
        counter = _counter(*sent.value)
        for part in slices(batches, "text", 4 << 20):
            found = [counter.count(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "n_tokens", "score"])

    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_tokens long, score double")
