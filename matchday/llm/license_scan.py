"""Short licence notices, found with a bounded number of edits.

A notice of which at most k edits are allowed is cut into k + 1 pieces: whatever the edits, one piece stands unchanged in the text. All
places of the pieces are located by exact search; around each, the regex library looks for the notice with at most k insertions,
deletions or substitutions and returns the best match. Texts are searched as their words, in lower case, joined by one space, so that
punctuation, line ends and comment marks between the words of a notice do not matter; a match starts and ends at word borders.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from matchday.llm.common import map_texts, others

#: A-Z in lower case, every other ASCII character but a-z and 0-9 as a space: what is left between spaces are the words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
_WORD_AT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: Words of up to so many characters (mit, bsd, cc) must stand unchanged: one edit makes another word of them.
SHORT = 3

HIT = pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()),
                 ("first_char", pa.int64()), ("end_char", pa.int64()), ("edits", pa.int32()), ("likeness", pa.float64())])


@dataclass(frozen=True)
class Notice:
    """A label and the words that stand for it, lower-case and joined by one space."""

    label: str
    phrase: str

    @property
    def edits(self) -> int:
        """Edits allowed: one for every six characters, one at least."""
        return max(1, len(self.phrase) // 6)

    def pieces(self) -> list[tuple[int, str]]:
        """The phrase cut into ``edits + 1`` pieces of nearly equal length, with their places."""
        cuts = [len(self.phrase) * i // (self.edits + 1) for i in range(self.edits + 2)]
        return [(a, self.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


NOTICES = (
    Notice("mit", "mit license"), Notice("apache", "apache license"), Notice("gpl", "general public license"),
    Notice("bsd", "bsd license"), Notice("cc", "licensed under cc by"), Notice("cc", "creative commons attribution"),
    Notice("lgpl", "lesser general public license"), Notice("mpl", "mozilla public license"),
    Notice("epl", "eclipse public license"), Notice("public-domain", "dedicated to the public domain"),
)


@dataclass(frozen=True)
class Hit:
    """A notice in a text: words from 0, code points of the text, edits, and 1 less the edits a character of the notice."""

    label: str
    notice: str
    first_word: int
    words: int
    first_char: int
    end_char: int
    edits: int
    likeness: float


class Scanner:
    """Finds notices in batches of texts."""

    def __init__(self, notices: Sequence[Notice] = NOTICES):
        for notice in notices:
            if notice.phrase.encode().translate(_WORDS).split() != notice.phrase.encode().split() or not notice.phrase.strip():
                raise ValueError(f"not lower-case words: {notice.phrase!r}")
        self.notices = notices
        # The space before is part of the match: a search allows no insertion where it starts.
        self.patterns = [regex.compile(f"(?b) (?:{regex.escape(n.phrase, literal_spaces=True)}){{e<={n.edits}}}(?= )")
                         for n in notices]
        self.short = [{w for w in n.phrase.split() if len(w) <= SHORT} for n in notices]
        self.seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for at, piece in notice.pieces():
                self.seeds.setdefault(piece, []).append((i, at))

    def _windows(self, joined: str, starts: list[int], ends: list[int]) -> set[tuple[int, int, int]]:
        """(notice, first, end) around each place of each piece; a match with that piece unchanged lies inside."""
        found = set()
        for piece, uses in self.seeds.items():
            at = joined.find(piece)
            while at >= 0:
                text = bisect_right(starts, at) - 1
                for i, offset in uses:
                    slack, size = self.notices[i].edits, len(self.notices[i].phrase)
                    # One more character on either side, for the borders of a match.
                    first, end = at - offset - slack - 1, at - offset + size + slack + 1
                    found.add((i, max(first, starts[text]), min(end, ends[text])))
                at = joined.find(piece, at + 1)
        return found

    def scan(self, texts: Sequence[bytes]) -> tuple[list[int], list[list[Hit]]]:
        """The number of words, and the hits by place, of each UTF-8 text."""
        counts, parts, starts, ends, at = [], [], [], [], 0
        for text in texts:
            words = text.translate(_WORDS).split()
            counts.append(len(words))
            parts.append(" " + b" ".join(words).decode("utf-8") + " ")
            starts.append(at)
            ends.append(at + len(parts[-1]))
            at = ends[-1] + 1
        joined = "\n".join(parts)
        found: dict[tuple[int, int, int], int] = {}
        for i, first, end in self._windows(joined, starts, ends):
            match = self.patterns[i].search(joined, first, end)
            if match and self.short[i] <= set(match[0].split()):
                found[i, match.start() + 1, match.end()] = sum(match.fuzzy_counts)
        hits: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        taken: list[list[tuple[int, int]]] = [[] for _ in self.notices]
        # Of overlapping matches of one notice, that with the fewest edits stays.
        for (i, first, end), edits in sorted(found.items(), key=lambda f: (f[0][0], f[1], f[0])):
            near = bisect_left(taken[i], (first, end))
            if all(b <= first or a >= end for a, b in taken[i][max(near - 1, 0):near + 1]):
                taken[i].insert(near, (first, end))
                hits[bisect_right(starts, first) - 1].append((first, end, i, edits))
        return counts, [self._placed(texts[t], parts[t], starts[t], sorted(h)) if h else [] for t, h in enumerate(hits)]

    def _placed(self, text: bytes, part: str, start: int, hits: list[tuple[int, int, int, int]]) -> list[Hit]:
        places = [m.span() for m in _WORD_AT.finditer(text.decode("utf-8"))]
        out = []
        for first, end, i, edits in hits:
            notice = self.notices[i]
            word = part.count(" ", 0, first - start) - 1
            words = part.count(" ", first - start, end - start) + 1
            out.append(Hit(notice.label, notice.phrase, word, words, places[word][0], places[word + words - 1][1], edits,
                           1 - edits / len(notice.phrase)))
        return out


def scan_notices(docs: DataFrame, column: str = "text", notices: Sequence[Notice] = NOTICES, keep: list[str] | None = None,
                 finish=None, fields: dict[str, pa.DataType] | None = None) -> DataFrame:
    """``keep`` columns (default: all) with ``n_words`` and ``hits``, an array by place.

    A hit has label, notice, first_word (from 0), words, first_char and end_char (code points of the text), edits and likeness (1 for
    an exact place). Hits of one notice do not overlap; different notices may. NULL and empty texts have no words and no hits; columns
    called n_words or hits are replaced. ``finish(n_words, hits)`` may turn a document into the values of ``fields``.
    """
    keep = others(docs, "n_words", "hits") if keep is None else keep
    finish = finish or (lambda n, hits: (n, [vars(h) for h in hits]))
    fields = fields or {"n_words": pa.int64(), "hits": pa.list_(HIT)}

    def make():
        scanner = Scanner(notices)
        return lambda texts, rows: [finish(n, hits) for n, hits in zip(*scanner.scan(texts))]

    return map_texts(docs, column, keep, fields, make)
