"""BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of a prefix is known from its last token and the encoding of what precedes it: a token that ends the
prefix is the last one exactly if it and the last token of the shorter prefix stay apart when the two are encoded
together. So each trie node keeps one state, the last token of the prefix it stands for. The distinct words of a batch are
visited in sorted order, which is the depth-first order of their trie; the states on the path to the next word are kept,
so a prefix shared by many words is encoded once.

Words travel nowhere: each task encodes the words of its own documents and keeps a bounded table of encoded
words. The tokenizer is read from its JSON file on the driver and sent with the task. Special tokens found in a text are
encoded as themselves. A NULL or empty text has no tokens; the decoded text of no tokens is empty.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

#: White space as the tokenizer's pattern sees it (fixed values). str.split() also splits at U+001C to U+001F.
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
_OTHER_SPACES = re.compile("[\x1c-\x1f]")


def _byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest follows
    from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, following = [], 256
    for byte in range(256):
        if byte in printable:
            out.append(chr(byte))
        else:
            out.append(chr(following))
            following += 1
    return out


class TrieBpe:
    """Encoder and decoder of a BPE vocabulary with word ends, from a tokenizer's JSON text."""

    def __init__(self, definition: str, max_words: int = 450_000):
        spec = json.loads(definition)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        texts = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.tokens = np.array([texts.get(i) for i in range(max(texts) + 1)], dtype=object)
        self.ranks = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): r for r, m in enumerate(model["merges"])}
        (pattern,) = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pieces = regex.compile(pattern)
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.halves = {a + b: (a, b) for a, b in self.ranks}
        self.bytes_to_symbols = str.maketrans({chr(b): s for b, s in enumerate(_byte_symbols())})
        self.packed = {t: self._packed([i]) for t, i in self.ids.items()}
        inner = [t for t in self.ids if not self.end or not t.endswith(self.end)]
        #: Of each stretch that ends a token inside a word, or one at its end (less the word end): if it is a token, whether it stays
        #: apart from the tokens met to its left; else None. A stretch that is not here ends no token, nor does a longer one.
        self.inner_seams = self._seams(inner)
        self.final_seams = self._seams(t[: -len(self.end)] for t in self.ids if t.endswith(self.end)) if self.end else {}
        self.known_seams = 0
        #: Words in use and, of as many at most, those in use before: a word met again is taken over, the others leave.
        self.table_words = max_words // 2
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE of a short symbol sequence: the merge of lowest rank first, the leftmost of equals."""
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.ranks):
                break
            symbols = symbols[:at] + [symbols[at] + symbols[at + 1]] + symbols[at + 2:]
        return symbols

    def _split(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end):
            head = token[: -len(self.end)]
            return [*head[:-1], head[-1] + self.end]
        return list(token)

    @staticmethod
    def _seams(tokens: Iterable[str]) -> dict[str, dict[str, bool] | None]:
        tokens = list(tokens)
        seams: dict[str, dict[str, bool] | None] = {token[at:]: None for token in tokens for at in range(len(token))}
        seams.update((token, {}) for token in tokens)
        return seams

    def _apart(self, left: str, right: str) -> bool:
        """Whether ``left`` and ``right`` are the encoding of their concatenation (``left`` empty: of ``right``).

        The symbols at the seam have a history: each is made by a merge and used up by another, and merges happen in order of
        rank. The two tokens stay apart unless the symbols that face each other at some time could have merged then.
        """
        return self._seam(left, right) if left else self._merged(self._split(right)) == [right]

    def _keep_seam(self, seams: dict[str, bool], left: str, right: str) -> bool:
        """``_apart``, kept in ``seams`` of ``right``; all are forgotten when there are too many."""
        if self.known_seams >= 500_000:
            for known in (*self.inner_seams.values(), *self.final_seams.values()):
                if known:
                    known.clear()
            self.known_seams = 0
        self.known_seams += 1
        seams[left] = apart = self._apart(left, right)
        return apart

    def _seam(self, left: str, right: str) -> bool:
        halves, ranks, never = self.halves, self.ranks, len(self.ranks)
        left_used = right_used = never
        while True:
            left_half, right_half = halves.get(left), halves.get(right)
            left_made = ranks[left_half] if left_half else -1
            right_made = ranks[right_half] if right_half else -1
            rank = ranks.get((left, right))
            if rank is not None:
                when = max(rank, left_made, right_made)
                if when < left_used and when <= right_used:  # of equal merges the leftmost goes first
                    return False
            if left_made < 0 and right_made < 0:
                return True
            if left_made > right_made:  # go back in time to what the later of the two was made of
                left, left_used = left_half[1], left_made
            else:
                right, right_used = right_half[0], right_made

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of distinct words, each given as its byte symbols, by one depth-first pass over their trie."""
        out: dict[str, bytes] = {}
        inner_seams, final_seams, end, packed = self.inner_seams, self.final_seams, self.end, self.packed
        keep_seam = self._keep_seam
        states: list[str] = [""]
        path = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(path, word):
                if a != b:
                    break
                shared += 1
            size = len(word)
            inner = size - 1 if end else size
            shared = min(shared, inner, len(states) - 1)
            del states[shared + 1:]
            for depth in range(shared + 1, inner + 1):
                last = None
                for at in range(depth - 1, -1, -1):
                    token = word[at:depth]
                    if token not in inner_seams:
                        break
                    seams = inner_seams[token]
                    if seams is not None:
                        left = states[at]
                        apart = seams.get(left)
                        if apart or apart is None and keep_seam(seams, left, token):
                            last = token
                            break
                states.append(last)
            path = word[:inner]
            if end:
                for at in range(size - 1, -1, -1):
                    token = word[at:]
                    if token not in final_seams:
                        raise ValueError(f"no token ends {word!r}")
                    seams = final_seams[token]
                    if seams is not None:
                        left = states[at]
                        apart = seams.get(left)
                        if apart or apart is None and keep_seam(seams, left, token + end):
                            break
                else:
                    raise ValueError(f"no token ends {word!r}")
                parts, depth = [packed[token + end]], at
            else:
                parts, depth = [], size
            while depth:
                last = states[depth]
                parts.append(packed[last])
                depth -= len(last)
            parts.reverse()
            out[word] = b"".join(parts)
        return out

    def _normal(self, text: str) -> str:
        """NFC, then each character lower-cased on its own: only a capital sigma goes by its neighbours otherwise."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()

    def _learn(self, chunks: set[str]) -> None:
        """Encode normalised chunks (text between white space) that are not in the table yet, and the pieces they consist of."""
        words, older, findall, pieces_of, new = self.words, self.older, self.pieces.findall, {}, set()
        for chunk in chunks:
            if chunk in older:
                words[chunk] = older[chunk]
            elif chunk.isalpha():
                new.add(chunk)
            else:
                pieces_of[chunk] = pieces = findall(chunk)
                new.update(pieces)
        words.update((piece, older[piece]) for piece in new & older.keys())
        symbols_of = {
            piece: piece if piece.isascii() and piece.isprintable()
            else piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.bytes_to_symbols)
            for piece in new if piece not in words}
        encoded = self.encode_words(symbols_of.values())
        for piece, symbols in symbols_of.items():
            words[piece] = encoded[symbols]
        for chunk, pieces in pieces_of.items():
            if chunk not in symbols_of:
                words[chunk] = b"".join([words[p] for p in pieces])

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def chunks(self, text: str) -> list[str]:
        """The normalised text between white space; normalising leaves white space what it is."""
        text = self._normal(text)
        if _OTHER_SPACES.search(text):
            return [c for c in _SPACES.split(text) if c]
        return text.split()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts_of, out = [], []
        for text in texts:
            text = text or ""
            if self.at_special and any(s in text for s in self.special):
                parts_of.append([(part, part in self.special) for part in self.at_special.split(text) if part])
            else:
                parts_of.append([(text, False)])
        done = 0
        while done < len(parts_of):
            # As many texts at a time as the word table may hold new words of, but one at least.
            new: set[str] = set()
            upto, room = done, self.table_words
            split = []
            while upto < len(parts_of) and (upto == done or len(new) < room):
                split.append([(part if special else self.chunks(part), special) for part, special in parts_of[upto]])
                new.update(c for part, special in split[-1] if not special for c in part)
                upto += 1
            missing = new - self.words.keys()
            if len(self.words) + len(missing) > self.table_words:
                self.older, self.words = self.words, {}
                missing = new
            self._learn(missing)
            for parts in split:
                out.append(b"".join([
                    self._packed([self.special[part]]) if special
                    else b"".join(map(self.words.__getitem__, part)) for part, special in parts]))
            done = upto
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens joined by a space: what a tokenizer without a decoder gives."""
        return " ".join(self.tokens[np.frombuffer(ids, dtype="<u4")].tolist())


_encoder: dict[bytes, TrieBpe] = {}


def encoder_of(definition: str) -> TrieBpe:
    """The encoder of a tokenizer, kept from task to task of a Python worker, with its bounded tables; one at a time."""
    digest = hashlib.sha256(definition.encode()).digest()
    if digest not in _encoder:
        _encoder.clear()
        _encoder[digest] = TrieBpe(definition)
    return _encoder[digest]


def encode_documents(docs: DataFrame, definition: str, column: str = "text", finish=None, schema: str | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with ``token_ids`` (binary, little-endian unsigned 32-bit) and ``decoded``.

    ``finish`` may turn the two columns into others (a pandas function of a frame), with their ``schema``.
    """
    keep = docs.columns if keep is None else keep
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(definition)  # one tokenizer file, whatever the number of documents
    kept_schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder_of(sent.value)
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start:start + 500]
                ids = bpe.encode_batch([t if isinstance(t, str) else None for t in part[column]])
                out = part[keep].assign(token_ids=ids, decoded=[bpe.decode(i) for i in ids])
                yield finish(out) if finish else out

    columns = list(dict.fromkeys([*keep, column]))
    return docs.select(*columns).mapInPandas(run, f"{kept_schema}, {schema or 'token_ids binary, decoded string'}")
