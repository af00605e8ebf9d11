"""Token counts by a linear longest-match automaton.

The vocabulary is a trie. Each node has a failure link, the node where matching goes on after the longest prefix of the
node's string is split off greedily, and the number of pieces so split off. A word's greedy word-piece length is then the
sum of popped pieces along one walk over its characters; no piece is ever built.

Words end in an end mark, as the vocabulary's entries for word ends do. Every byte has an entry of its own, inside a word
and at its end, so no word is without a segmentation; with a vocabulary that lacks some, an unmatched character counts
as one unknown piece.

Cases: a null or empty text has 0 tokens; equal rows have equal counts; very long texts and words are read in full.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from leafmill.functions.session import arrow_rows

END = "\n"  # never inside a word
#: Fixed value: how texts are cut into words before pieces are counted.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Automaton:
    """Longest-match automaton over a vocabulary of strings."""

    def __init__(self, pieces):
        self.next: list[dict[str, int]] = [{}]
        self.is_piece = [False]
        for piece in pieces:
            node = 0
            for ch in piece:
                step = self.next[node].get(ch)
                if step is None:
                    step = len(self.next)
                    self.next[node][ch] = step
                    self.next.append({})
                    self.is_piece.append(False)
                node = step
            self.is_piece[node] = bool(piece)
        self._link()

    def _link(self) -> None:
        """Breadth first: fail[v] is where to go when v has no edge for the next character, pops[v] what that splits off."""
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        queue = [0]
        for node in queue:
            for ch, child in self.next[node].items():
                queue.append(child)
                if self.is_piece[child]:
                    self.fail[child], self.pops[child] = 0, 1
                    continue
                at, popped = self.fail[node], self.pops[node]
                while at >= 0 and ch not in self.next[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[child], self.pops[child] = self.next[at][ch], popped
                # otherwise the string of child can't be split: fail stays -1

    def count(self, word: str) -> int:
        """Pieces of word, split greedily, longest first; a character that starts no match counts as one."""
        node, total, start = 0, 0, 0
        i, n = 0, len(word)
        while i < n:
            ch = word[i]
            while ch not in self.next[node]:
                if self.fail[node] < 0:
                    return self.count_plainly(word)
                total += self.pops[node]
                node = self.fail[node]
            node = self.next[node][ch]
            i += 1
        while node:
            if self.fail[node] < 0:
                return self.count_plainly(word)
            total += self.pops[node]
            node = self.fail[node]
        return total

    def count_plainly(self, word: str) -> int:
        """Longest-match with restarts: also for words that the vocabulary does not cover."""
        total = i = 0
        while i < len(word):
            node, end, j = 0, i + 1, i
            while j < len(word) and (node := self.next[node].get(word[j], 0)):
                j += 1
                if self.is_piece[node]:
                    end = j
            total, i = total + 1, end
        return total


def vocabulary_pieces(path: str) -> list[str]:
    """Pieces of a vocabulary file; those for word ends carry END instead of the file's own end mark."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    mark = model.get("end_of_word_suffix") or ""
    return [p.removesuffix(mark) + END if mark and p.endswith(mark) else p for p in model["vocab"] if not p.startswith("<|")]


def load(path: str) -> Automaton:
    return Automaton(vocabulary_pieces(path))


@lru_cache(maxsize=1)
def _automaton(pieces: str) -> Automaton:
    """One automaton for all tasks of a Python worker."""
    return Automaton(pieces.split("\x00"))


class _Counts(dict):
    """Pieces of a word; emptied when full."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton, self.symbols = automaton, byte_symbols()

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        shown = "".join(map(self.symbols.__getitem__, word.encode("utf-8", "surrogatepass")))
        found = self.automaton.count(shown + END)
        if len(word) < 64:
            self[word] = found
        return found


def words_of(text: str) -> list[str]:
    return _SPLIT.findall(unicodedata.normalize("NFC", text).lower())


def count_tokens(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row of df. `vocabulary` is a file of the driver's; its pieces are broadcast."""
    arrow_rows(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    pieces = df.sparkSession.sparkContext.broadcast("\x00".join(vocabulary_pieces(vocabulary)))  # bounded by the file

    def run(batches):
        counts = _Counts(_automaton(pieces.value))
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).to_pylist():
                found = words_of(text) if text else []
                words.append(len(found))
                tokens.append(sum(map(counts.__getitem__, found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
