"""Token ids of texts, each distinct word encoded once per worker.

The tokenizer library encodes a word when it is first met; the words of a slice
of text are found and looked up all at once.  Texts are cut where the tokenizer
is certain to cut: at white space (``UnitSlice``, for tokenizers that drop it),
or before single blanks and around single line breaks between letters, digits
and signs (``ByteUnits``, for byte-level ones, which keep the blank with the
word).  What is not certain stays one unit.  The store is a flat hash
table keyed by 64-bit hashes of the words' bytes (A-Z lower-cased where the
tokenizer does so), bounded by ``STORE_WORDS``: a full one is begun anew.

A word that may hold a special token (``<|``) keeps its case.  A punctuation
mark after a letter and before white space is a word of its own here, as the
tokenizer cuts there too, so a stem is kept once.
"""

from __future__ import annotations

import os

import numpy as np

from fieldbook.llm.words import LOWER_ASCII, SAME_BYTES, SPACE_WORDS, WordSlice

STORE_WORDS, STORE_IDS = 1 << 21, 1 << 24
SLOTS = 1 << 22
_U = np.uint64
BLANK = "\u0120"            # how a byte-level vocabulary writes a blank

_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LATIN = np.zeros(256, bool)              # second bytes of the letters U+00C0 .. U+00FF
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False              # the signs of multiplication and division


class UnitSlice(WordSlice):
    """Words of white-space separated text, a closing mark apart."""

    def __init__(self, offsets, data, lo, hi):
        super().__init__(offsets, data, lo, hi, SPACE_WORDS, LOWER_ASCII)
        last = self.ends - 1
        d = self.data
        opens = np.flatnonzero((d[:-1] == ord("<")) & (d[1:] == ord("|")))
        for i in np.unique(np.searchsorted(self.starts, opens, "right") - 1).tolist():
            at, to, base = int(self.starts[i]), int(self.ends[i]), int(offsets[lo])
            d[at:to] = data[base + at:base + to]
        long = last - self.starts >= 1
        before = d[np.maximum(last - 1, 0)]
        letter = _LETTER[before] | (_LATIN[before] & (last - self.starts >= 2) & (d[np.maximum(last - 2, 0)] == 0xC3))
        marks = last[long & _MARK[d[last]] & letter] if len(last) else last
        edges = (offsets[lo:hi + 1] - int(offsets[lo])).astype(np.int64)
        self.starts = np.sort(np.concatenate([self.starts, marks]), kind="stable")
        self.ends = np.sort(np.concatenate([self.ends, marks]), kind="stable")
        self.first = np.searchsorted(self.starts, edges)


_SIGN = np.zeros(256, bool)               # one-byte characters that are no space
_SIGN[0x21:0x7F] = True


class ByteUnits(WordSlice):
    """Units of a byte-level tokenizer: they cover every byte, a single blank
    stands before its word, a single line break and a closing mark apart."""

    def __init__(self, offsets, data, lo, hi):
        super().__init__(offsets, data, lo, hi, SPACE_WORDS, SAME_BYTES)
        d, n = self.data, len(self.data)
        edges = (offsets[lo:hi + 1] - int(offsets[lo])).astype(np.int64)
        at = np.flatnonzero((d[1:-1] == 32) | (d[1:-1] == 10)) + 1 if n > 2 else np.zeros(0, np.int64)
        latin_before = _LATIN[d[at - 1]] & (at >= 2) & (d[np.maximum(at - 2, 0)] == 0xC3)
        sure = (_SIGN[d[at - 1]] | latin_before) & (_SIGN[d[at + 1]] | (d[at + 1] == 0xC3))
        inside = np.ones(n + 1, bool)
        inside[edges] = False                        # neither side of a cut may belong to another text
        at = at[sure & inside[at] & inside[at + 1]]
        at = at[(d[at + 1] != 0xC3) | _LATIN[d[np.minimum(at + 2, n - 1)]]]
        breaks = at[d[at] == 10]
        closes = np.concatenate([at, edges[1:][edges[1:] > 0]])          # what follows a mark: blank, break or end
        marks = closes[_MARK[d[closes - 1]] & (closes >= 2)] - 1
        before = d[marks - 1]
        ascii_letter = _LETTER[before | 0x20] & (before < 0x80)
        latin = _LATIN[before] & (marks >= 2) & (d[np.maximum(marks - 2, 0)] == 0xC3)
        marks = marks[(ascii_letter | latin) & inside[marks]]
        texts = edges[:-1][np.diff(edges) > 0]
        self.starts = np.unique(np.concatenate([texts, at, breaks + 1, marks]))
        self.ends = np.append(self.starts[1:], n) if len(self.starts) else self.starts
        self.first = np.searchsorted(self.starts, edges)


class WordIds:
    """Ids of the units of slices, by the tokenizer file at ``path``."""

    def __init__(self, path: str, word_end: str | None = "</w>"):
        """``word_end``: how the vocabulary marks the end of a word; None for a
        byte-level one."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        self.units, self.lead = (UnitSlice, "") if word_end else (ByteUnits, " ")
        self.marked = np.zeros(max(vocabulary.values()) + 1, bool)       # ids that end a word, or begin one with its blank
        self.marked[[i for w, i in vocabulary.items() if (w.endswith(word_end) if word_end else w.startswith(BLANK))]] = True
        self._begin_anew()

    def _begin_anew(self):
        self.keys, self.word = np.zeros(SLOTS, _U), np.zeros(SLOTS, np.int32)
        self.begin, self.ids, self.n, self.n_ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, self.kind), 0, 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 where it is not kept."""
        out = np.full(len(hashes), -1, np.int64)
        at = (hashes & _U(SLOTS - 1)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            held = self.keys[at]
            hit = held == hashes[todo]
            out[todo[hit]] = self.word[at[hit]]
            more = ~hit & (held != 0)
            todo, at = todo[more], (at[more] + 1) & (SLOTS - 1)
        return out

    def _keep(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Add distinct words that are not kept yet."""
        need, need_ids = self.n + len(hashes) + 1, self.n_ids + len(ids)
        if need > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(max(need, len(self.begin)), np.int64)])
        if need_ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need_ids, len(self.ids)), self.kind)])
        self.ids[self.n_ids:need_ids] = ids
        self.begin[self.n + 1:need] = self.n_ids + np.cumsum(sizes)
        number = np.arange(self.n, need - 1, dtype=np.int32)
        self.n, self.n_ids = need - 1, need_ids
        at = (hashes & _U(SLOTS - 1)).astype(np.int64)
        while len(at):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]
            mine = free & (self.keys[at] == hashes)
            self.word[at[mine]] = number[mine]
            hashes, number, at = hashes[~mine], number[~mine], (at[~mine] + 1) & (SLOTS - 1)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of new words.  Words of letters only are one unit of
        the tokenizer each, so they go in one call and are told apart by the
        ids that end a word or begin one; the others go one by one."""
        parts, lead = [None] * len(words), self.lead
        plain = [i for i, w in enumerate(words) if w.startswith(lead) and w[len(lead):].isalpha()]
        if plain:
            joined = ("" if lead else " ").join([words[i] for i in plain])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids)
            cuts = np.flatnonzero(self.marked[ids])
            cuts = np.append(cuts, len(ids)) if lead else np.append(0, cuts + 1)
            if len(cuts) == len(plain) + 1 and cuts[0] == 0 and cuts[-1] == len(ids):
                for i, part in zip(plain, np.split(ids, cuts[1:-1]), strict=True):
                    parts[i] = part
        rest = [i for i, p in enumerate(parts) if p is None]
        for i, found in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
            parts[i] = np.array(found.ids, np.int64)
        return np.array([len(p) for p in parts]), np.concatenate(parts).astype(self.kind)

    def encode(self, offsets: np.ndarray, data: np.ndarray, lo: int, hi: int, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``lo .. hi`` one after the other, ``end_id`` after
        each, and where each text begins (one entry more than texts)."""
        units = self.units(offsets, data, lo, hi)
        hashes = np.maximum(units.hashes, _U(1))
        number = self._find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct, at = np.unique(hashes[new], return_index=True)
            if self.n and (self.n + len(distinct) > STORE_WORDS or self.n_ids > STORE_IDS):
                self._begin_anew()
                return self.encode(offsets, data, lo, hi, end_id)
            self._keep(distinct, *self._encode([units.word(i).decode() for i in new[at]]))
            number[new] = self._find(hashes[new])
        sizes = self.begin[number + 1] - self.begin[number]
        before = np.concatenate([[0], np.cumsum(sizes)])
        per_text = np.diff(before[units.first])
        total = int(before[-1])
        out = np.full(total + hi - lo, end_id, self.kind)
        place = np.arange(total) + np.repeat(np.arange(hi - lo), per_text)
        out[place] = self.ids[np.repeat(self.begin[number] - before[:-1], sizes) + np.arange(total)]
        return out, np.concatenate([[0], np.cumsum(per_text + 1)])
