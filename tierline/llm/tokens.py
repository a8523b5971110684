"""Token ids of whole texts with a public BPE vocabulary.

The tokenizers library encodes each distinct piece of text once per worker: a text is
cut where its rules let no token cross (before white space, and between a letter of ASCII or Latin-1 and
an ASCII character that is neither letter nor apostrophe), and the ids of the pieces are put together with
Arrow. Texts with a ``<|`` may hold special tokens and go to the library as they are.
"""

from __future__ import annotations

import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tierline.llm.hashing import text_bytes

CACHE = 300_000

_SPACE, _LETTER, _OTHER = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[:0x80] = _OTHER
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = 0
#: One word as it stands: small letters of ASCII and Latin-1.
_PLAIN = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
_NO_PIECES = pa.array([], pa.large_string())
_NO_IDS = pa.array([], pa.large_list(pa.uint32()))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Encoder:
    """Encodes columns of text; keeps the ids of up to ``CACHE`` pieces between batches, as Arrow arrays."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.known, self.ids = _NO_PIECES, _NO_IDS
        alphabet = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        others = [b for b in range(256) if b not in set(alphabet)]
        spelled = {**{b: chr(b) for b in alphabet}, **{b: chr(256 + i) for i, b in enumerate(others)}}
        self.spelled = [spelled[b] for b in range(256)]
        self.latin = {c: "".join(self.spelled[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}

    def piece(self, word: str) -> list[int]:
        """Ids of a piece without white space around it."""
        if word.isascii():
            plain = word.isalpha() and word.islower()
        else:  # letters of the Latin blocks, composed and in lower case: one word as it stands
            plain = max(word) < "ɐ" and word.isalpha() and word == word.lower() and unicodedata.is_normalized("NFC", word)
            if plain:
                word = "".join(self.spelled[b] for b in word.encode())
        if plain:
            return [t.id for t in self.model.tokenize(word)]
        return self.library.encode(word, add_special_tokens=False).ids

    def pieces(self, distinct: pa.Array) -> pa.Array:
        """Ids of distinct pieces without white space around them; the library gets those that are not kept."""
        at = pc.index_in(distinct, value_set=self.known).fill_null(-1).to_numpy()
        missing = at < 0
        if missing.any():
            new = distinct.filter(pa.array(missing))
            plain = pc.match_substring_regex(new, _PLAIN).to_numpy(zero_copy_only=False).tolist()
            ids, sizes, tokenize, spell = array("I"), [0], self.model.tokenize, self.latin
            for word, simple in zip(new.to_numpy(zero_copy_only=False), plain):
                got = [t.id for t in tokenize(word if word.isascii() else word.translate(spell))] if simple else self.piece(word)
                ids.extend(got)
                sizes.append(len(got))
            lists = pa.LargeListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int64()), pa.array(np.array(ids, np.uint32)))
            if len(self.known) + len(new) > CACHE:  # begin again with what this batch has
                kept = pa.array(at[~missing])
                self.known, self.ids = self.known.take(kept), self.ids.take(kept)
                at = np.cumsum(~missing) - 1
            at = np.where(missing, len(self.known) + np.cumsum(missing) - 1, at)
            self.known, self.ids = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.ids, lists])
        got = self.ids.take(pa.array(at))
        if len(self.known) > CACHE:
            self.known, self.ids = _NO_PIECES, _NO_IDS
        return got

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the offsets of each row."""
        data, offsets = text_bytes(column)
        n, rows = len(data), len(offsets) - 1
        if not n:
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        special = self._special(data, offsets)
        kind = _KIND[data]
        space, other, begins = kind == _SPACE, kind == _OTHER, kind == _LETTER
        ends = begins.copy()
        lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF: all but two are letters
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        begins[lead] = ends[lead + 1] = True
        upper = (data >= 65) & (data <= 90)
        upper[lead[data[lead + 1] <= 0x9E] + 1] = True
        upper[:-1] &= data[1:] < 0xCC  # a mark that follows may combine with the letter
        folded = data.copy()
        folded[upper] += 32
        cut = np.zeros(n + 1, bool)
        cut[1:n] = (space[1:] & ~space[:-1]) | (begins[1:] & other[:-1]) | (other[1:] & ends[:-1])
        cut[offsets] = True
        cut[[0, n]] = True
        at = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(folded)])
        coded = pieces.dictionary_encode()
        words = pc.ascii_trim(coded.dictionary, characters=" \t\n\r\v\f").dictionary_encode()
        # Small integers as codes, then the ids of every piece in the order of the text.
        lists = self.pieces(words.dictionary).take(words.indices.take(coded.indices))
        ends = lists.offsets.to_numpy()
        out, bounds = lists.values.to_numpy(), ends[np.searchsorted(at, offsets)]
        if special:
            parts = [out[bounds[i] : bounds[i + 1]] for i in range(rows)]
            for i in special:
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                parts[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            out = np.concatenate(parts)
        return out.astype(np.uint32, copy=False), bounds

    @staticmethod
    def _special(data: np.ndarray, offsets: np.ndarray) -> list[int]:
        if len(data) < 2:
            return []
        at = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        return np.unique(np.searchsorted(offsets, at, "right") - 1).tolist()


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's ids followed by ``end``."""
    rows = len(bounds) - 1
    return np.insert(ids, bounds[1:], np.uint32(end)), bounds + np.arange(rows + 1)
