"""Token ids of the public tokenizers, counted or listed text by text, with a bounded memory of words already encoded.

A text is cut at single blanks. In both public BPE files a blank that follows a non-blank ends a pre-token, so the cut words are encoded
independently of one another and their ids, put together, are the ids of the whole text. Words not met before go to the library: to the merges
of its model, pre-token by pre-token, or through its whole path where letters beyond Latin-1 or special strings occur.

For the byte-level file all texts of a call are taken together: their distinct words are cut into pre-tokens, and only distinct pre-tokens are
looked up in the memory.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words, and pre-tokens, remembered in a task's process.
MEMORY = 400_000


#: White space as the pre-tokenizer sees it, and words that take the library's whole path: special strings, or signs beyond ``latin``.
_BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"
_WHOLE = r"<\||[^\x20-\x7E\n\t\x{C0}-\x{FF}]"
#: The pre-tokens of a word in which white space stands alone and leads another sign.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\pL+| ?\pN+| ?[^\s\pL\pN]+|\s"


def strung(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other."""
    ends = np.cumsum(size)
    small = np.int32 if max(len(flat), int(ends[-1]) if len(ends) else 0) < 1 << 31 else np.int64
    at = np.repeat((start - ends + size).astype(small), size)
    at += np.arange(len(at), dtype=small)
    return flat[at]


def _sums(size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of stretches that follow each other, possibly empty."""
    return np.diff(np.concatenate([[0], np.cumsum(size)])[bounds])


class Memory(dict):
    """What ``make`` gave for a key. Half of ``MEMORY`` is the older generation, of which only what is asked for again survives."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        self._turn()
        self[key] = got
        return got

    def _turn(self):
        if len(self) >= MEMORY // 2:
            self.old = dict(self)
            self.clear()

    def several(self, keys: list, make) -> list:
        """What ``make``, which takes a list, gave for distinct keys."""
        got = list(map(self.get, keys))
        absent = [i for i, g in enumerate(got) if g is None]
        for i, g in zip(absent, map(self.old.get, [keys[i] for i in absent])):
            got[i] = g
        new = [i for i in absent if got[i] is None]
        for i, g in zip(new, make([keys[i] for i in new])):
            got[i] = g
        for lo in range(0, len(absent), MEMORY // 2):
            self._turn()
            self.update((keys[i], got[i]) for i in absent[lo:lo + MEMORY // 2])
        return got


@lru_cache(maxsize=4)
def encoder(file: str) -> "WordEncoder":
    return WordEncoder(file)


class WordEncoder:
    """Ids of texts and their words as little-endian unsigned 32-bit integers."""

    def __init__(self, file: str):
        import os

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(public_tokenizers.path(file))
        # In the byte-level file a blank belongs to the word that follows it; the other file drops white space.
        self.blank = file.startswith("byte_")
        self.cut = regex.compile(public_tokenizers.PATTERN if self.blank else r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.run_ahead = regex.compile(r"\S(?=\s)").finditer
        self.latin = regex.compile(r"[\x20-\x7E\n\t\u00C0-\u00FF]*").fullmatch
        # Bytes as printable characters, the fixed alphabet of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows U+0100.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        sign = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.letters = {c: "".join(sign[b] for b in chr(c).encode()) for c in range(256)}
        self.tokenize = self.library.model.tokenize
        self.words, self.parts = Memory(self._word), Memory(self._part)

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token, from the library's model."""
        signs = part.replace(" ", "Ġ") if part.isascii() and part.isprintable() else part.translate(self.letters)
        return array("I", [t.id for t in self.tokenize(signs)]).tobytes()

    def _new_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of pre-tokens not met before."""
        ids, ends, tokenize = [], [0], self.tokenize
        for p in parts:
            ids += [t.id for t in tokenize(p.replace(" ", "Ġ") if p.isascii() and p.isprintable() else p.translate(self.letters))]
            ends.append(4 * len(ids))
        raw = array("I", ids).tobytes()
        return [raw[a:b] for a, b in pairwise(ends)]

    def _word(self, word: str) -> bytes:
        """Ids of a word cut from a text. Letters alone are one pre-token, and so are marks behind them; other words are cut by the pattern."""
        if word.isalpha():
            if word.isascii():
                return array("I", [t.id for t in self.tokenize(word.lower())]).tobytes()
            if self.latin(word):
                return self._part(word.lower())
        else:
            stem = word.rstrip(",.!?;:*&%$#")
            if stem.isalpha() and (stem.isascii() or self.latin(stem)):
                return self.words[stem] + self.parts[word[len(stem):]]
        return self._piece(word)

    def _piece(self, piece: str) -> bytes:
        if "<|" in piece or not (piece.isascii() or self.latin(piece)):
            return array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.parts.__getitem__, self.cut(piece if self.blank else piece.lower())))

    def _odd(self, text: str) -> bytes:
        """Where white space comes in runs, each run leads the word behind it, as the pre-tokenizer needs its length."""
        cuts = [0, *(m.end() for m in self.run_ahead(text)), len(text)]
        return b"".join(self._piece(text[a:b]) for a, b in zip(cuts, cuts[1:]))

    def _strung(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all, where each starts and how many it has."""
        size = np.fromiter(map(len, raws), np.int64, len(raws)) // 4
        return np.frombuffer(b"".join(raws), "<u4"), np.cumsum(size) - size, size

    def listed(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column one after the other, null as empty, and their number per text. For the byte-level file."""
        column = column.cast(pa.large_string()).fill_null("")
        n = len(column)
        odd = np.flatnonzero(pc.match_substring_regex(column, f"{_BLANKS}{{2}}|{_BLANKS}$").to_numpy(zero_copy_only=False))
        kept = pc.if_else(pc.is_in(pa.array(np.arange(n)), pa.array(odd, pa.int64())), pa.scalar("", pa.large_string()), column) if len(odd) else column
        words = pc.split_pattern(kept, " ")
        bounds = words.offsets.to_numpy().astype(np.int64)
        bounds, values = bounds - bounds[0], words.flatten()
        coded = values.dictionary_encode()
        code, kinds = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
        # A blank leads all words but the first of a text; each text has a piece of its own for that.
        first = values.take(pa.array(bounds[:-1]))
        code[bounds[:-1]] = kinds + np.arange(n)
        cut = pa.concat_arrays([pc.binary_join_element_wise(pa.scalar("", pa.large_string()), coded.dictionary, pa.scalar(" ", pa.large_string())), first])
        whole = pc.match_substring_regex(cut, _WHOLE)
        # Letters alone are one pre-token; the other words are cut by the pattern.
        letters = pc.and_not(pa.concat_arrays([pc.utf8_is_alpha(coded.dictionary), pc.utf8_is_alpha(first)]), whole)
        rest = pc.filter(pc.if_else(whole, pa.scalar("", pa.large_string()), cut), pc.invert(letters))
        parts = pc.split_pattern(pc.replace_substring_regex(rest, _PARTS, "\x01\\0"), "\x01")
        single = letters.to_numpy(zero_copy_only=False)
        alone, at = int(single.sum()), parts.offsets.to_numpy().astype(np.int64)
        part = pa.concat_arrays([cut.filter(letters), parts.flatten()]).dictionary_encode()
        # No pre-token holds the sign that parts them.
        names = pc.binary_join(pa.ListArray.from_arrays([0, len(part.dictionary)], part.dictionary), pa.scalar("\x01", pa.large_string()))[0].as_py().split("\x01")
        flat, start, size = self._strung(self.parts.several(names, self._new_parts))
        order = part.indices.to_numpy()
        pieces, found = strung(flat, start[order], size[order]), _sums(size[order], np.concatenate([np.arange(alone), alone + at - at[0]]))
        turned = np.concatenate([np.flatnonzero(single), np.flatnonzero(~single)])
        starts, sizes = np.empty(len(cut), np.int64), np.empty(len(cut), np.int64)
        starts[turned], sizes[turned] = np.cumsum(found) - found, found
        # What the library's whole path reads, and texts with runs of white space, stand behind the others.
        told = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        more, begin, length = self._strung([*map(self._piece, cut.take(pa.array(told)).to_pylist()), *map(self._odd, column.take(pa.array(odd)).to_pylist())])
        told = np.concatenate([told, kinds + odd])
        starts[told], sizes[told] = begin + len(pieces), length
        ids = strung(np.concatenate([pieces, more]), starts[code], sizes[code])
        return ids, _sums(sizes[code], bounds)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.blank:
            ids, n = self.listed(pa.array(texts, pa.large_string()))
            return [x.tobytes() for x in np.split(ids.astype("<u4", copy=False), np.cumsum(n)[:-1])] if texts else []
        get = self.words.__getitem__
        return [b"".join(map(get, text.split(" "))) for text in texts]
